"""DuckDB SQL that recomputes each registered query from the same parquet tables.

Fixture CTEs repeat ``meridian.sources.testdata`` in SQL; ``with_ctes`` puts the
CTEs a query needs (and their dependencies) in front of its body.  Floating
results are rounded on both sides (``ROUND_DIGITS``) because summation order
differs between engines.
"""

from __future__ import annotations

from meridian.functions.draws import sql_hash_uniform

ROUND_DIGITS = 6

CTES: dict[str, tuple[str, list[str]]] = {}


def cte(name: str, sql: str, deps: list[str] | None = None) -> None:
    CTES[name] = (sql, deps or [])


def with_ctes(body: str, *names: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][1]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    if not order:
        return body
    parts = ",\n".join(f"{n} AS MATERIALIZED (\n{CTES[n][0]}\n)" for n in order)
    stripped = body.lstrip()
    if stripped[:5].upper() == "WITH ":
        return f"WITH {parts},\n{stripped[5:]}"
    return f"WITH {parts}\n{body}"


# ------------------------------------------------------------------ fixtures

cte("transactions", """
SELECT l.l_partkey AS product, CAST(l.l_quantity - 10 AS INTEGER) AS quantity,
       o.o_custkey AS customer, n.n_name AS country
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey""")

for _kind, _key in (("part", "l_partkey"), ("supp", "l_suppkey")):
    cte(f"links_{_kind}", f"""
SELECT a.{_key} AS src, b.{_key} AS dst, o.o_orderdate AS ts,
       CAST(CASE WHEN a.l_returnflag = 'R' THEN -1 ELSE 1 END AS INTEGER) AS sentiment,
       CASE WHEN a.l_linestatus = 'F' THEN 'body' ELSE 'title' END AS origin
FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND a.l_linenumber < b.l_linenumber
JOIN orders o ON a.l_orderkey = o.o_orderkey""")
    cte(f"wdir_{_kind}", f"""
SELECT src, dst, CAST(count(*) AS BIGINT) AS weight FROM links_{_kind}
WHERE sentiment IS DISTINCT FROM -1 GROUP BY src, dst""", [f"links_{_kind}"])
    # H1: undirected weighted graph, weight = min of the two directions, u <= v
    cte(f"edges_{_kind}", f"""
SELECT a.src AS u, a.dst AS v, least(a.weight, b.weight) AS weight
FROM wdir_{_kind} a JOIN wdir_{_kind} b ON a.src = b.dst AND a.dst = b.src
WHERE a.src <= a.dst""", [f"wdir_{_kind}"])
    # symmetric view: both orientations, a self-loop once
    cte(f"sym_{_kind}", f"""
SELECT u AS src, v AS dst, weight FROM edges_{_kind}
UNION ALL SELECT v AS src, u AS dst, weight FROM edges_{_kind} WHERE u <> v""", [f"edges_{_kind}"])
    cte(f"nodes_{_kind}", f"""
SELECT u AS node FROM edges_{_kind} UNION SELECT v AS node FROM edges_{_kind}""", [f"edges_{_kind}"])

cte("points", """
SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS features FROM embeddings""")

cte("labeled_base", f"""
SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS features,
       CAST(CASE WHEN label < 5 THEN -1 ELSE 1 END AS INTEGER) AS y_true,
       {sql_hash_uniform('vec_id', 1)} AS _u
FROM embeddings""")
cte("labeled_points", """
SELECT b.id, b.features,
       CAST(CASE WHEN b._u < 0.03 OR f.id IS NOT NULL THEN b.y_true ELSE 0 END AS INTEGER) AS label,
       b.y_true, (b._u < 0.03 OR f.id IS NOT NULL) AS is_labeled
FROM labeled_base b LEFT JOIN (SELECT id FROM labeled_base ORDER BY _u, id LIMIT 4) f ON b.id = f.id""",
    ["labeled_base"])

cte("census_like", """
SELECT c.c_custkey,
       CASE WHEN c.c_custkey % 17 = 0 THEN NULL ELSE c.c_mktsegment END AS c_mktsegment,
       n.n_name,
       CAST(coalesce(o.n_orders, 0) AS BIGINT) AS n_orders,
       coalesce(o.total_spent, 0.0) AS total_spent,
       CASE WHEN c.c_acctbal > (SELECT avg(c_acctbal) FROM customer) THEN '>avg' ELSE '<=avg' END AS target
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN (SELECT o_custkey, count(*) AS n_orders, sum(o_totalprice) AS total_spent
           FROM orders GROUP BY o_custkey) o ON c.c_custkey = o.o_custkey""")


ORACLE: dict[str, str] = {}


def register(name: str, body: str, *ctes: str) -> None:
    ORACLE[name] = with_ctes(body, *ctes)


# ------------------------------------------------------------------ graph CTEs

for _kind in ("part", "supp"):
    cte(f"degree_{_kind}", f"""
SELECT node, CAST(sum(c) AS BIGINT) AS degree FROM (
  SELECT u AS node, CASE WHEN u = v THEN 2 ELSE 1 END AS c FROM edges_{_kind}
  UNION ALL SELECT v, 1 FROM edges_{_kind} WHERE u <> v) GROUP BY node""", [f"edges_{_kind}"])
    cte(f"strength_{_kind}", f"""
SELECT src AS node, CAST(sum(weight) AS DOUBLE) AS strength FROM sym_{_kind} GROUP BY src""", [f"sym_{_kind}"])
    cte(f"wdeg_{_kind}", f"""
SELECT node, CAST(sum(w) AS DOUBLE) AS weighted_degree FROM (
  SELECT u AS node, weight * CASE WHEN u = v THEN 2 ELSE 1 END AS w FROM edges_{_kind}
  UNION ALL SELECT v, weight FROM edges_{_kind} WHERE u <> v) GROUP BY node""", [f"edges_{_kind}"])
    cte(f"simple_{_kind}", f"""
SELECT DISTINCT least(u, v) AS u, greatest(u, v) AS v FROM edges_{_kind} WHERE u <> v""", [f"edges_{_kind}"])
    cte(f"nb_{_kind}", f"""
SELECT u AS a, v AS b FROM simple_{_kind} UNION ALL SELECT v, u FROM simple_{_kind}""", [f"simple_{_kind}"])
    cte(f"clustering_{_kind}", f"""
SELECT n.node,
       CASE WHEN coalesce(d.d, 0) < 2 THEN 0.0
            ELSE 2.0 * coalesce(t.t, 0) / (d.d * (d.d - 1)) END AS clustering
FROM nodes_{_kind} n
LEFT JOIN (SELECT a AS node, count(*) AS d FROM nb_{_kind} GROUP BY a) d ON n.node = d.node
LEFT JOIN (SELECT x.a AS node, count(*) AS t FROM nb_{_kind} x JOIN nb_{_kind} y ON x.a = y.a AND x.b < y.b
           JOIN simple_{_kind} s ON s.u = x.b AND s.v = y.b GROUP BY x.a) t ON n.node = t.node""",
        [f"nodes_{_kind}", f"nb_{_kind}", f"simple_{_kind}"])
    cte(f"comp_{_kind}", f"""
SELECT node, min(root) AS component FROM (
  WITH RECURSIVE reach(node, root) AS (
    SELECT node, node FROM nodes_{_kind}
    UNION
    SELECT s.dst, r.root FROM reach r JOIN sym_{_kind} s ON r.node = s.src)
  SELECT node, root FROM reach) GROUP BY node""", [f"nodes_{_kind}", f"sym_{_kind}"])
    cte(f"trans_{_kind}", f"""
SELECT s.src, s.dst, CAST(s.weight AS DOUBLE) / o.sw AS t
FROM sym_{_kind} s JOIN (SELECT src, sum(weight) AS sw FROM sym_{_kind} GROUP BY src) o ON s.src = o.src
WHERE o.sw > 0""", [f"sym_{_kind}"])
    cte(f"ddist_{_kind}", f"""
SELECT degree, n_nodes, n_nodes / tot AS share, cum / tot AS cdf, (tot - cum) / tot AS ccdf FROM (
  SELECT degree, n_nodes, CAST(sum(n_nodes) OVER (ORDER BY degree) AS DOUBLE) AS cum,
         CAST(sum(n_nodes) OVER () AS DOUBLE) AS tot
  FROM (SELECT degree, CAST(count(*) AS BIGINT) AS n_nodes FROM degree_{_kind} GROUP BY degree))""",
        [f"degree_{_kind}"])


def pagerank_sql(kind: str, rounds: int, damping: float = 0.85) -> str:
    """Unrolled PageRank CTE chain ending in pr{rounds}(node, x)."""
    parts = [f"pr0 AS MATERIALIZED (SELECT node, 1.0 / (SELECT count(*) FROM nodes_{kind}) AS x FROM nodes_{kind})"]
    for k in range(1, rounds + 1):
        parts.append(f"""pr{k} AS MATERIALIZED (
  SELECT n.node, {damping} * coalesce(y.y, 0.0) + {1 - damping} / (SELECT count(*) FROM nodes_{kind}) AS x
  FROM nodes_{kind} n LEFT JOIN (SELECT t.dst AS node, sum(p.x * t.t) AS y FROM trans_{kind} t
  JOIN pr{k - 1} p ON t.src = p.node GROUP BY t.dst) y ON n.node = y.node)""")
    return ",\n".join(parts)


def hits_sql(kind: str, rounds: int) -> str:
    """Unrolled HITS CTE chain ending in h{rounds}, a{rounds} (node, x)."""
    def spread(src: str, name: str) -> str:
        return f"""{name}_raw AS MATERIALIZED (
  SELECT n.node, coalesce(y.y, 0.0) AS x FROM nodes_{kind} n LEFT JOIN (
  SELECT s.dst AS node, sum(p.x) AS y FROM sym_{kind} s JOIN {src} p ON s.src = p.node GROUP BY s.dst) y
  ON n.node = y.node),
{name} AS MATERIALIZED (SELECT node, x / (SELECT sum(x) FROM {name}_raw) AS x FROM {name}_raw)"""
    parts = [f"h0 AS MATERIALIZED (SELECT node, 1.0 / (SELECT count(*) FROM nodes_{kind}) AS x FROM nodes_{kind})"]
    for k in range(1, rounds + 1):
        parts.append(spread(f"h{k - 1}", f"a{k}"))
        parts.append(spread(f"a{k}", f"h{k}"))
    return ",\n".join(parts)


def register_chain(name: str, chain: str, body: str, *ctes: str) -> None:
    """Register SQL whose body needs a generated CTE chain after the fixtures."""
    base = with_ctes("", *ctes).rstrip()
    if base:
        ORACLE[name] = f"{base},\n{chain}\n{body}"
    else:
        ORACLE[name] = f"WITH {chain}\n{body}"

"""Registered link-prediction queries (sparse part graph)."""

from __future__ import annotations

from pyspark.sql import functions as F

from meridian.functions.draws import sql_hash_keys
from meridian.operators import linkpred as LP
from meridian.operators.graph import build as GB
from meridian.operators.graph.wedges import common_neighbor_pairs
from meridian.plans import oracle as O
from meridian.plans.catalog import query, rnd
from meridian.plans.iterate import cut
from meridian.sources import testdata as T

N_THRESHOLDS = 101     # the reference passes num_thresholds + 1
SEED = 12345

# ---- SQL: split, graphs, scores -------------------------------------------------
O.cte("lp_graph", "SELECT u, v, weight FROM edges_supp", ["edges_supp"])
O.cte("lp_degree", """
SELECT node, CAST(sum(c) AS BIGINT) AS degree FROM (
  SELECT u AS node, CASE WHEN u = v THEN 2 ELSE 1 END AS c FROM lp_graph
  UNION ALL SELECT v, 1 FROM lp_graph WHERE u <> v) GROUP BY node""", ["lp_graph"])
O.cte("lp_simple", "SELECT DISTINCT least(u, v) AS u, greatest(u, v) AS v FROM lp_graph WHERE u <> v", ["lp_graph"])
O.cte("lp_e", f"""
SELECT s.u, s.v, (du.degree > 1 AND dv.degree > 1) AS ok,
       {sql_hash_keys(['s.u', 's.v'], SEED)} AS h1, {sql_hash_keys(['s.u', 's.v'], SEED + 1)} AS h2
FROM lp_simple s JOIN lp_degree du ON s.u = du.node JOIN lp_degree dv ON s.v = dv.node""",
      ["lp_simple", "lp_degree"])
O.cte("lp_test", """
SELECT u, v FROM (SELECT u, v, row_number() OVER (ORDER BY h1, u, v) AS rn FROM lp_e WHERE ok)
WHERE rn <= (SELECT floor(CAST(0.2 AS DOUBLE) * count(*)) FROM lp_e)""", ["lp_e"])
O.cte("lp_rest", "SELECT * FROM lp_e e WHERE NOT EXISTS (SELECT 1 FROM lp_test t WHERE t.u = e.u AND t.v = e.v)",
      ["lp_e", "lp_test"])
O.cte("lp_val", """
SELECT u, v FROM (SELECT u, v, row_number() OVER (ORDER BY h2, u, v) AS rn FROM lp_rest WHERE ok)
WHERE rn <= (SELECT floor(CAST(0.2 AS DOUBLE) * count(*)) FROM lp_rest)""", ["lp_rest"])
O.cte("lp_train", """
SELECT u, v FROM lp_rest r WHERE NOT EXISTS (SELECT 1 FROM lp_val t WHERE t.u = r.u AND t.v = r.v)""",
      ["lp_rest", "lp_val"])
O.cte("lp_trainval", "SELECT u, v FROM lp_train UNION ALL SELECT u, v FROM lp_val", ["lp_train", "lp_val"])

for _g in ("train", "trainval"):
    O.cte(f"lp_sym_{_g}", f"SELECT u AS src, v AS dst FROM lp_{_g} UNION ALL SELECT v, u FROM lp_{_g}", [f"lp_{_g}"])
    O.cte(f"lp_deg_{_g}", f"SELECT src AS node, count(*) AS k FROM lp_sym_{_g} GROUP BY src", [f"lp_sym_{_g}"])
    O.cte(f"lp_ns_{_g}", f"""
SELECT w.u, w.v, w.cn, w.ra, w.aa, w.cn / (du.k + dv.k - w.cn) AS jaccard FROM (
  SELECT a.dst AS u, b.dst AS v, count(*) AS cn, sum(1.0 / d.k) AS ra, sum(1.0 / ln(d.k)) AS aa
  FROM lp_sym_{_g} a JOIN lp_sym_{_g} b ON a.src = b.src AND a.dst < b.dst JOIN lp_deg_{_g} d ON a.src = d.node
  GROUP BY a.dst, b.dst) w
JOIN lp_deg_{_g} du ON w.u = du.node JOIN lp_deg_{_g} dv ON w.v = dv.node
WHERE NOT EXISTS (SELECT 1 FROM lp_{_g} e WHERE e.u = w.u AND e.v = w.v)""", [f"lp_sym_{_g}", f"lp_deg_{_g}"])
    O.cte(f"lp_lp_{_g}", f"""
SELECT i AS u, j AS v, sum(v) AS score FROM (
  SELECT a.src AS i, b.dst AS j, 1.0 AS v FROM lp_sym_{_g} a JOIN lp_sym_{_g} b ON a.dst = b.src
  UNION ALL
  SELECT a.src, c.dst, 1.0 FROM lp_sym_{_g} a JOIN lp_sym_{_g} b ON a.dst = b.src JOIN lp_sym_{_g} c ON b.dst = c.src)
WHERE i < j GROUP BY i, j""", [f"lp_sym_{_g}"])

COMPARED = ("jaccard", "resource_allocation", "adamic_adar", "local_path", "rwr")
METHODS = {"jaccard": "jaccard", "resource_allocation": "ra", "adamic_adar": "aa"}


def _scores_cte(method: str, g: str) -> str:
    if method == "local_path":
        return f"lp_lp_{g}"
    if method == "rwr":
        return f"lp_rwr_{g}"
    return f"(SELECT u, v, {METHODS[method]} AS score FROM lp_ns_{g})"


def _flagged_cte(method: str) -> str:
    return f"""(SELECT s.u, s.v, s.score,
  CAST(CASE WHEN EXISTS (SELECT 1 FROM lp_train t WHERE t.u = s.u AND t.v = s.v) THEN 0
       WHEN EXISTS (SELECT 1 FROM lp_val t WHERE t.u = s.u AND t.v = s.v) THEN 1 ELSE 2 END AS INTEGER) AS flag
  FROM {_scores_cte(method, 'train')} s WHERE s.score > 0)"""


def _metrics_sql(method: str) -> str:
    n = N_THRESHOLDS
    return f"""
WITH fl AS ({_flagged_cte(method)}),
ab AS (SELECT min(score) AS a, max(score) AS b FROM fl),
th AS (SELECT DISTINCT ab.a + r.range * (ab.b - ab.a) / {n} AS threshold FROM ab, range(1, {n}) r),
conf AS (SELECT th.threshold,
    CAST(count(CASE WHEN fl.score >= th.threshold AND fl.flag = 1 THEN 1 END) AS BIGINT) AS tp,
    CAST(count(CASE WHEN fl.score >= th.threshold AND fl.flag = 2 THEN 1 END) AS BIGINT) AS fp,
    CAST(count(CASE WHEN fl.score < th.threshold AND fl.flag = 2 THEN 1 END) AS BIGINT) AS tn,
    CAST(count(CASE WHEN fl.score < th.threshold AND fl.flag = 1 THEN 1 END) AS BIGINT) AS fn
  FROM th LEFT JOIN fl ON fl.flag <> 0 GROUP BY th.threshold),
m1 AS (SELECT *, CASE WHEN tp + fp <> 0 THEN tp / (tp + fp) ELSE 0.0 END AS precision,
                 CASE WHEN tp + fn <> 0 THEN tp / (tp + fn) ELSE 0.0 END AS recall,
                 CASE WHEN fp + tn <> 0 THEN fp / (fp + tn) ELSE 0.0 END AS fpr FROM conf),
met AS (SELECT *, CASE WHEN precision + recall <> 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END
               AS f1 FROM m1),
best AS (SELECT threshold FROM met ORDER BY fpr * fpr + (1 - recall) * (1 - recall), threshold DESC LIMIT 1)"""


_LP_CTES = ("lp_train", "lp_val", "lp_test", "lp_trainval", "lp_ns_train", "lp_ns_trainval", "lp_lp_train",
            "lp_lp_trainval")


def _register(name: str, body: str) -> None:
    O.register(name, body, *_LP_CTES)


# ---- Spark side -------------------------------------------------------------------

def _split(spark, d):
    """Train / validation / test tables (checkpointed by ``edge_split``)."""
    return LP.edge_split(cut(GB.build_graph(T.links(spark, d, "supp"))), seed=SEED)


def _as_edges(df):
    return df.select("u", "v", F.lit(1).cast("bigint").alias("weight"))


def _scores(method: str, graph, near=None):
    e = _as_edges(graph)
    if method == "local_path":
        return LP.local_path_score(e)
    if method == "rwr":
        return LP.rwr_score(e)
    fn = {"jaccard": LP.jaccard_score, "resource_allocation": LP.resource_allocation_score,
          "adamic_adar": LP.adamic_adar_score}[method]
    return fn(e, near)


def _flagged(spark, d, method, split=None):
    tr, va, _ = split or _split(spark, d)
    return LP.flag_pairs(_scores(method, tr), tr, va)


def _metrics(spark, d, method, split=None, near=None):
    tr, va, _ = split or _split(spark, d)
    return LP.evaluate_link_predictor(_scores(method, tr, near), tr, va, N_THRESHOLDS, method)


def _round_metrics(m):
    return m.select(rnd("threshold").alias("threshold"), "tp", "fp", "tn", "fn",
                    rnd("precision").alias("precision"), rnd("recall").alias("recall"),
                    rnd("f1").alias("f1"), rnd("fpr").alias("fpr"))


_register("edge_split", """
SELECT u, v, 'train' AS part FROM lp_train UNION ALL SELECT u, v, 'validation' FROM lp_val
UNION ALL SELECT u, v, 'test' FROM lp_test""")


@query("edge_split")
def q_split(spark, d):
    tr, va, te = _split(spark, d)
    return (tr.withColumn("part", F.lit("train")).unionByName(va.withColumn("part", F.lit("validation")))
            .unionByName(te.withColumn("part", F.lit("test"))))


@query("common_neighbor_pairs", """
SELECT x.b AS u, y.b AS v, x.a AS w FROM nb_part x JOIN nb_part y ON x.a = y.a AND x.b < y.b""",
       ("nb_part",))
def q_cn_pairs(spark, d):
    e = GB.build_graph(T.links(spark, d, "part"))
    return common_neighbor_pairs(GB.symmetric(e))


for _m in ("jaccard", "resource_allocation", "adamic_adar", "local_path"):
    _register(f"{_m}_score", f"SELECT u, v, round(score, 6) AS score FROM {_scores_cte(_m, 'train')}")

    def _mk(m):
        def run(spark, d):
            tr, _, _ = _split(spark, d)
            return _scores(m, tr).withColumn("score", rnd("score"))
        return run
    query(f"{_m}_score")(_mk(_m))


_register("flag_candidate_pairs", f"SELECT u, v, round(score, 6) AS score, flag FROM {_flagged_cte('jaccard')}")


@query("flag_candidate_pairs")
def q_flag(spark, d):
    return _flagged(spark, d, "jaccard").select("u", "v", rnd("score").alias("score"), "flag")


_register("score_thresholds", _metrics_sql("jaccard") + "\nSELECT round(threshold, 6) AS threshold FROM th")


@query("score_thresholds")
def q_thresholds(spark, d):
    _, _, ts = LP.score_thresholds(_flagged(spark, d, "jaccard"), N_THRESHOLDS)
    return spark.createDataFrame([(round(t, 6),) for t in ts], "threshold double")


_register("threshold_confusion", _metrics_sql("resource_allocation")
          + "\nSELECT round(threshold, 6) AS threshold, tp, fp, tn, fn FROM conf")


@query("threshold_confusion")
def q_confusion(spark, d):
    c = LP.threshold_confusion(_flagged(spark, d, "resource_allocation"), N_THRESHOLDS)
    return c.withColumn("threshold", rnd("threshold"))


_MET_COLS = ("round(threshold, 6) AS threshold, tp, fp, tn, fn, round(precision, 6) AS precision, "
             "round(recall, 6) AS recall, round(f1, 6) AS f1, round(fpr, 6) AS fpr")

_register("threshold_metrics", _metrics_sql("adamic_adar") + f"\nSELECT {_MET_COLS} FROM met")


@query("threshold_metrics")
def q_metrics(spark, d):
    return _round_metrics(_metrics(spark, d, "adamic_adar"))


_register("best_threshold", _metrics_sql("jaccard") + f"\nSELECT {_MET_COLS} FROM met WHERE threshold IN "
          "(SELECT threshold FROM best)")


@query("best_threshold")
def q_best(spark, d):
    return _round_metrics(_metrics(spark, d, "jaccard").filter("best"))


_register("predicted_links", _metrics_sql("jaccard") + "\nSELECT u, v, round(score, 6) AS score FROM fl "
          "WHERE flag <> 0 AND score >= (SELECT threshold FROM best)")


@query("predicted_links")
def q_predicted(spark, d):
    split = _split(spark, d)
    m = _metrics(spark, d, "jaccard", split)
    t = m.filter("best").first().threshold
    return LP.predicted_links(_flagged(spark, d, "jaccard", split), t).withColumn("score", rnd("score"))


_register("evaluate_link_predictor", _metrics_sql("local_path")
          + f"\nSELECT {_MET_COLS}, threshold IN (SELECT threshold FROM best) AS best FROM met")


@query("evaluate_link_predictor")
def q_evaluate(spark, d):
    m = _metrics(spark, d, "local_path")
    return _round_metrics(m).join(m.select(rnd("threshold").alias("threshold"), "best"), "threshold")


def _union_sql(select: str) -> str:
    parts = []
    for m in COMPARED:
        parts.append(f"SELECT * FROM ({_metrics_sql(m)}\nSELECT '{m}' AS method, {select})")
    return "\nUNION ALL\n".join(parts)


@query("roc_points")
def q_roc(spark, d):
    split = _split(spark, d)
    near = LP.neighbour_scores(_as_edges(split[0]))
    ms = [_metrics(spark, d, m, split, near) for m in COMPARED]
    r = LP.roc_points(ms)
    return r.select("method", rnd("threshold").alias("threshold"), rnd("fpr").alias("fpr"),
                    rnd("recall").alias("recall"))


@query("method_comparison")
def q_method_comparison(spark, d):
    split = _split(spark, d)
    near = LP.neighbour_scores(_as_edges(split[0]))
    ms = [_metrics(spark, d, m, split, near) for m in COMPARED]
    r = LP.method_comparison(ms)
    return r.select("method", *[rnd(c).alias(c) for c in ("threshold", "precision", "recall", "f1", "fpr")])


@query("test_evaluation")
def q_test_eval(spark, d):
    """Every method at the threshold that validation chose, on the train and validation graph."""
    split = _split(spark, d)
    tr, va, te = split
    tv = cut(tr.unionByName(va))
    near, near_tv = (LP.neighbour_scores(_as_edges(x)) for x in (tr, tv))
    out = None
    for m in COMPARED:
        t = _metrics(spark, d, m, split, near).filter("best").first().threshold
        r = _round_metrics(LP.test_evaluation(_scores(m, tv, near_tv), tv, te, t)).withColumn("method", F.lit(m))
        out = r if out is None else out.unionByName(r)
    return out


def _test_sql(method: str) -> str:
    return _metrics_sql(method) + f""",
tf AS (SELECT s.u, s.v, s.score,
  CASE WHEN EXISTS (SELECT 1 FROM lp_trainval t WHERE t.u = s.u AND t.v = s.v) THEN 0
       WHEN EXISTS (SELECT 1 FROM lp_test t WHERE t.u = s.u AND t.v = s.v) THEN 1 ELSE 2 END AS flag
  FROM {_scores_cte(method, 'trainval')} s WHERE s.score > 0),
tc AS (SELECT (SELECT threshold FROM best) AS threshold,
  CAST(count(CASE WHEN score >= (SELECT threshold FROM best) AND flag = 1 THEN 1 END) AS BIGINT) AS tp,
  CAST(count(CASE WHEN score >= (SELECT threshold FROM best) AND flag = 2 THEN 1 END) AS BIGINT) AS fp,
  CAST(count(CASE WHEN score < (SELECT threshold FROM best) AND flag = 2 THEN 1 END) AS BIGINT) AS tn,
  CAST(count(CASE WHEN score < (SELECT threshold FROM best) AND flag = 1 THEN 1 END) AS BIGINT) AS fn
  FROM tf WHERE flag <> 0),
tm AS (SELECT *, CASE WHEN tp + fp <> 0 THEN tp / (tp + fp) ELSE 0.0 END AS precision,
                 CASE WHEN tp + fn <> 0 THEN tp / (tp + fn) ELSE 0.0 END AS recall,
                 CASE WHEN fp + tn <> 0 THEN fp / (fp + tn) ELSE 0.0 END AS fpr FROM tc)
SELECT round(threshold, 6) AS threshold, tp, fp, tn, fn, round(precision, 6) AS precision,
       round(recall, 6) AS recall,
       round(CASE WHEN precision + recall <> 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END, 6)
         AS f1, round(fpr, 6) AS fpr, '{method}' AS method FROM tm"""


def register_comparisons() -> None:
    """SQL of the queries over all methods; called when the walks' SQL tables exist."""
    ctes = (*_LP_CTES, "lp_rwr_train", "lp_rwr_trainval")
    O.register("roc_points", _union_sql("round(threshold, 6) AS threshold, round(fpr, 6) AS fpr, "
                                        "round(recall, 6) AS recall FROM met"), *ctes)
    O.register("method_comparison", _union_sql(
        "round(threshold, 6) AS threshold, round(precision, 6) AS precision, round(recall, 6) AS recall, "
        "round(f1, 6) AS f1, round(fpr, 6) AS fpr FROM met WHERE threshold IN (SELECT threshold FROM best)"), *ctes)
    O.register("test_evaluation", "\nUNION ALL\n".join(f"SELECT * FROM ({_test_sql(m)})" for m in COMPARED), *ctes)

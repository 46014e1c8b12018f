"""Registered community, spectral, robustness, null-model and ranking queries."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import functions as F

from meridian.functions.draws import sql_hash_uniform
from meridian.operators.graph import build as GB
from meridian.operators.graph import community as CM
from meridian.operators.graph import components as GC
from meridian.operators.graph import degree as GD
from meridian.operators.graph import null as NL
from meridian.operators.graph import rank as GR
from meridian.operators.graph import robustness as RB
from meridian.operators.graph import spectral as SP
from meridian.plans import oracle as O
from meridian.plans.catalog import query, rnd
from meridian.plans.catalog_graph import _MOMENTS
from meridian.plans.iterate import cut
from meridian.sources import testdata as T

PPR_SQL = 160        # rounds of the unrolled SQL, settled far below the printed digits
RESIDUAL = 1e-11
TOPK = 2
NULL_REPLICAS = 100


def _edges(spark, d, kind="supp"):
    return cut(GB.build_graph(T.links(spark, d, kind)))


@query("modularity", """
WITH c AS (SELECT node, component AS c FROM comp_part),
m AS (SELECT sum(weight) AS m FROM edges_part),
inside AS (SELECT sum(e.weight) AS l FROM edges_part e JOIN c cu ON e.u = cu.node JOIN c cv ON e.v = cv.node
           WHERE cu.c = cv.c),
s AS (SELECT c.c, sum(w.weighted_degree) AS s FROM wdeg_part w JOIN c ON w.node = c.node GROUP BY c.c)
SELECT round((SELECT l FROM inside) / (SELECT m FROM m)
             - (SELECT sum(s * s) FROM s) / (4.0 * (SELECT m FROM m) * (SELECT m FROM m)), 6) AS modularity""",
       ("comp_part", "edges_part", "wdeg_part"))
def q_modularity(spark, d):
    e = _edges(spark, d, "part")
    comp = GC.connected_components(e).withColumnRenamed("component", "community")
    return spark.createDataFrame([(round(CM.modularity(e, comp), 6),)], "modularity double")


@query("louvain")
def q_louvain(spark, d):
    e = _edges(spark, d, "part")
    lab = CM.louvain(e)
    q = CM.modularity(e, lab)
    return lab.withColumn("modularity", F.lit(q))


@query("louvain_invariants", """
SELECT CAST(count(*) AS BIGINT) AS nodes, CAST(count(*) AS BIGINT) AS labelled, true AS above_single_nodes, true AS inside_components
FROM nodes_part""", ("nodes_part",))
def q_louvain_invariants(spark, d):
    """A partition of all nodes, better than single nodes, no community in two components."""
    e = _edges(spark, d, "part")
    lab = cut(CM.louvain(e))
    single = CM.modularity(e, GB.nodes(e).withColumn("community", F.col("node")))
    spread = lab.join(GC.connected_components(e), "node").groupBy("community").agg(F.countDistinct("component").alias("n")).where("n > 1")
    row = (GB.nodes(e).count(), lab.select("node").distinct().count(), CM.modularity(e, lab) > single, spread.isEmpty())
    return spark.createDataFrame([row], "nodes long, labelled long, above_single_nodes boolean, inside_components boolean")


@query("community_modularity_summary")
def q_louvain_summary(spark, d):
    from meridian.operators import relational as R
    e = _edges(spark, d, "part")
    lab = cut(CM.louvain(e))
    s = R.community_summary(lab).first()
    return spark.createDataFrame([(s.n_communities, s.largest_size, CM.modularity(e, lab))],
                                 "n_communities bigint, largest_size bigint, modularity double")


O.cte("co_runs", """
SELECT 0 AS run, node, component AS community FROM comp_supp
UNION ALL SELECT 1, node, degree FROM degree_supp
UNION ALL SELECT 2, node, node % 3 FROM nodes_supp""", ["comp_supp", "degree_supp", "nodes_supp"])


@query("co_association", """
SELECT e.u, e.v, round(sum(CASE WHEN a.community = b.community THEN 1 ELSE 0 END) / 3.0, 6) AS share
FROM edges_supp e JOIN co_runs a ON e.u = a.node JOIN co_runs b ON e.v = b.node AND a.run = b.run
GROUP BY e.u, e.v""", ("edges_supp", "co_runs"))
def q_co_association(spark, d):
    e = _edges(spark, d)
    runs = (GC.connected_components(e).select(F.lit(0).alias("run"), "node", F.col("component").alias("community"))
            .unionByName(GD.degree(e).select(F.lit(1).alias("run"), "node", F.col("degree").alias("community")))
            .unionByName(GB.nodes(e).select(F.lit(2).alias("run"), "node", (F.col("node") % 3).alias("community"))))
    return CM.co_association(runs, e, 3).withColumn("share", rnd("share"))


@query("consensus_clustering")
def q_consensus(spark, d):
    e = _edges(spark, d, "part")
    lab = CM.consensus_clustering(e, runs=5)
    return lab.withColumn("modularity", F.lit(CM.modularity(e, lab)))


@query("authority_shifting")
def q_authority(spark, d):
    e = _edges(spark, d, "part")
    lab = CM.authority_shifting(e, k=TOPK)
    return lab.withColumn("modularity", F.lit(CM.modularity(e, lab)))


# ------------------------------------------------------------ personalised PageRank

def _ppr_sql(rounds: int) -> str:
    parts = ["ppr0 AS MATERIALIZED (SELECT node AS seed, node, 1.0 AS x FROM nodes_supp)"]
    for k in range(1, rounds + 1):
        mv = (f"(SELECT p.seed, t.dst AS node, sum(p.x * t.t) AS y FROM ppr{k - 1} p "
              f"JOIN trans_supp t ON p.node = t.src GROUP BY p.seed, t.dst)")
        parts.append(f"""ppr{k} AS MATERIALIZED (
  SELECT seed, node, sum(x) AS x FROM (
    SELECT seed, node, 0.85 * y AS x FROM {mv}
    UNION ALL
    SELECT s.node, s.node, 1 - 0.85 * coalesce(m.tot, 0.0) FROM nodes_supp s
    LEFT JOIN (SELECT seed, sum(y) AS tot FROM {mv} GROUP BY seed) m ON s.node = m.seed)
  GROUP BY seed, node)""")
    return ",\n".join(parts)


O.register_chain("topk_per_seed", _ppr_sql(PPR_SQL), f"""
SELECT seed, node, round(x, 6) AS score, rank FROM (
  SELECT seed, node, x, row_number() OVER (PARTITION BY seed ORDER BY x DESC, node) AS rank FROM ppr{PPR_SQL})
WHERE rank <= {TOPK}""", "nodes_supp", "trans_supp")


@query("topk_per_seed")
def q_topk_seed(spark, d):
    e = _edges(spark, d)
    seeds = GB.nodes(e).select(F.col("node").alias("seed"))
    top = GR.topk_ppr(GR.personalized_pagerank(e, seeds, residual=RESIDUAL), TOPK)
    return top.select("seed", "node", rnd("score").alias("score"), "rank")


O.register_chain("personalized_pagerank", _ppr_sql(PPR_SQL),
                 f"SELECT seed, node, round(x, 6) AS score FROM ppr{PPR_SQL} WHERE seed IN (1, 7)",
                 "nodes_supp", "trans_supp")


@query("personalized_pagerank")
def q_ppr(spark, d):
    e = _edges(spark, d)
    seeds = spark.createDataFrame([(1,), (7,)], "seed long")
    seeds = seeds.join(GB.nodes(e).select(F.col("node").alias("seed")), "seed", "left_semi")
    return GR.personalized_pagerank(e, seeds).withColumn("score", rnd("score"))


O.register_chain("centrality_comparison", O.pagerank_sql("supp", 60) + ",\n" + O.hits_sql("supp", 20), f"""
SELECT d.node, round(d.degree / ((SELECT count(*) FROM nodes_supp) - 1.0), 6) AS degree_centrality,
       round(p.x, 6) AS pagerank, round(h.x, 6) AS hub, round(a.x, 6) AS authority
FROM degree_supp d JOIN pr60 p ON d.node = p.node JOIN h20 h ON d.node = h.node
JOIN a20 a ON d.node = a.node""", "degree_supp", "nodes_supp", "trans_supp", "sym_supp")


@query("centrality_comparison")
def q_centrality(spark, d):
    e = _edges(spark, d)
    return GR.centrality_comparison(e).select("node", *[rnd(c).alias(c) for c in ("degree_centrality", "pagerank", "hub", "authority")])


def _register_rwr():
    from meridian.plans import catalog_linkpred  # noqa: F401  (its SQL tables)
    O.cte("rwr_trans", "SELECT s.src, s.dst, 1.0 / d.k AS t FROM lp_sym_train s JOIN lp_deg_train d ON s.src = d.node",
          ["lp_sym_train", "lp_deg_train"])
    chain = _ppr_sql(PPR_SQL).replace("nodes_supp", "(SELECT node FROM lp_deg_train)").replace("trans_supp", "rwr_trans")
    chain_tv = chain.replace("rwr_trans", "rwr_trans_tv").replace("lp_deg_train", "lp_deg_trainval")
    O.cte("rwr_trans_tv", "SELECT s.src, s.dst, 1.0 / d.k AS t FROM lp_sym_trainval s JOIN lp_deg_trainval d ON s.src = d.node",
          ["lp_sym_trainval", "lp_deg_trainval"])
    for g, c, t in (("train", chain, "rwr_trans"), ("trainval", chain_tv, "rwr_trans_tv")):
        O.cte(f"lp_rwr_{g}", f"""
WITH {c}
SELECT a.seed AS u, a.node AS v, a.x + coalesce(b.x, 0.0) AS score
FROM ppr{PPR_SQL} a LEFT JOIN ppr{PPR_SQL} b ON a.seed = b.node AND a.node = b.seed WHERE a.seed < a.node""", [t, f"lp_deg_{g}"])
    catalog_linkpred.register_comparisons()
    O.register_chain("rwr_score", chain, f"""
SELECT a.seed AS u, a.node AS v, round(a.x + coalesce(b.x, 0.0), 6) AS score
FROM ppr{PPR_SQL} a LEFT JOIN ppr{PPR_SQL} b ON a.seed = b.node AND a.node = b.seed WHERE a.seed < a.node""",
                     "rwr_trans", "lp_deg_train")


_register_rwr()


@query("rwr_score")
def q_rwr(spark, d):
    from meridian.operators import linkpred as LP
    from meridian.plans.catalog_linkpred import _split
    tr, _, _ = _split(spark, d)
    e = tr.select("u", "v", F.lit(1).cast("bigint").alias("weight"))
    return LP.rwr_score(e).withColumn("score", rnd("score"))


# ------------------------------------------------------------ spectral

@query("random_walk_laplacian", """
WITH a AS (SELECT src AS i, dst AS j, CAST(weight AS DOUBLE) AS v FROM sym_supp),
d AS (SELECT i, sum(v) AS d FROM a GROUP BY i)
SELECT i, j, round(sum(v), 6) AS v FROM (
  SELECT a.i, a.j, -a.v / d.d AS v FROM a JOIN d ON a.i = d.i UNION ALL SELECT i, i, 1.0 FROM d)
GROUP BY i, j""", ("sym_supp",))
def q_rwl(spark, d):
    return SP.random_walk_laplacian(_edges(spark, d)).withColumn("v", rnd("v"))


@query("spectral_embedding")
def q_embedding(spark, d):
    emb, _, k = SP.spectral_embedding(_edges(spark, d, "part"))
    return emb.withColumn("k", F.lit(k))


@query("spectrum_summary", """
WITH a AS (SELECT src AS i, dst AS j, CAST(weight AS DOUBLE) AS v FROM sym_part),
d AS (SELECT i, sum(v) AS d FROM a GROUP BY i),
l AS (SELECT i, j, sum(v) AS v FROM (
  SELECT a.i, a.j, -a.v / sqrt(x.d * y.d) AS v FROM a JOIN d x ON a.i = x.i JOIN d y ON a.j = y.i
  UNION ALL SELECT i, i, 1.0 FROM d) GROUP BY i, j)
SELECT (SELECT CAST(count(*) AS BIGINT) FROM d) AS n_eigenvalues,
       (SELECT CAST(count(DISTINCT component) AS BIGINT) FROM comp_part) AS n_zero,
       (SELECT round(sum(v), 6) FROM l WHERE i = j) AS sum_values,
       (SELECT round(sum(v * v), 6) FROM l) AS sum_squares, 0.0 AS residual""", ("sym_part", "comp_part"))
def q_spectrum(spark, d):
    values, _ = SP.spectrum(_edges(spark, d, "part"))
    v = F.col("value")
    return values.agg(F.count(v).alias("n_eigenvalues"), F.sum(F.when(F.abs(v) < 1e-9, 1).otherwise(0)).cast("bigint").alias("n_zero"),
                      F.round(F.sum(v), 6).alias("sum_values"), F.round(F.sum(v * v), 6).alias("sum_squares"),
                      F.round(F.max("residual"), 6).alias("residual"))


@query("xmeans")
def q_xmeans(spark, d):
    pts = T.points(spark, d).select(F.col("id").alias("node"), F.col("features").alias("coords"))
    return SP.xmeans(pts)


@query("spectral_clusters")
def q_spectral_clusters(spark, d):
    e = _edges(spark, d, "part")
    cl, q = SP.spectral_clusters(e)
    return cl.withColumn("modularity", F.lit(q))


# ------------------------------------------------------------ robustness

_F = ("(2 + (2 - m.g) / (3 - m.g) * 2 * (pow({x}, (3 - m.g) / (1 - m.g)) - 1) - pow({x}, (2 - m.g) / (1 - m.g)))")


@query("theoretical_thresholds", _MOMENTS.format(kind="part") + f""",
grid AS (SELECT 1e-6 + i * ((1 - 2e-6) / 20000) AS lo, 1e-6 + (i + 1) * ((1 - 2e-6) / 20000) AS hi FROM range(20000) t(i)),
root AS (SELECT lo, hi FROM grid, m WHERE {_F.format(x='lo')} * {_F.format(x='hi')} <= 0 ORDER BY abs((lo + hi) / 2 - 0.3) LIMIT 1),
half AS (
  WITH RECURSIVE b(k, lo, hi) AS (
    SELECT 0, lo, hi FROM root
    UNION ALL
    SELECT k + 1, CASE WHEN {_F.format(x='lo')} * {_F.format(x='((lo + hi) / 2)')} <= 0 THEN lo ELSE (lo + hi) / 2 END,
           CASE WHEN {_F.format(x='lo')} * {_F.format(x='((lo + hi) / 2)')} <= 0 THEN (lo + hi) / 2 ELSE hi END
    FROM b, m WHERE k < 60)
  SELECT (lo + hi) / 2 AS x FROM b WHERE k = 60)
SELECT round(1 - 1 / (k2t / k1t - 1), 6) AS fc_random, round((SELECT x FROM half), 6) AS fc_targeted,
       round(1 - 1 / (k2 / k1 - 1), 6) AS fc_random_empirical_kappa FROM m""", ("ddist_part",))
def q_thresholds(spark, d):
    e = _edges(spark, d, "part")
    m = GD.degree_moments(GD.degree(e)).first()
    th = RB.theoretical_thresholds(m.kappa_theoretical, m.gamma, m.kmin)
    emp = 1 - 1 / (m.kappa_empirical - 1) if m.kappa_empirical and m.kappa_empirical != 1 else None
    out = spark.createDataFrame([(th["fc_random"], th["fc_targeted"], emp)],
                                "fc_random double, fc_targeted double, fc_random_empirical_kappa double")
    return out.select(*[rnd(c).alias(c) for c in out.columns])


def _curve_sql(key: str, source: str) -> str:
    """Giant share and kappa after floor(f n) removals in the order of ``key``, for 20 fractions: every
    component is searched anew."""
    return f"""
WITH o AS (SELECT node, row_number() OVER (ORDER BY {key}, node) - 1 AS rank FROM {source}),
f AS (SELECT CAST(i AS DOUBLE) / 20 AS fraction, CAST(floor(CAST(i AS DOUBLE) / 20 * (SELECT count(*) FROM o)) AS BIGINT) AS n
      FROM range(20) t(i)),
e AS (SELECT f.fraction, e.u, e.v FROM f, edges_supp e JOIN o a ON e.u = a.node JOIN o b ON e.v = b.node
      WHERE a.rank >= f.n AND b.rank >= f.n),
s AS (SELECT fraction, u, v FROM e UNION SELECT fraction, v, u FROM e),
c AS (WITH RECURSIVE reach(fraction, node, root) AS (
    SELECT f.fraction, o.node, o.node FROM f JOIN o ON o.rank >= f.n
    UNION SELECT r.fraction, s.v, r.root FROM reach r JOIN s ON r.fraction = s.fraction AND r.node = s.u)
  SELECT fraction, node, min(root) AS c FROM reach GROUP BY fraction, node),
g AS (SELECT fraction, max(n) AS giant FROM (SELECT fraction, c, count(*) AS n FROM c GROUP BY fraction, c) GROUP BY fraction),
d AS (SELECT fraction, node, sum(c) AS k FROM (
  SELECT fraction, u AS node, CASE WHEN u = v THEN 2 ELSE 1 END AS c FROM e
  UNION ALL SELECT fraction, v, 1 FROM e WHERE u <> v) GROUP BY fraction, node)
SELECT round(f.fraction, 6) AS fraction, round(g.giant / (SELECT CAST(giant AS DOUBLE) FROM g WHERE fraction = 0), 6) AS giant_share,
       round(k.kappa, 6) AS kappa
FROM f JOIN g ON f.fraction = g.fraction LEFT JOIN (
  SELECT fraction, avg(k * k) / avg(k) AS kappa FROM d GROUP BY fraction) k ON f.fraction = k.fraction"""


def _rounded_curve(c):
    return c.select(*[rnd(x).alias(x) for x in ("fraction", "giant_share", "kappa")])


@query("random_removal_curve", _curve_sql(sql_hash_uniform("node", 0), "nodes_supp"), ("nodes_supp", "edges_supp"))
def q_random_curve(spark, d):
    return _rounded_curve(RB.random_removal_curve(_edges(spark, d)))


@query("removal_curve", """
SELECT CAST(count(*) AS BIGINT) AS removals, true AS falling, 1.0 AS first_share,
       round((SELECT avg(degree * degree) / avg(degree) FROM degree_supp), 6) AS first_kappa FROM nodes_supp""", ("nodes_supp", "degree_supp"))
def q_removal_curve(spark, d):
    """The curve after every single removal, and what must hold of it."""
    e = _edges(spark, d)
    c = cut(RB.removal_curve(e, RB.random_order(e)))
    from meridian.operators.scan import Ranges
    steps = Ranges(c, [F.col("n_removed")]).following("giant_share", "next")
    first = c.where("n_removed = 0").select("giant_share", rnd("kappa").alias("kappa")).first()
    rises = steps.where("next > giant_share").count()
    return spark.createDataFrame([(c.count(), rises == 0, first.giant_share, first.kappa)],
                                 "removals long, falling boolean, first_share double, first_kappa double")


@query("random_removal_kappa", f"""
WITH o AS (SELECT node, row_number() OVER (ORDER BY {sql_hash_uniform('node', 0)}, node) - 1 AS rank FROM nodes_supp),
f AS (SELECT CAST(i AS DOUBLE) / 20 AS fraction, CAST(floor(CAST(i AS DOUBLE) / 20 * (SELECT count(*) FROM o)) AS BIGINT) AS n
      FROM range(20) t(i)),
e AS (SELECT f.fraction, e.u, e.v FROM f, edges_supp e JOIN o a ON e.u = a.node JOIN o b ON e.v = b.node
      WHERE a.rank >= f.n AND b.rank >= f.n),
d AS (SELECT fraction, node, sum(c) AS k FROM (
  SELECT fraction, u AS node, CASE WHEN u = v THEN 2 ELSE 1 END AS c FROM e
  UNION ALL SELECT fraction, v, 1 FROM e WHERE u <> v) GROUP BY fraction, node)
SELECT round(f.fraction, 6) AS fraction, round(k.kappa, 6) AS kappa FROM f LEFT JOIN (
  SELECT fraction, avg(k * k) / avg(k) AS kappa FROM d GROUP BY fraction) k ON f.fraction = k.fraction""",
       ("nodes_supp", "edges_supp"))
def q_random_kappa(spark, d):
    return RB.random_removal_curve(_edges(spark, d)).select(rnd("fraction").alias("fraction"), rnd("kappa").alias("kappa"))


@query("semi_targeted_removal_curve", _curve_sql(f"-ln({sql_hash_uniform('node', 0)} + 1e-12) / degree", "degree_supp"), ("degree_supp", "edges_supp"))
def q_semi_curve(spark, d):
    return _rounded_curve(RB.semi_targeted_removal_curve(_edges(spark, d)))


@query("targeted_removal_curve")
def q_targeted_curve(spark, d):
    return RB.targeted_removal_curve(_edges(spark, d))


@query("robustness_thresholds")
def q_robust_thresholds(spark, d):
    e = _edges(spark, d)
    return (RB.empirical_thresholds(RB.random_removal_curve(e)).withColumn("removal", F.lit("random"))
            .unionByName(RB.empirical_thresholds(RB.targeted_removal_curve(e)).withColumn("removal", F.lit("targeted"))))


# ------------------------------------------------------------ null model

@query("rewired_degrees", """
SELECT n AS node, CAST(count(*) AS BIGINT) AS degree FROM (
  SELECT u AS n FROM simple_supp UNION ALL SELECT v FROM simple_supp) GROUP BY n""", ("simple_supp",))
def q_rewired_degrees(spark, d):
    rw = NL.rewire(_edges(spark, d), rounds=2, seed=1)
    ends = rw.select(F.col("u").alias("node")).unionAll(rw.select(F.col("v").alias("node")))
    return ends.groupBy("node").agg(F.count(F.lit(1)).alias("degree"))


@query("rewire_null_model")
def q_rewire(spark, d):
    return NL.rewire(_edges(spark, d), rounds=1, seed=1)


@query("knn_null_comparison")
def q_knn_null(spark, d):
    return NL.knn_null_comparison(_edges(spark, d), replicas=NULL_REPLICAS)


@query("largest_component_summary", """
WITH b AS (SELECT component FROM (SELECT component, count(*) AS n FROM comp_part GROUP BY component) ORDER BY n DESC, component LIMIT 1),
k AS (SELECT node FROM comp_part WHERE component = (SELECT component FROM b)),
e AS (SELECT u, v FROM edges_part WHERE u IN (SELECT node FROM k) AND v IN (SELECT node FROM k))
SELECT (SELECT CAST(count(*) AS BIGINT) FROM k) AS n_nodes, (SELECT CAST(count(*) AS BIGINT) FROM e) AS n_edges,
       round((SELECT count(*) FROM e WHERE u <> v) / ((SELECT count(*) FROM k) * ((SELECT count(*) FROM k) - 1) / 2.0), 6)
         AS density""", ("comp_part", "edges_part"))
def q_lcc_summary(spark, d):
    return GC.largest_component_summary(_edges(spark, d, "part")).withColumn("density", rnd("density"))


@query("node_statistics")
def q_node_stats(spark, d):
    """The measures do not wait for each other: most of their time is that of many small jobs, so they run side by side."""
    e = _edges(spark, d, "part")
    measures = (
        lambda: GD.degree_centrality(e),
        lambda: GD.clustering_coefficient(e).withColumnRenamed("clustering", "clustering_coeffs"),
        lambda: GR.pagerank(e).withColumnRenamed("pagerank", "pagerank_centrality"),
        lambda: GR.hits(e).withColumnRenamed("hub", "hub_centrality").withColumnRenamed("authority", "authority_centrality"),
        lambda: CM.louvain(e).withColumnRenamed("community", "louvain_communities"),
        lambda: CM.authority_shifting(e, k=TOPK).withColumnRenamed("community", "authority_shifting"),
        lambda: SP.spectral_clusters(e)[0].withColumnRenamed("community", "spectral_clusters"))
    with ThreadPoolExecutor(len(measures)) as pool:
        # Each thread needs its own copy of the caller's local properties.
        runs = [pool.submit(inheritable_thread_target(spark)(lambda f=f: cut(f()))) for f in measures]
        first, *others = [r.result() for r in runs]
    for m in others:
        first = first.join(m, "node", "left")
    return first

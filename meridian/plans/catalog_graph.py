"""Registered graph queries (components, degrees, clustering, ranking)."""

from __future__ import annotations

from pyspark.sql import functions as F

from meridian.operators import relational as R
from meridian.operators.graph import build as GB
from meridian.operators.graph import components as GC
from meridian.operators.graph import degree as GD
from meridian.operators.graph import rank as GR
from meridian.plans import oracle as O
from meridian.plans.catalog import query, rnd
from meridian.sources import testdata as T

# Rounds after which the unrolled SQL has settled far below the printed digits.
PR_SQL = {"supp": 60, "part": 150}
HITS_SQL = {"supp": 20, "part": 160}
TOP_NODES = 100


def edges(spark, d, kind):
    return GB.build_graph(T.links(spark, d, kind))


# ------------------------------------------------------------ components

@query("connected_components", "SELECT * FROM comp_part", ("comp_part",))
def q_components(spark, d):
    return GC.connected_components(edges(spark, d, "part"))


@query("component_size_distribution", """
SELECT size, CAST(count(*) AS BIGINT) AS n_components FROM (
  SELECT component, CAST(count(*) AS BIGINT) AS size FROM comp_part GROUP BY component) GROUP BY size""",
       ("comp_part",))
def q_comp_sizes(spark, d):
    return R.component_size_distribution(GC.connected_components(edges(spark, d, "part")))


_LARGEST = """(SELECT component FROM (SELECT component, count(*) AS size FROM comp_part GROUP BY component)
  ORDER BY size DESC, component LIMIT 1)"""


@query("largest_component", f"""
SELECT e.* FROM edges_part e
WHERE e.u IN (SELECT node FROM comp_part WHERE component = {_LARGEST})
  AND e.v IN (SELECT node FROM comp_part WHERE component = {_LARGEST})""", ("comp_part", "edges_part"))
def q_largest(spark, d):
    return GC.largest_component(edges(spark, d, "part"))


@query("graph_summary", """
SELECT (SELECT CAST(count(*) AS BIGINT) FROM nodes_part) AS n_nodes,
       (SELECT CAST(count(*) AS BIGINT) FROM edges_part) AS n_edges,
       (SELECT CAST(count(*) AS BIGINT) FROM edges_part WHERE u = v) AS n_self_loops,
       (SELECT CAST(count(DISTINCT component) AS BIGINT) FROM comp_part) AS n_components,
       (SELECT count(DISTINCT component) = 1 FROM comp_part) AS is_connected""",
       ("nodes_part", "edges_part", "comp_part"))
def q_summary(spark, d):
    e = edges(spark, d, "part")
    return GB.graph_summary(e, GC.connected_components(e))


# ------------------------------------------------------------ degrees

@query("degree", "SELECT * FROM degree_part", ("degree_part",))
def q_degree(spark, d):
    return GD.degree(edges(spark, d, "part"))


@query("strength", "SELECT * FROM strength_supp", ("strength_supp",))
def q_strength(spark, d):
    return GD.strength(edges(spark, d, "supp"))


@query("degree_centrality", """
SELECT node, round(degree / ((SELECT count(*) FROM nodes_part) - 1.0), 6) AS degree_centrality
FROM degree_part""", ("degree_part", "nodes_part"))
def q_degree_centrality(spark, d):
    return GD.degree_centrality(edges(spark, d, "part")).withColumn("degree_centrality", rnd("degree_centrality"))


@query("clustering_coefficient", "SELECT node, round(clustering, 6) AS clustering FROM clustering_supp",
       ("clustering_supp",))
def q_clustering(spark, d):
    return GD.clustering_coefficient(edges(spark, d, "supp")).withColumn("clustering", rnd("clustering"))


@query("clustering_coefficient_sparse", "SELECT node, round(clustering, 6) AS clustering FROM clustering_part",
       ("clustering_part",))
def q_clustering_sparse(spark, d):
    return GD.clustering_coefficient(edges(spark, d, "part")).withColumn("clustering", rnd("clustering"))


@query("global_clustering", "SELECT round(avg(clustering), 6) AS avg_clustering FROM clustering_supp",
       ("clustering_supp",))
def q_global_clustering(spark, d):
    out = R.global_clustering(GD.clustering_coefficient(edges(spark, d, "supp")))
    return out.withColumn("avg_clustering", rnd("avg_clustering"))


@query("clustering_histogram", """
WITH s AS (SELECT min(clustering) AS lo, max(clustering) AS hi FROM clustering_part),
b AS (SELECT least(CAST(floor((clustering - s.lo) / (CASE WHEN s.hi > s.lo THEN (s.hi - s.lo) / 5 ELSE 1.0 END))
                       AS INTEGER), 4) AS bin FROM clustering_part, s),
g AS (SELECT CAST(range AS INTEGER) AS bin FROM range(5))
SELECT g.bin, round(s.lo + g.bin * (CASE WHEN s.hi > s.lo THEN (s.hi - s.lo) / 5 ELSE 1.0 END), 6) AS lower,
       round(s.lo + (g.bin + 1) * (CASE WHEN s.hi > s.lo THEN (s.hi - s.lo) / 5 ELSE 1.0 END), 6) AS upper,
       CAST(count(b.bin) AS BIGINT) AS count
FROM g CROSS JOIN s LEFT JOIN b ON g.bin = b.bin GROUP BY g.bin, s.lo, s.hi""", ("clustering_part",))
def q_hist(spark, d):
    h = R.histogram(GD.clustering_coefficient(edges(spark, d, "part")), "clustering", 5)
    return h.withColumn("lower", rnd("lower")).withColumn("upper", rnd("upper"))


@query("value_share", """
SELECT round(avg(CASE WHEN degree = 1 THEN 1.0 ELSE 0.0 END), 6) AS share FROM degree_part""", ("degree_part",))
def q_value_share(spark, d):
    return R.value_share(GD.degree(edges(spark, d, "part")), "degree", 1).withColumn("share", rnd("share"))


@query("clustering_one_share", """
SELECT round(avg(CASE WHEN clustering = 1 THEN 1.0 ELSE 0.0 END), 6) AS share FROM clustering_supp""",
       ("clustering_supp",))
def q_cc_one_share(spark, d):
    cc = GD.clustering_coefficient(edges(spark, d, "supp"))
    return R.value_share(cc, "clustering", 1.0).withColumn("share", rnd("share"))


@query("degree_assortativity", """
SELECT round(corr(a.weighted_degree, b.weighted_degree), 6) AS assortativity
FROM sym_part s JOIN wdeg_part a ON s.src = a.node JOIN wdeg_part b ON s.dst = b.node""",
       ("sym_part", "wdeg_part"))
def q_assort(spark, d):
    return GD.degree_assortativity(edges(spark, d, "part")).withColumn("assortativity", rnd("assortativity"))


_KNN_SQL = """SELECT s.src AS node, sum(s.weight * k.degree) / w.weighted_degree AS knn
FROM sym_{k} s JOIN degree_{k} k ON s.dst = k.node JOIN wdeg_{k} w ON s.src = w.node
GROUP BY s.src, w.weighted_degree"""


@query("avg_neighbor_degree", "SELECT node, round(knn, 6) AS knn FROM (" + _KNN_SQL.format(k="supp") + ")",
       ("sym_supp", "degree_supp", "wdeg_supp"))
def q_knn(spark, d):
    return GD.avg_neighbor_degree(edges(spark, d, "supp")).withColumn("knn", rnd("knn"))


@query("knn_by_degree", """
SELECT st.strength, round(avg(k.knn), 6) AS knn_mean, CAST(count(*) AS BIGINT) AS n_nodes
FROM strength_part st JOIN (""" + _KNN_SQL.format(k="part") + """) k ON st.node = k.node GROUP BY st.strength""",
       ("sym_part", "degree_part", "wdeg_part", "strength_part"))
def q_knn_by_degree(spark, d):
    return GD.knn_by_degree(edges(spark, d, "part")).withColumn("knn_mean", rnd("knn_mean"))


@query("degree_distribution", """
SELECT degree, n_nodes, round(share, 6) AS share, round(cdf, 6) AS cdf, round(ccdf, 6) AS ccdf FROM ddist_part""",
       ("ddist_part",))
def q_ddist(spark, d):
    dist = R.degree_distribution(GD.degree(edges(spark, d, "part")))
    return dist.select("degree", "n_nodes", rnd("share").alias("share"), rnd("cdf").alias("cdf"),
                       rnd("ccdf").alias("ccdf"))


@query("cumulative_share", """
SELECT degree, round(sum(share) OVER (ORDER BY degree), 6) AS cum_share FROM ddist_part""", ("ddist_part",))
def q_cum_share(spark, d):
    dist = R.degree_distribution(GD.degree(edges(spark, d, "part")))
    return R.cumulative_share(dist, "degree", "share").select("degree", rnd("cum_share").alias("cum_share"))


_PL_SQL = """
SELECT round(1 + sum(n_nodes) / sum(ln(degree / 2.0)), 6) AS gamma_mle,
       round(-regr_slope(CASE WHEN degree >= 2 THEN ln(share) END, CASE WHEN degree >= 2 THEN ln(degree) END), 6)
         AS gamma_loglog_pmf,
       round(-regr_slope(CASE WHEN degree >= 2 AND ccdf > 0 THEN ln(ccdf) END,
                         CASE WHEN degree >= 2 AND ccdf > 0 THEN ln(degree) END), 6) AS gamma_ccdf,
       round(1 + sum(CASE WHEN degree >= 2 THEN n_nodes END)
             / sum(CASE WHEN degree >= 2 THEN n_nodes * ln(degree / 2.0) END), 6) AS gamma_mle_std,
       round(1 - regr_slope(CASE WHEN degree >= 2 AND ccdf > 0 THEN ln(ccdf) END,
                            CASE WHEN degree >= 2 AND ccdf > 0 THEN ln(degree) END), 6) AS gamma_ccdf_std
FROM ddist_supp"""


@query("powerlaw_fit", _PL_SQL, ("ddist_supp",))
def q_powerlaw(spark, d):
    out = GD.powerlaw_fit(GD.degree(edges(spark, d, "supp")))
    return out.select(*[rnd(c).alias(c) for c in out.columns])


_MOMENTS = """
WITH g AS (SELECT -regr_slope(CASE WHEN degree >= 2 AND ccdf > 0 THEN ln(ccdf) END,
                              CASE WHEN degree >= 2 AND ccdf > 0 THEN ln(degree) END) AS g,
                  sum(n_nodes) AS n, CAST(max(degree) AS DOUBLE) AS kmax, sum(degree * share) AS k1,
                  sum(degree * degree * share) AS k2 FROM ddist_{kind}),
k AS (SELECT *, 2 * pow(n + 1, 1 / (g - 1)) AS km FROM g),
c AS (SELECT *, (1 - g) / (pow(km, 1 - g) - pow(2, 1 - g)) AS ct,
             (SELECT 1 / sum(pow(degree, -g.g)) FROM ddist_{kind}, g) AS ce FROM k),
m AS (SELECT *, ct * (pow(km, 2 - g) - pow(2, 2 - g)) / (2 - g) AS k1t,
             ct * (pow(km, 3 - g) - pow(2, 3 - g)) / (3 - g) AS k2t FROM c)"""


@query("degree_moments", _MOMENTS.format(kind="supp") + """
SELECT CAST(2 AS DOUBLE) AS kmin, round(g, 6) AS gamma, round(km, 6) AS kmax_theoretical, kmax AS kmax_empirical,
       round(ct, 6) AS c_theoretical, round(ln(ce), 6) AS ln_c_empirical, round(k1t, 6) AS k1_theoretical,
       round(k1, 6) AS k1_empirical, round(k2t, 6) AS k2_theoretical, round(k2, 6) AS k2_empirical,
       round(k2t / k1t, 6) AS kappa_theoretical, round(k2 / k1, 6) AS kappa_empirical FROM m""", ("ddist_supp",))
def q_moments(spark, d):
    out = GD.degree_moments(GD.degree(edges(spark, d, "supp")))
    out = out.withColumn("ln_c_empirical", F.ln("c_empirical")).drop("c_empirical")      # it can have 18 digits
    return out.select(*[rnd(c).alias(c) for c in out.columns])


@query("loglog_line", """
WITH c AS (SELECT regr_slope(ln(share), ln(degree)) AS slope, regr_intercept(ln(share), ln(degree)) AS icpt
           FROM ddist_supp WHERE degree >= 2 AND share > 0)
SELECT degree, round(share, 6) AS share, round(ln(degree), 6) AS ln_x, round(ln(share), 6) AS ln_y,
       round(c.icpt + c.slope * ln(degree), 6) AS fitted_ln_y, round(c.slope, 6) AS slope,
       round(c.icpt, 6) AS intercept
FROM ddist_supp, c""", ("ddist_supp",))
def q_loglog(spark, d):
    dist = R.degree_distribution(GD.degree(edges(spark, d, "supp")))
    out = GD.loglog_line(dist.select("degree", "share"), "degree", "share", 2)
    return out.select("degree", *[rnd(c).alias(c) for c in out.columns if c != "degree"])


@query("molloy_reed_ratio", """
SELECT round(avg(degree * degree) / avg(degree), 6) AS kappa, avg(degree * degree) / avg(degree) <= 2 AS below_critical
FROM degree_part""", ("degree_part",))
def q_molloy(spark, d):
    return R.molloy_reed_ratio(GD.degree(edges(spark, d, "part"))).withColumn("kappa", rnd("kappa"))


@query("rank_nodes", f"SELECT * FROM degree_part ORDER BY degree DESC, node LIMIT {TOP_NODES}", ("degree_part",))
def q_rank_nodes(spark, d):
    return R.rank_nodes(GD.degree(edges(spark, d, "part")), "degree", TOP_NODES)


# ------------------------------------------------------------ ranking

def _register_ranks():
    for kind, name in (("supp", ""), ("part", "_sparse")):
        O.register_chain(f"pagerank{name}", O.pagerank_sql(kind, PR_SQL[kind]),
                         f"SELECT node, round(x, 6) AS pagerank FROM pr{PR_SQL[kind]}", f"trans_{kind}", f"nodes_{kind}")
        r = HITS_SQL[kind]
        O.register_chain(f"hits{name}", O.hits_sql(kind, r),
                         f"SELECT h.node, round(h.x, 6) AS hub, round(a.x, 6) AS authority "
                         f"FROM h{r} h JOIN a{r} a ON h.node = a.node", f"sym_{kind}", f"nodes_{kind}")
    r = PR_SQL["supp"]
    O.register_chain("top_pagerank", O.pagerank_sql("supp", r),
                     f"SELECT * FROM (SELECT node, round(x, 6) AS pagerank FROM pr{r}) ORDER BY pagerank DESC, node LIMIT 10",
                     "trans_supp", "nodes_supp")


_register_ranks()


@query("pagerank")
def q_pagerank(spark, d):
    return GR.pagerank(edges(spark, d, "supp")).withColumn("pagerank", rnd("pagerank"))


@query("pagerank_sparse")
def q_pagerank_sparse(spark, d):
    return GR.pagerank(edges(spark, d, "part")).withColumn("pagerank", rnd("pagerank"))


@query("top_pagerank")
def q_top_pagerank(spark, d):
    pr = GR.pagerank(edges(spark, d, "supp")).withColumn("pagerank", rnd("pagerank"))
    return R.rank_nodes(pr, "pagerank", 10)


@query("hits")
def q_hits(spark, d):
    h = GR.hits(edges(spark, d, "supp"))
    return h.select("node", rnd("hub").alias("hub"), rnd("authority").alias("authority"))


@query("hits_sparse")
def q_hits_sparse(spark, d):
    h = GR.hits(edges(spark, d, "part"))
    return h.select("node", rnd("hub").alias("hub"), rnd("authority").alias("authority"))

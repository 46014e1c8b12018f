"""Degrees, clustering, assortativity, power-law fits.

Conventions (library definitions the reference relies on):
* ``degree``: neighbours counted once, a self-loop counts 2;
* ``strength``: adjacency row sum, a self-loop's weight counted once;
* ``weighted_degree``: Σ of incident weights, a self-loop's weight counted 2
  (used by assortativity and by the neighbour-degree average);
* clustering ignores weights and self-loops.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meridian.operators import relational as R
from meridian.operators.graph.build import symmetric
from meridian.operators.graph.wedges import oriented_triangles
from meridian.plans.iterate import cut


def degree(edges: DataFrame) -> DataFrame:
    """H5: node, degree (self-loop counts 2)."""
    ends = (edges.select(F.col("u").alias("node"), F.when(F.col("u") == F.col("v"), 2).otherwise(1).alias("_c"))
            .unionByName(edges.filter(F.col("u") != F.col("v"))
                         .select(F.col("v").alias("node"), F.lit(1).alias("_c"))))
    return ends.groupBy("node").agg(F.sum("_c").cast("bigint").alias("degree"))


def strength(edges: DataFrame) -> DataFrame:
    """H6: node, strength = adjacency row sum (self-loop weight once)."""
    return (symmetric(edges).groupBy(F.col("src").alias("node"))
            .agg(F.sum("weight").cast("double").alias("strength")))


def weighted_degree(edges: DataFrame) -> DataFrame:
    """node, Σ incident weights with a self-loop counted twice."""
    ends = (edges.select(F.col("u").alias("node"),
                         (F.col("weight") * F.when(F.col("u") == F.col("v"), 2).otherwise(1)).alias("_w"))
            .unionByName(edges.filter(F.col("u") != F.col("v")).select(F.col("v").alias("node"),
                                                                        F.col("weight").alias("_w"))))
    return ends.groupBy("node").agg(F.sum("_w").cast("double").alias("weighted_degree"))


def degree_centrality(edges: DataFrame) -> DataFrame:
    """H7: degree / (n - 1)."""
    deg = degree(edges)
    n = deg.count()
    scale = 1.0 / (n - 1) if n > 1 else 1.0
    return deg.select("node", (F.col("degree") * F.lit(scale)).alias("degree_centrality"))


def clustering_coefficient(edges: DataFrame) -> DataFrame:
    """H8: 2T / (d (d - 1)) per node, d = distinct neighbours other than itself;
    0 when d < 2.  Triangles come from the degree-oriented wedge join."""
    edges = cut(edges.select("u", "v"))           # read many times below
    simple = edges.filter(F.col("u") != F.col("v"))
    d = (simple.select(F.col("u").alias("node")).unionAll(simple.select(F.col("v").alias("node")))
         .groupBy("node").agg(F.count(F.lit(1)).alias("_d")))
    tri = oriented_triangles(simple)
    per_node = (tri.select(F.col("a").alias("node")).unionAll(tri.select(F.col("b").alias("node")))
                .unionAll(tri.select(F.col("c").alias("node")))
                .groupBy("node").agg(F.count(F.lit(1)).alias("_t")))
    allnodes = edges.select(F.col("u").alias("node")).union(edges.select(F.col("v").alias("node"))).distinct()
    out = allnodes.join(d, "node", "left").join(per_node, "node", "left")
    cc = F.when(F.coalesce("_d", F.lit(0)) < 2, F.lit(0.0)).otherwise(
        F.lit(2.0) * F.coalesce("_t", F.lit(0)) / (F.col("_d") * (F.col("_d") - 1)))
    return out.select("node", cc.alias("clustering"))


def degree_assortativity(edges: DataFrame, weighted: bool = True) -> DataFrame:
    """H9: Pearson correlation of the end degrees over the symmetric edge view
    (weighted degrees by default, as the reference asks for)."""
    deg = weighted_degree(edges).withColumnRenamed("weighted_degree", "k") if weighted else \
        degree(edges).withColumnRenamed("degree", "k")
    sym = symmetric(edges)
    a = deg.select(F.col("node").alias("src"), F.col("k").cast("double").alias("ka"))
    b = deg.select(F.col("node").alias("dst"), F.col("k").cast("double").alias("kb"))
    return sym.join(a, "src").join(b, "dst").agg(F.corr("ka", "kb").alias("assortativity"))


def avg_neighbor_degree(edges: DataFrame) -> DataFrame:
    """Σ_j w_ij k_j / s_i (k unweighted degree, s weighted degree)."""
    sym = symmetric(edges)
    k = degree(edges).select(F.col("node").alias("dst"), F.col("degree").alias("_kj"))
    s = weighted_degree(edges).select(F.col("node"), F.col("weighted_degree").alias("_s"))
    num = sym.join(k, "dst").groupBy(F.col("src").alias("node")).agg(
        F.sum(F.col("weight") * F.col("_kj")).alias("_num"))
    return num.join(s, "node").select(
        "node", F.when(F.col("_s") == 0, F.lit(0.0)).otherwise(F.col("_num") / F.col("_s")).alias("knn"))


def knn_by_degree(edges: DataFrame, knn: DataFrame | None = None) -> DataFrame:
    """Mean of the neighbour-degree average per strength class."""
    knn = knn if knn is not None else avg_neighbor_degree(edges)
    return (strength(edges).join(knn, "node").groupBy("strength")
            .agg(F.avg("knn").alias("knn_mean"), F.count(F.lit(1)).cast("bigint").alias("n_nodes")))


# ------------------------------------------------------------------ power law

KMIN = 2


def powerlaw_fit(deg: DataFrame, kmin: int = KMIN, col: str = "degree") -> DataFrame:
    """The exponent three ways, as the reference computes them, plus two
    textbook variants.

    * ``gamma_mle``: 1 + N / Σ over *distinct* degrees of ln(k / kmin)
    * ``gamma_loglog_pmf``: minus the slope of ln P(k) on ln k, k >= kmin
    * ``gamma_ccdf``: minus the slope of ln CCDF(k) on ln k, k >= kmin, CCDF > 0
    * ``gamma_mle_std``: 1 + n / Σ_{nodes, k >= kmin} ln(k / kmin)
    * ``gamma_ccdf_std``: 1 - slope of the CCDF line
    """
    dist = R.degree_distribution(deg, col)
    d = dist.agg(
        F.sum("n_nodes").alias("n"),
        F.sum(F.ln(F.col("degree") / F.lit(float(kmin)))).alias("s_distinct"),
        F.regr_slope(F.when(F.col("degree") >= kmin, F.ln("share")),
                     F.when(F.col("degree") >= kmin, F.ln("degree"))).alias("slope_pmf"),
        F.regr_slope(F.when((F.col("degree") >= kmin) & (F.col("ccdf") > 0), F.ln("ccdf")),
                     F.when((F.col("degree") >= kmin) & (F.col("ccdf") > 0), F.ln("degree"))).alias("slope_ccdf"),
        F.sum(F.when(F.col("degree") >= kmin, F.col("n_nodes"))).alias("n_tail"),
        F.sum(F.when(F.col("degree") >= kmin, F.col("n_nodes") * F.ln(F.col("degree") / F.lit(float(kmin)))))
        .alias("s_tail"))
    return d.select(
        (F.lit(1.0) + F.col("n") / F.col("s_distinct")).alias("gamma_mle"),
        (-F.col("slope_pmf")).alias("gamma_loglog_pmf"),
        (-F.col("slope_ccdf")).alias("gamma_ccdf"),
        (F.lit(1.0) + F.col("n_tail") / F.col("s_tail")).alias("gamma_mle_std"),
        (F.lit(1.0) - F.col("slope_ccdf")).alias("gamma_ccdf_std"))


def loglog_line(dist: DataFrame, x: str, y: str, xmin: float | None = None) -> DataFrame:
    """Least-squares line of ln y on ln x (rows with x >= xmin) and the
    fitted ln y for every row.  ``dist`` is a small aggregated table."""
    cond = (F.col(x) >= xmin) if xmin is not None else F.lit(True)
    cond = cond & (F.col(y) > 0) & (F.col(x) > 0)
    coef = dist.agg(F.regr_slope(F.when(cond, F.ln(y)), F.when(cond, F.ln(x))).alias("slope"),
                    F.regr_intercept(F.when(cond, F.ln(y)), F.when(cond, F.ln(x))).alias("intercept")).first()
    slope, icpt = coef.slope, coef.intercept
    return dist.select(x, y, F.ln(x).alias("ln_x"),
                       F.when(F.col(y) > 0, F.ln(y)).alias("ln_y"),
                       (F.lit(icpt) + F.lit(slope) * F.ln(x)).alias("fitted_ln_y"),
                       F.lit(slope).alias("slope"), F.lit(icpt).alias("intercept"))


def degree_moments(deg: DataFrame, kmin: int = KMIN, col: str = "degree") -> DataFrame:
    """D8 (Q5 kept as written): empirical <k>, <k^2>, their ratio, k_max, and
    the same from a power law with the CCDF exponent and the natural cut-off
    kmin (N+1)^(1/(gamma-1)); C_empirical sums k^-gamma over distinct degrees."""
    dist = R.degree_distribution(deg, col)
    gamma = powerlaw_fit(deg, kmin, col).first().gamma_ccdf
    e = dist.agg(F.sum("n_nodes").alias("n"), F.max("degree").alias("kmax"),
                 F.sum(F.col("degree") * F.col("share")).alias("k1"),
                 F.sum(F.col("degree") * F.col("degree") * F.col("share")).alias("k2"),
                 F.sum(F.pow(F.col("degree").cast("double"), F.lit(-gamma))).alias("c_inv")).first()
    n, g = e.n, gamma
    kmax_t = kmin * math.pow(n + 1, 1.0 / (g - 1)) if g and g != 1 else None

    def moment(p):
        if kmax_t is None or g == p:
            return None
        return (math.pow(kmax_t, p - g) - math.pow(kmin, p - g)) / (p - g)
    c_t = None
    if kmax_t is not None and g != 1:
        c_t = (1 - g) / (math.pow(kmax_t, 1 - g) - math.pow(kmin, 1 - g))
    k1_t = c_t * moment(2) if c_t is not None and moment(2) is not None else None
    k2_t = c_t * moment(3) if c_t is not None and moment(3) is not None else None
    row = (float(kmin), float(g), kmax_t, float(e.kmax), c_t, 1.0 / e.c_inv,
           k1_t, float(e.k1), k2_t, float(e.k2),
           (k2_t / k1_t) if k1_t else None, float(e.k2) / float(e.k1))
    spark = deg.sparkSession
    return spark.createDataFrame([row], (
        "kmin double, gamma double, kmax_theoretical double, kmax_empirical double, "
        "c_theoretical double, c_empirical double, k1_theoretical double, k1_empirical double, "
        "k2_theoretical double, k2_empirical double, kappa_theoretical double, kappa_empirical double"))

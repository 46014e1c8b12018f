"""Link prediction: edge split, similarity scores, threshold sweep.

Pairs are canonical (u < v, no self pairs).  Neighbour-based scores are
computed only for pairs that share a neighbour (the only pairs with a
positive score), from the chunked wedge join or, on dense graphs, from adjacency tiles,
so the n^2 pair space is never built as rows.  The threshold sweep turns each pair into the index of the highest
threshold it reaches and aggregates per (flag, index) - a table of at most
2 x n_thresholds rows - so no pair x threshold product is formed.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meridian.functions.draws import hash_keys
from meridian.operators.graph.build import symmetric
from meridian.operators.graph.degree import degree
from meridian.operators.graph.wedges import common_neighbor_pairs, simple_edges
from meridian.operators.linalg import matmul
from meridian.operators.sampling import smallest_n
from meridian.plans.iterate import cut

HOLDOUT = 0.2
#: Nodes of an adjacency tile, and columns that are multiplied at a time.
TILE, COLUMNS = 1024, 4096


def edge_hash(seed: int):
    return hash_keys(["u", "v"], seed)


def edge_split(edges: DataFrame, share: float = HOLDOUT, seed: int = 12345):
    """I1 (Q14): (train, validation, test) canonical simple edge tables.

    Test: int(share * |E|) edges drawn by a hash order among edges whose ends
    both have degree > 1 in the full graph; validation: int(share * |rest|)
    drawn the same way from the rest (degrees still from the full graph)."""
    e = simple_edges(edges)
    deg = degree(edges)
    du = deg.select(F.col("node").alias("u"), F.col("degree").alias("_du"))
    dv = deg.select(F.col("node").alias("v"), F.col("degree").alias("_dv"))
    e = e.join(du, "u").join(dv, "v").select("u", "v", ((F.col("_du") > 1) & (F.col("_dv") > 1)).alias("_ok"))
    e = cut(e.withColumn("_h1", edge_hash(seed)).withColumn("_h2", edge_hash(seed + 1)))
    n = e.count()
    test = smallest_n(e.filter("_ok"), int(share * n), "_h1", ["u", "v"]).select("u", "v")
    rest = e.join(test, ["u", "v"], "left_anti")
    n_rest = n - test.count()
    val = smallest_n(rest.filter("_ok"), int(share * n_rest), "_h2", ["u", "v"]).select("u", "v")
    train = rest.join(val, ["u", "v"], "left_anti").select("u", "v")
    return cut(train), cut(val), cut(test)


def _neighbour_scores(edges: DataFrame, dense: bool | None = None) -> DataFrame:
    """u, v, cn, ra, aa, jaccard for non-adjacent pairs with a common neighbour.

    A sparse graph goes through wedges (a row for each path u - w - v, summed by pair).  Where there
    are more wedges than pairs of nodes, ``dense`` tiles of the adjacency are multiplied
    instead, and no wedge becomes a row."""
    sym = symmetric(edges)
    nbrs = cut(sym.select("src", "dst").distinct())
    if dense is None:
        d = nbrs.where("src <> dst").groupBy("src").agg(F.count(F.lit(1)).alias("d"))
        r = d.agg(F.sum(F.col("d") * (F.col("d") - 1) / 2).alias("wedges"), F.count(F.lit(1)).alias("n")).first()
        dense = (r.wedges or 0) > r.n * (r.n - 1) / 2
    if dense:
        return _tile_scores(nbrs, degree(edges))
    k = degree(edges).select(F.col("node").alias("w"), F.col("degree").alias("_kw"))
    cnt = nbrs.groupBy(F.col("src").alias("node")).agg(F.count(F.lit(1)).alias("_n"))
    wedges = common_neighbor_pairs(sym).join(k, "w")
    agg = wedges.groupBy("u", "v").agg(F.count(F.lit(1)).alias("cn"),
                                       F.sum(F.lit(1.0) / F.col("_kw")).alias("ra"),
                                       F.sum(F.lit(1.0) / F.ln(F.col("_kw"))).alias("aa"))
    adj = simple_edges(edges)
    agg = agg.join(adj, ["u", "v"], "left_anti")
    nu = cnt.select(F.col("node").alias("u"), F.col("_n").alias("_nu"))
    nv = cnt.select(F.col("node").alias("v"), F.col("_n").alias("_nv"))
    return (agg.join(nu, "u").join(nv, "v")
            .withColumn("jaccard", F.col("cn") / (F.col("_nu") + F.col("_nv") - F.col("cn")))).drop("_nu", "_nv")


def _tile_scores(nbrs: DataFrame, k: DataFrame) -> DataFrame:
    """The same by adjacency tiles: nodes are dealt to blocks of about ``TILE``, each pair of blocks is one
    task that multiplies their rows, ``COLUMNS`` common neighbours at a time, leaves out
    adjacent pairs and emits one row for each pair that has a common neighbour."""
    kw = k.select(F.col("node").alias("dst"), F.col("degree").cast("double").alias("k"))
    links = nbrs.join(kw, "dst").groupBy(F.col("src").alias("node")).agg(F.collect_list(F.struct("dst", "k")).alias("near"))
    links = links.select("node", F.transform("near", lambda x: x["dst"]).alias("near"), F.transform("near", lambda x: x["k"]).alias("k"))
    blocks = max(1, math.ceil(k.count() / TILE))
    rows = cut(links.withColumn("b", F.pmod(hash_keys(["node"], 71), F.lit(blocks)).cast("int")))
    left = rows.select("node", "near", "k", F.col("b").alias("r"), F.explode(F.sequence(F.col("b"), F.lit(blocks - 1))).alias("c"))
    right = rows.select(F.col("node").alias("v_node"), F.col("near").alias("v_near"), F.col("k").alias("v_k"), F.col("b").alias("c"),
                        F.explode(F.sequence(F.lit(0), F.col("b"))).alias("r"))

    def product(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        names = ["u", "v", "cn", "ra", "aa", "jaccard"]
        if a.empty or b.empty:
            return pd.DataFrame({c: [] for c in names})
        b = b.rename(columns=lambda x: x.removeprefix("v_"))
        u, v = a["node"].to_numpy(np.int64), b["node"].to_numpy(np.int64)
        size = [x["near"].map(len).to_numpy() for x in (a, b)]
        near = [np.concatenate(x["near"].to_numpy()).astype(np.int64) for x in (a, b)]
        row = [np.repeat(np.arange(len(n)), n) for n in size]
        every, first = np.unique(np.concatenate(near), return_index=True)
        weight = np.concatenate([np.concatenate(x["k"].to_numpy()) for x in (a, b)])[first]
        at = [np.searchsorted(every, n) for n in near]
        cn, ra, aa = np.zeros((3, len(u), len(v)))
        for lo in range(0, len(every), COLUMNS):
            m = []
            for i, ids in enumerate((u, v)):
                own = (at[i] >= lo) & (at[i] < lo + COLUMNS) & (near[i] != ids[row[i]])       # self-loops are no neighbours
                x = np.zeros((len(ids), min(COLUMNS, len(every) - lo)))
                x[row[i][own], at[i][own] - lo] = 1
                m.append(x)
            w = weight[lo:lo + COLUMNS]
            cn += m[0] @ m[1].T
            ra += (m[0] / w) @ m[1].T
            aa += (m[0] * np.where(w > 1, 1 / np.log(np.maximum(w, 1.5)), 0)) @ m[1].T
        apart = cn > 0.5
        # Adjacent pairs are known already.
        where = np.searchsorted(np.sort(v), near[0])
        hit = (where < len(v)) & (np.sort(v)[np.minimum(where, len(v) - 1)] == near[0])
        apart[row[0][hit], np.argsort(v)[where[hit]]] = False
        apart &= u[:, None] < v if a["r"].iloc[0] == a["c"].iloc[0] else u[:, None] != v
        i, j = np.nonzero(apart)
        both = size[0][i] + size[1][j] - cn[i, j]
        return pd.DataFrame({"u": np.minimum(u[i], v[j]), "v": np.maximum(u[i], v[j]), "cn": np.rint(cn[i, j]).astype(np.int64),
                             "ra": ra[i, j], "aa": aa[i, j], "jaccard": cn[i, j] / both})

    return left.groupBy("r", "c").cogroup(right.groupBy("r", "c")).applyInPandas(
        product, "u long, v long, cn long, ra double, aa double, jaccard double")


def neighbour_scores(edges: DataFrame) -> DataFrame:
    """What I2, I3 and I4 read (their ``near``), written once for all three."""
    return cut(_neighbour_scores(edges))


def jaccard_score(edges: DataFrame, near: DataFrame | None = None) -> DataFrame:
    """|Γu ∩ Γv| / |Γu ∪ Γv| for non-adjacent pairs (positive scores only)."""
    return (_neighbour_scores(edges) if near is None else near).select("u", "v", F.col("jaccard").alias("score"))


def resource_allocation_score(edges: DataFrame, near: DataFrame | None = None) -> DataFrame:
    """Σ_w 1/k_w over common neighbours."""
    return (_neighbour_scores(edges) if near is None else near).select("u", "v", F.col("ra").alias("score"))


def adamic_adar_score(edges: DataFrame, near: DataFrame | None = None) -> DataFrame:
    """I4: Σ_w 1/ln k_w over common neighbours (k_w >= 2 for a common neighbour)."""
    return (_neighbour_scores(edges) if near is None else near).select("u", "v", F.col("aa").alias("score"))


def adjacency(edges: DataFrame) -> DataFrame:
    """Unweighted COO adjacency i, j, v (both orientations, self-loop once)."""
    return symmetric(edges).select(F.col("src").alias("i"), F.col("dst").alias("j"), F.lit(1.0).alias("v")).distinct()


def local_path_score(edges: DataFrame, beta: float = 1.0) -> DataFrame:
    """(A^2 + beta A^3)_uv for u < v (all pairs with a positive value)."""
    a = adjacency(edges)
    a2 = matmul(a, a)
    a3 = matmul(a2, a)
    s = (a2.select("i", "j", "v").unionByName(a3.select("i", "j", (F.col("v") * F.lit(beta)).alias("v")))
         .groupBy("i", "j").agg(F.sum("v").alias("score")))
    return s.filter(F.col("i") < F.col("j")).select(F.col("i").alias("u"), F.col("j").alias("v"), "score")


def rwr_score(edges: DataFrame, damping: float = 0.85, residual: float = 1e-11, weight_col: str | None = None) -> DataFrame:
    """p_uv + p_vu from random walks with restart started at every node, by forward
    push until at most ``residual`` of a walk's mass is pending in all."""
    from meridian.operators.graph.build import nodes
    from meridian.operators.graph.rank import personalized_pagerank
    seeds = nodes(edges).select(F.col("node").alias("seed"))
    p = personalized_pagerank(edges, seeds, damping, weight_col, residual=residual)
    s = p.where("seed <> node").groupBy(F.least("seed", "node").alias("u"), F.greatest("seed", "node").alias("v")).agg(F.sum("score").alias("score"))
    return s.filter(F.col("score") > 0)


def flag_pairs(scores: DataFrame, train: DataFrame, held_out: DataFrame) -> DataFrame:
    """Flag 0 = training edge, 1 = held-out edge, 2 = other."""
    from meridian.operators.relational import flag_candidate_pairs
    return flag_candidate_pairs(scores.filter(F.col("score") > 0), train, held_out)


def score_thresholds(flagged: DataFrame, n: int):
    """(a, b, [a + k(b-a)/n for k = 1..n-1]) from all positive scores."""
    r = flagged.agg(F.min("score"), F.max("score")).first()
    a, b = float(r[0]), float(r[1])
    ts = [a + k * (b - a) / n for k in range(1, n)]
    return a, b, sorted(set(ts))


def threshold_confusion(flagged: DataFrame, n: int) -> DataFrame:
    """I8: threshold, tp, fp, tn, fn over pairs with flag != 0 (p >= t predicts)."""
    a, b, ts = score_thresholds(flagged, n)
    spark = flagged.sparkSession
    width = (b - a)
    cand = flagged.filter(F.col("flag") != 0)
    if width > 0:
        k0 = F.floor((F.col("score") - F.lit(a)) * F.lit(float(n)) / F.lit(width)).cast("int")
    else:
        k0 = F.lit(n).cast("int")
    # the highest k in 1..n-1 with a + k(b-a)/n <= score (0 when none); the
    # float estimate k0 is corrected with the exact threshold expression
    def t(k):
        return F.lit(a) + k.cast("double") * F.lit(width) / F.lit(float(n))
    kk = F.least(F.greatest(k0 + 1, F.lit(0)), F.lit(n - 1))
    kmax = (F.when((kk >= 1) & (t(kk) <= F.col("score")), kk)
            .when((kk - 1 >= 1) & (t(kk - 1) <= F.col("score")), kk - 1)
            .when((kk - 2 >= 1) & (t(kk - 2) <= F.col("score")), kk - 2)
            .otherwise(F.lit(0)))
    hist = cand.groupBy(kmax.alias("kmax")).agg(
        F.sum(F.when(F.col("flag") == 1, 1).otherwise(0)).alias("_p1"),
        F.sum(F.when(F.col("flag") == 2, 1).otherwise(0)).alias("_p2"))
    tot = cand.agg(F.sum(F.when(F.col("flag") == 1, 1).otherwise(0)).alias("n1"),
                   F.sum(F.when(F.col("flag") == 2, 1).otherwise(0)).alias("n2")).first()
    n1, n2 = int(tot.n1 or 0), int(tot.n2 or 0)
    # thresholds that coincide (a == b) are one threshold, as in a dict keyed by it
    ks = {}
    for k in range(1, n):
        ks.setdefault(a + k * (b - a) / n, k)
    grid = spark.createDataFrame([(k, float(x)) for x, k in ks.items()], "k int, threshold double")
    # predicted at threshold k: pairs with kmax >= k.  Histogram rows and grid
    # rows are stacked and summed over k descending with a RANGE frame, so a
    # grid row also counts the histogram row of its own k (<= 2n rows in all).
    stacked = (grid.select("k", "threshold", F.lit(0).alias("_p1"), F.lit(0).alias("_p2"))
               .unionByName(hist.select(F.col("kmax").alias("k"), F.lit(None).cast("double").alias("threshold"),
                                        "_p1", "_p2")))
    w = Window.orderBy(F.desc("k")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    ge = (stacked.select("k", "threshold", F.sum("_p1").over(w).alias("tp"), F.sum("_p2").over(w).alias("fp"))
          .filter(F.col("threshold").isNotNull()))
    return ge.select("threshold", F.col("tp").cast("bigint"), F.col("fp").cast("bigint"),
                     (F.lit(n2) - F.col("fp")).cast("bigint").alias("tn"),
                     (F.lit(n1) - F.col("tp")).cast("bigint").alias("fn"))


def threshold_metrics(conf: DataFrame) -> DataFrame:
    """Precision, recall, F1, FPR; 0 whenever a denominator is 0."""
    def safe(num, den):
        return F.when(den != 0, num / den).otherwise(F.lit(0.0))
    tp, fp, tn, fn = (F.col(c).cast("double") for c in ("tp", "fp", "tn", "fn"))
    out = conf.withColumn("precision", safe(tp, tp + fp)).withColumn("recall", safe(tp, tp + fn))
    out = out.withColumn("f1", safe(F.lit(2.0) * F.col("precision") * F.col("recall"),
                                    F.col("precision") + F.col("recall")))
    return out.withColumn("fpr", safe(fp, fp + tn))


def best_threshold(metrics: DataFrame) -> DataFrame:
    """Least FPR^2 + (1 - recall)^2; the largest threshold on ties."""
    score = F.pow(F.col("fpr"), 2) + F.pow(F.lit(1.0) - F.col("recall"), 2)
    return metrics.withColumn("distance", score).orderBy(F.asc("distance"), F.desc("threshold")).limit(1)


def predicted_links(flagged: DataFrame, threshold: float) -> DataFrame:
    """Non-training pairs whose score reaches the threshold."""
    return flagged.filter((F.col("flag") != 0) & (F.col("score") >= F.lit(threshold))).select("u", "v", "score")


def evaluate_link_predictor(scores: DataFrame, train: DataFrame, val: DataFrame, n: int = 101,
                            method: str = "score") -> DataFrame:
    """Flag, sweep, metrics; returns the metric table with a ``best`` flag."""
    flagged = cut(flag_pairs(scores, train, val))
    m = threshold_metrics(threshold_confusion(flagged, n))
    best = best_threshold(m).select("threshold").first()
    return m.withColumn("best", F.col("threshold") == F.lit(best.threshold)).withColumn("method", F.lit(method))


def roc_points(metric_tables: list[DataFrame]) -> DataFrame:
    """(method, threshold, fpr, recall) of every method."""
    out = None
    for m in metric_tables:
        t = m.select("method", "threshold", "fpr", "recall")
        out = t if out is None else out.unionByName(t)
    return out


def method_comparison(metric_tables: list[DataFrame]) -> DataFrame:
    """Every method's metrics at its best threshold."""
    out = None
    for m in metric_tables:
        t = m.filter("best").select("method", "threshold", "precision", "recall", "f1", "fpr")
        out = t if out is None else out.unionByName(t)
    return out


def test_evaluation(scores_trainval: DataFrame, trainval: DataFrame, test: DataFrame,
                    threshold: float) -> DataFrame:
    """Confusion counts and metrics of the validated threshold on the test
    edges, scoring the train+validation graph."""
    flagged = flag_pairs(scores_trainval, trainval, test).filter(F.col("flag") != 0)
    pred = F.col("score") >= F.lit(threshold)
    conf = flagged.agg(
        F.sum(F.when(pred & (F.col("flag") == 1), 1).otherwise(0)).cast("bigint").alias("tp"),
        F.sum(F.when(pred & (F.col("flag") == 2), 1).otherwise(0)).cast("bigint").alias("fp"),
        F.sum(F.when(~pred & (F.col("flag") == 2), 1).otherwise(0)).cast("bigint").alias("tn"),
        F.sum(F.when(~pred & (F.col("flag") == 1), 1).otherwise(0)).cast("bigint").alias("fn"))
    return threshold_metrics(conf.withColumn("threshold", F.lit(float(threshold))))

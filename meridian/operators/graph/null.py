"""Degree-preserving rewiring and the neighbour-degree null model.

A rewiring round pairs edges at random and swaps their ends:
(a, b), (c, d) -> (a, d), (c, b).  Edges are hashed into buckets of about
``BUCKET`` edges; inside a bucket they are paired in hash order (a window per
bucket, so no task sees more than one bucket).  A swap is rejected when it
would create a self-loop, an edge already in the graph, or an edge proposed by
another swap; rejected pairs keep their edges, so every node keeps its
degree.  Replicas are a column: all replicas of the null model rewire in the
same jobs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meridian.operators.graph.wedges import simple_edges
from meridian.plans.iterate import cut

BUCKET = 4096


def rewire(edges: DataFrame, rounds: int = 1, seed: int = 0, replicas: int | None = None) -> DataFrame:
    """Replica, u, v (unweighted simple graph, u < v) after ``rounds``
    swap rounds per replica.  ``replicas=None`` returns one replica (0)."""
    return _rewired(cut(simple_edges(edges)), rounds, seed, replicas or 1)


def _rewired(base: DataFrame, rounds: int, seed: int, nrep: int) -> DataFrame:
    """``rewire`` of a simple graph that is written already.  The first round reads its edges once for
    all replicas: their copies are neither written nor joined."""
    m = base.count()
    nb = max(1, m // BUCKET)
    cur, graph, on = base.withColumn("replica", F.explode(F.sequence(F.lit(0), F.lit(nrep - 1)))), base, ["u", "v"]
    for r in range(rounds):
        key = F.pmod(F.xxhash64("u", "v", "replica", F.lit(seed * 131 + r)), F.lit(1 << 31))
        e = cur.withColumn("_h", key).withColumn("_b", F.pmod(F.col("_h"), F.lit(nb)))
        w = Window.partitionBy("replica", "_b").orderBy("_h", "u", "v")
        # The next edge of the bucket is the partner of every second one; the last may have none and stays.
        e = e.select("replica", "_b", "_h", F.col("u").alias("a"), F.col("v").alias("b"), F.lead("u").over(w).alias("c"),
                     F.lead("v").over(w).alias("d"), (F.row_number().over(w) - 1).alias("_rn")).where("_rn % 2 = 0")
        pair = F.col("_b") * F.lit(m) + F.floor(F.col("_rn") / 2)      # a bucket has fewer pairs than m
        flip = F.pmod(F.col("_h"), F.lit(2)) == 1         # which of the two swaps
        pr = cut(e.select("replica", pair.alias("_pair"), "a", "b", "c", "d", flip.alias("_flip")))
        ends = [(F.col("a"), F.when(F.col("_flip"), F.col("c")).otherwise(F.col("d"))),
                (F.when(F.col("_flip"), F.col("b")).otherwise(F.col("c")), F.when(F.col("_flip"), F.col("d")).otherwise(F.col("b")))]
        swapped = [F.struct(F.least(x, y).alias("u"), F.greatest(x, y).alias("v")) for x, y in ends]
        kept = [F.struct(F.col(x).alias("u"), F.col(y).alias("v")) for x, y in ("ab", "cd")]
        prop = pr.where("c is not null").select("replica", "_pair", F.inline(F.array(*swapped))).where("u <> v")
        # An edge list may be a hundred times larger in memory than in its files, so it is not to be broadcast.
        fresh = prop.join(graph.select(*on).hint("merge"), on, "left_anti")
        once = fresh.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy("replica", "u", "v"))).where("_n = 1")
        ok = once.groupBy("replica", "_pair").agg(F.count(F.lit(1)).alias("_n")).where("_n = 2").select("replica", "_pair", F.lit(True).alias("_ok"))
        now = (F.when(F.col("_ok"), F.array(*swapped)).when(F.col("c").isNotNull(), F.array(*kept)).otherwise(F.array(kept[0])))
        cur = cut(pr.join(ok, ["replica", "_pair"], "left").select("replica", F.inline(now)))
        graph, on = cur, ["replica", "u", "v"]
    return cur.select("replica", "u", "v")


def knn_null_comparison(edges: DataFrame, replicas: int = 100, rounds: int = 1, seed: int = 0) -> DataFrame:
    """H12 (Q22): node, strength, knn (weighted, original graph) and
    knn_null_unweighted (mean over ``replicas`` rewired graphs, weight 1)."""
    from meridian.operators.graph.degree import avg_neighbor_degree, strength
    orig = avg_neighbor_degree(edges).join(strength(edges), "node")
    base = cut(simple_edges(edges))
    rw = _rewired(base, rounds, seed, replicas)
    # Rewiring keeps every node's degree, so the degrees of the graph are those of all replicas.
    deg = base.select(F.explode(F.array("u", "v")).alias("dst")).groupBy("dst").agg(F.count(F.lit(1)).alias("_kj"))
    sym = rw.select("replica", F.inline(F.array(F.struct(F.col("u").alias("src"), F.col("v").alias("dst")),
                                                F.struct(F.col("v").alias("src"), F.col("u").alias("dst")))))
    nk = sym.join(deg, "dst").groupBy("replica", F.col("src").alias("node")).agg(F.avg("_kj").alias("_knn"))
    null = nk.groupBy("node").agg((F.sum("_knn") / F.lit(float(replicas))).alias("knn_null_unweighted"))
    return orig.join(null, "node", "left")

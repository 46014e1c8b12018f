"""Wedge joins (paths u - w - v) without a hot middle node in one task.

* ``oriented_triangles``: each simple edge is oriented from the endpoint of
  lower (degree, id) to the higher one; a node's out-degree is then at most
  sqrt(2|E|), so the wedge self-join on the tail never sees a hub's full
  neighbour list, and every triangle is found exactly once (at its lowest node).
* ``common_neighbor_pairs``: all pairs of neighbours of every middle node w
  (the output itself has d_w^2/2 rows for a node of degree d_w).  A middle node
  whose degree exceeds ``chunk`` has its neighbour list split into hash chunks;
  chunk pairs (p <= q) become separate join keys, so one task handles at most
  chunk^2 pairs however large the hub.  Callers aggregate per (u, v) right
  after, which Spark runs partially before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meridian.functions.draws import hash_int
from meridian.plans.iterate import cut

CHUNK = 2048


def simple_edges(edges: DataFrame) -> DataFrame:
    """Distinct unordered non-loop pairs u < v."""
    return (edges.filter(F.col("u") != F.col("v"))
            .select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct())


def oriented_triangles(edges: DataFrame) -> DataFrame:
    """Triangles (a, b, c) of the simple graph, each once."""
    s = simple_edges(edges)
    deg = (s.select(F.col("u").alias("n")).unionAll(s.select(F.col("v").alias("n")))
           .groupBy("n").agg(F.count(F.lit(1)).alias("d")))
    du = deg.select(F.col("n").alias("u"), F.col("d").alias("du"))
    dv = deg.select(F.col("n").alias("v"), F.col("d").alias("dv"))
    e = s.join(du, "u").join(dv, "v")
    # Written once: both sides of the wedge join and the closing edges read it.
    u_first = (F.col("du") < F.col("dv")) | ((F.col("du") == F.col("dv")) & (F.col("u") < F.col("v")))
    o = e.select(F.when(u_first, F.col("u")).otherwise(F.col("v")).alias("a"),
                 F.when(u_first, F.col("v")).otherwise(F.col("u")).alias("b"))
    o = cut(o)
    s = o.select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v"))
    x = o.alias("x")
    y = o.alias("y")
    w = (x.join(y, (F.col("x.a") == F.col("y.a")) & (F.col("x.b") < F.col("y.b")))
         .select(F.col("x.a").alias("a"), F.col("x.b").alias("b"), F.col("y.b").alias("c")))
    return w.join(s, (F.least(w.b, w.c) == s.u) & (F.greatest(w.b, w.c) == s.v), "left_semi")


def common_neighbor_pairs(sym: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(u, v, w): u < v both adjacent to w (u, v, w distinct).

    ``sym`` is the symmetric view (src, dst); self-loops are ignored."""
    nb = sym.filter(F.col("src") != F.col("dst")).select(F.col("src").alias("w"), F.col("dst").alias("x")).distinct()
    deg = nb.groupBy("w").agg(F.count(F.lit(1)).alias("_dw"))
    nb = nb.join(deg, "w").withColumn("_nc", F.greatest(F.lit(1), F.ceil(F.col("_dw") / F.lit(chunk))).cast("int"))
    nb = nb.withColumn("_p", F.pmod(hash_int("x", 3), F.col("_nc")).cast("int"))
    left = nb.select("w", F.col("x").alias("xu"), F.col("_p").alias("p"),
                     F.explode(F.sequence(F.col("_p"), F.col("_nc") - 1)).alias("q"))
    right = nb.select("w", F.col("x").alias("xv"), F.col("_p").alias("q"),
                      F.explode(F.sequence(F.lit(0), F.col("_p"))).alias("p"))
    pairs = left.join(right, ["w", "p", "q"]).filter((F.col("p") < F.col("q")) | (F.col("xu") < F.col("xv")))
    return pairs.select(F.least("xu", "xv").alias("u"), F.greatest("xu", "xv").alias("v"), "w")

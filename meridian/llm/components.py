"""Connected components by alternating large-star and small-star.

Links are a table (a, b) of integer nodes.  Large-star links every larger
neighbour of a node to the node's smallest neighbour, small-star the smaller
ones; both keep components and end, after a number of rounds about logarithmic in
the size, in stars around each component's smallest node.  The loop has no round
limit: it ends when nothing changes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meridian.plans.iterate import Steps


def _star(links: DataFrame, large: bool) -> DataFrame:
    """links: (a, b), a > b."""
    down = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        around = down.unionByName(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = around.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # the larger neighbours v of u
        found = links.select(F.col("b").alias("u"), F.col("a").alias("v")).join(least, "u")
        # a node that is its own smallest keeps its links as they are
        out = found.select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        found = down.join(least, "u")
        out = found.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(
            least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.where(F.col("a") > F.col("b")).distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) for every node that has a link; root is the component's smallest node."""
    steps = Steps(links.sparkSession)
    state = steps.cut(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                .where(F.col("a") > F.col("b")).distinct())
    mark = None
    while True:
        state = steps.cut(_star(_star(state, True), False))
        now = state.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(now) == mark:
            break
        mark = tuple(now)
    roots = state.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return state.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)

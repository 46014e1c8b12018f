"""Distances, exact kNN and radius joins on vector tables.

No operator here builds the n x m cross product as rows:

* ``distances_to_set`` compares every row with a small set whose size is
  checked before it becomes one array literal;
* ``knn_join`` sends each query to one block of near rows first, which bounds its k-th
  distance, and then only to the blocks that the triangle inequality leaves
  (``pivots.PivotBlocks``); a window keeps the k best per row over all visited blocks;
* ``ball_join`` and ``ball_weights`` send each query to the blocks whose bound is within the
  radius; weights are counted inside the tasks, without a row per pair.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meridian.functions.vectors import squared_euclidean
from meridian.operators.pivots import PivotBlocks, nearest, weight_within, within

MAX_INLINE_SET = 10_000


def collect_small(df: DataFrame, limit: int = MAX_INLINE_SET) -> list:
    """Collect a table that must be small; refuse when it is not."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"set too large to inline: more than {limit} rows")
    return rows


def vectors_literal(vectors: list):
    """Checked, small vectors as one array literal: the JSON text is parsed once, when
    the plan is optimised, instead of one expression per coordinate."""
    return F.from_json(F.lit(json.dumps([[float(x) for x in v] for v in vectors])), "array<array<double>>")


def ids_literal(ids: list):
    return F.from_json(F.lit(json.dumps([int(i) for i in ids])), "array<bigint>")


def distances_to_set(points: DataFrame, centers: DataFrame, id_col: str = "id",
                     feat_col: str = "features") -> DataFrame:
    """C4 (re-aimed): id, center_id, distance for every point and every member
    of a small, size-checked set."""
    rows = collect_small(centers.select(id_col, feat_col).orderBy(id_col))
    lit, ids = vectors_literal([r[feat_col] for r in rows]), ids_literal([r[id_col] for r in rows])
    d = F.transform(lit, lambda c: F.sqrt(squared_euclidean(F.col(feat_col), c)))
    z = F.arrays_zip(ids.alias("center_id"), d.alias("distance"))
    return (points.select(F.col(id_col).alias("id"), F.explode(z).alias("_z"))
            .select("id", F.col("_z.center_id").alias("center_id"), F.col("_z.distance").alias("distance")))


def knn_join(queries: DataFrame, base: DataFrame, k: int, id_col: str = "id",
             feat_col: str = "features", block: int | None = None) -> DataFrame:
    """Qid, nid, distance, rank: the k nearest base rows of every query row
    (Euclidean; ties by the lowest base id).  Exact."""
    q = queries.select(F.col(id_col).alias("qid"), F.col(feat_col).alias("qf"))
    b = base.select(F.col(id_col).alias("nid"), F.col(feat_col).alias("nf"))
    w = Window.partitionBy("qid").orderBy("distance", "nid")
    return nearest(q, b, k, block).withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def knn_graph(points: DataFrame, k: int, id_col: str = "id", feat_col: str = "features") -> DataFrame:
    """Symmetric 0/1 adjacency (i, j, v=1.0): j among the k nearest of i or
    i among those of j, i != j; a point counts as one of its own k."""
    nn = knn_join(points, points, k, id_col, feat_col).filter(F.col("qid") != F.col("nid"))
    both = (nn.select(F.col("qid").alias("i"), F.col("nid").alias("j"))
            .union(nn.select(F.col("nid").alias("i"), F.col("qid").alias("j"))).distinct())
    return both.withColumn("v", F.lit(1.0))


def ball_join(a: DataFrame, b: DataFrame, radius: float, id_col: str = "id", feat_col: str = "features",
              block: int | None = None) -> DataFrame:
    """(id_a, id_b, distance) for every pair with distance <= radius
    (``<=`` as in the reference; a row pairs with itself when both sides hold it)."""
    found = within(a.select(F.col(id_col).alias("qid"), F.col(feat_col).alias("qf")),
                   b.select(F.col(id_col).alias("nid"), F.col(feat_col).alias("nf")), float(radius), block)
    return found.select(F.col("qid").alias("id_a"), F.col("nid").alias("id_b"), "distance")


def ball_weights(candidates: DataFrame, points: DataFrame, radius: float, id_col: str = "id", feat_col: str = "features",
                 block: int | None = None) -> DataFrame:
    """Id, ball_weight: how many points lie within the radius of each candidate.  Pairs are
    counted where they are found."""
    index = PivotBlocks(points.select(F.col(id_col).alias("nid"), F.col(feat_col).alias("nf")), block)
    found = weight_within(index, candidates.select(F.col(id_col).alias("qid"), F.col(feat_col).alias("qf")), float(radius))
    return found.select(F.col("qid").alias("id"), F.col("weight").alias("ball_weight"))

"""Building the undirected weighted graph from directed links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meridian.operators import relational as R


def reciprocal_min_edges(weights: DataFrame) -> DataFrame:
    """Keep a pair only if both directions exist; weight = the smaller
    count; one canonical row per pair (u <= v), a self-loop once.

    One aggregation over the unordered pair with a conditional sum for each
    direction (partial sums before the shuffle), no self-join."""
    up, down = F.col("src") <= F.col("dst"), F.col("src") >= F.col("dst")
    pairs = weights.groupBy(F.least("src", "dst").alias("u"), F.greatest("src", "dst").alias("v")).agg(
        F.sum(F.when(up, F.col("weight"))).alias("_up"), F.sum(F.when(down, F.col("weight"))).alias("_down"))
    return pairs.where(F.col("_up").isNotNull() & F.col("_down").isNotNull()).select(
        "u", "v", F.least("_up", "_down").cast("bigint").alias("weight"))


def build_graph(links: DataFrame, years=None) -> DataFrame:
    """H1: links -> drop negative -> (years) -> counts -> reciprocal minimum.

    Every link counts one in its direction, so counting and pairing are one
    aggregation on the unordered pair."""
    kept = R.drop_negative_links(links)
    if years:
        kept = R.filter_years(kept, years)
    return reciprocal_min_edges(kept.select("src", "dst", F.lit(1).cast("bigint").alias("weight")))


def symmetric(edges: DataFrame) -> DataFrame:
    """Both orientations of every edge, which is read once; a self-loop appears once."""
    there = F.struct(F.col("u").alias("src"), F.col("v").alias("dst"), "weight")
    back = F.when(F.col("u") != F.col("v"), F.struct(F.col("v").alias("src"), F.col("u").alias("dst"), "weight"))
    return edges.select(F.explode(F.array(there, back)).alias("_e")).where("_e is not null").select("_e.*")


def nodes(edges: DataFrame) -> DataFrame:
    return edges.select(F.explode(F.array("u", "v")).alias("node")).distinct()


def graph_summary(edges: DataFrame, components: DataFrame) -> DataFrame:
    """H2: nodes, edges, self-loops, number of components, connected?"""
    e = edges.agg(F.count(F.lit(1)).cast("bigint").alias("n_edges"),
                  F.sum(F.when(F.col("u") == F.col("v"), 1).otherwise(0)).cast("bigint").alias("n_self_loops"))
    c = components.agg(F.count(F.lit(1)).cast("bigint").alias("n_nodes"),
                       F.countDistinct("component").cast("bigint").alias("n_components"))
    row_e, row_c = e.first(), c.first()
    spark = edges.sparkSession
    return spark.createDataFrame(
        [(row_c.n_nodes, row_e.n_edges, row_e.n_self_loops or 0, row_c.n_components,
          row_c.n_components == 1)],
        "n_nodes bigint, n_edges bigint, n_self_loops bigint, n_components bigint, is_connected boolean")

"""H3, H4: connected components and the largest component.

Alternating large-star and small-star steps on a table of links (big, small):

* large-star: every neighbour of a node that is larger than it is linked to the
  node's smallest neighbour (or itself);
* small-star: every smaller neighbour of a node, and the node, are linked to the
  smallest of them.

Both keep the components; the number of rounds grows with the logarithm of the
number of nodes, not with the diameter, and there is no cap: the loop ends when a
round changes nothing, at which point every component is a star around its
smallest node.  A hub is a skewed join key on the link side only (the other side
has one row per node), which skew-join splitting handles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meridian.operators import relational as R
from meridian.operators.graph.build import nodes as graph_nodes
from meridian.plans.iterate import Steps

LINK = ["big", "small"]


def _tidy(links: DataFrame) -> DataFrame:
    return links.where(F.col("big") > F.col("small")).distinct()


def _large_star(links: DataFrame) -> DataFrame:
    ends = links.select(F.col("big").alias("node"), F.col("small").alias("other")).unionByName(
        links.select(F.col("small").alias("node"), F.col("big").alias("other")))
    least = ends.groupBy("node").agg(F.min("other").alias("m")).select(
        F.col("node").alias("small"), F.least("node", "m").alias("m"))
    return _tidy(links.join(least, "small").select("big", F.col("m").alias("small")))


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("big").agg(F.min("small").alias("m"))
    moved = links.join(least, "big").select(F.col("small").alias("big"), F.col("m").alias("small"))
    return _tidy(moved.unionByName(least.select("big", F.col("m").alias("small"))))


def connected_components(edges: DataFrame) -> DataFrame:
    """node, component (= the smallest node id of the component)."""
    steps = Steps(edges.sparkSession)
    links = steps.cut(_tidy(edges.select(F.greatest("u", "v").alias("big"), F.least("u", "v").alias("small"))))
    seen = None
    while True:
        links = steps.cut(_small_star(_large_star(links)))
        now = tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*LINK).cast("decimal(38,0)"))).first())
        if now == seen:
            break
        seen = now
    root = links.select(F.col("big").alias("node"), F.col("small").alias("_root"))
    return graph_nodes(edges).join(root, "node", "left").select("node", F.coalesce("_root", "node").alias("component"))


def component_sizes(comp: DataFrame) -> DataFrame:
    return comp.groupBy("component").agg(F.count(F.lit(1)).cast("bigint").alias("size"))


def largest_component_id(comp: DataFrame):
    """Component with the most nodes; ties by lowest component id."""
    row = component_sizes(comp).orderBy(F.desc("size"), F.asc("component")).limit(1).first()
    return None if row is None else row.component


def largest_component(edges: DataFrame, comp: DataFrame | None = None) -> DataFrame:
    """H4: edges of the largest component (induced subgraph)."""
    comp = comp if comp is not None else connected_components(edges)
    cid = largest_component_id(comp)
    members = comp.filter(F.col("component") == F.lit(cid)).select("node")
    return R.induced_subgraph(edges, members)


def largest_component_summary(edges: DataFrame, comp: DataFrame | None = None) -> DataFrame:
    """H4/Q26: node count, edge count and true density of the largest component."""
    comp = comp if comp is not None else connected_components(edges)
    sub = largest_component(edges, comp)
    n_nodes = graph_nodes(sub).count()
    n_edges = sub.count()
    n_loops = sub.filter(F.col("u") == F.col("v")).count()
    pairs = n_nodes * (n_nodes - 1) / 2
    dens = (n_edges - n_loops) / pairs if pairs else None
    spark = edges.sparkSession
    return spark.createDataFrame([(n_nodes, n_edges, dens)], "n_nodes bigint, n_edges bigint, density double")

"""HITS, PageRank, personalised PageRank, centrality comparison.

Each round is one join of the score table with the transition table on the source
node and one aggregation by target node; partial sums are combined map-side, so a
hub target costs one partial row per partition.  The transition table is written
once, bucketed by source, so the loop never shuffles the edges.

Every iteration runs until the scores change by at most ``tol`` in a round (sum of
absolute changes; scores sum to 1).  One that has not got there after
``max_rounds`` rounds raises an error instead of returning unfinished scores.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meridian.operators import relational as R
from meridian.operators.graph.build import nodes as graph_nodes, symmetric
from meridian.operators.graph.components import connected_components
from meridian.plans.iterate import Steps, cut, cut_by

DAMPING = 0.85
TOL = 1e-7
MAX_ROUNDS = 2000
CUT_EVERY = 8
#: Nodes and links of a graph that a task may hold to push a block of so many seeds.
PUSH_NODES, PUSH_LINKS, PUSH_SEEDS = 4096, 1 << 22, 128
#: Components of fewer nodes share tasks, of about so many nodes.
PUSH_SMALL = 256


def _converge(x: DataFrame, step: Callable[[DataFrame], DataFrame], keys: list[str], tol: float, max_rounds: int,
              settle: Callable[[DataFrame], DataFrame] = lambda d: d, per: list[str] | None = None) -> DataFrame:
    """Apply ``step`` until the change of column x in one round is at most ``tol`` (for
    every value of ``per``, if given).  State is written every ``CUT_EVERY`` rounds,
    and there the last round's change is measured on written tables."""
    spark = x.sparkSession
    states, rounds = Steps(spark, 3), 0
    while rounds < max_rounds:
        for _ in range(CUT_EVERY - 1):
            x = step(x)
        before = states.cut(settle(x))
        x = states.cut(settle(step(before)))
        rounds += CUT_EVERY
        d = x.join(before.withColumnRenamed("x", "_o"), keys, "full").select(
            *(per or []), F.abs(F.coalesce("x", F.lit(0.0)) - F.coalesce("_o", F.lit(0.0))).alias("d"))
        change = (d.groupBy(*per).agg(F.sum("d").alias("d")).agg(F.max("d")) if per else d.agg(F.sum("d"))).first()[0]
        if (change or 0.0) <= tol:
            return x
    raise RuntimeError(f"no convergence to {tol} within {max_rounds} rounds")


def _spread(x: DataFrame, trans: DataFrame, all_nodes: DataFrame | None, value: str = "x") -> DataFrame:
    """y_j = Σ_i x_i t_ij for every node (0 where nothing arrives).  With
    ``all_nodes=None`` the caller guarantees every node receives something
    (an unweighted symmetric view: each node has an incident edge), which
    saves one join per step."""
    got = (trans.join(x, trans.src == x.node)
           .groupBy(F.col("dst").alias("node")).agg(F.sum(F.col(value) * F.col("t")).alias("_y")))
    if all_nodes is None:
        return got.select("node", F.col("_y").alias(value))
    return all_nodes.join(got, "node", "left").select("node", F.coalesce("_y", F.lit(0.0)).alias(value))


def _normalise(x: DataFrame, value: str = "x") -> DataFrame:
    total = x.agg(F.sum(value)).first()[0] or 1.0
    return x.select("node", (F.col(value) / F.lit(total)).alias(value))


def hits(edges: DataFrame, tol: float = TOL, weight_col: str | None = None, max_rounds: int = MAX_ROUNDS) -> DataFrame:
    """Node, hub, authority; each sums to 1.  Unweighted by default (Q8).

    On the symmetric view a = A h and h = A a, so one vector x <- A x serves both:
    a round is two steps, the even states are hubs and the odd ones authorities."""
    edges = cut(edges)
    sym = symmetric(edges)
    t = F.col(weight_col).cast("double") if weight_col else F.lit(1.0)
    trans = cut_by(sym.select("src", "dst", t.alias("t")), "src")
    nodes = cut(graph_nodes(edges))
    n = nodes.count()
    if n == 0:
        return nodes.select("node", F.lit(0.0).alias("hub"), F.lit(0.0).alias("authority"))
    every = None if weight_col is None else nodes
    h = _converge(nodes.select("node", F.lit(1.0 / n).alias("x")),
                  lambda x: _spread(_spread(x, trans, every), trans, every), ["node"], tol, max_rounds, _normalise)
    a = _normalise(_spread(h, trans, every))
    return h.withColumnRenamed("x", "hub").join(a.withColumnRenamed("x", "authority"), "node")


def transition(edges: DataFrame, weight_col: str | None = "weight") -> DataFrame:
    """src, dst, t = w_ij / Σ_j w_ij over the symmetric view."""
    sym = symmetric(edges)
    w = F.col(weight_col).cast("double") if weight_col else F.lit(1.0)
    sym = sym.select("src", "dst", w.alias("w"))
    out = sym.groupBy("src").agg(F.sum("w").alias("_s"))
    return sym.join(out, "src").filter(F.col("_s") > 0).select("src", "dst", (F.col("w") / F.col("_s")).alias("t"))


def pagerank(edges: DataFrame, damping: float = DAMPING, weight_col: str | None = "weight", tol: float = TOL,
             max_rounds: int = MAX_ROUNDS) -> DataFrame:
    """Weighted PageRank with uniform teleport; dangling mass (nodes whose
    out-weight is 0) is spread uniformly."""
    edges = cut(edges)
    trans = cut_by(transition(edges, weight_col), "src")
    nodes = cut(graph_nodes(edges))
    n = nodes.count()
    if n == 0:
        return nodes.select("node", F.lit(0.0).alias("pagerank"))
    dangling = nodes.join(trans.select(F.col("src").alias("node")).distinct(), "node", "left_anti")
    has_dangling = dangling.limit(1).count() > 0

    def step(x: DataFrame) -> DataFrame:
        extra = 0.0
        if has_dangling:
            extra = damping * (x.join(dangling, "node").agg(F.sum("x")).first()[0] or 0.0) / n
        # without dangling nodes every node has a positive-weight edge, so in
        # the symmetric view it also receives mass: the all-nodes join is moot
        y = _spread(x, trans, nodes if has_dangling else None)
        return y.select("node", (F.lit(damping) * F.col("x") + F.lit((1 - damping) / n + extra)).alias("x"))

    x = nodes.select("node", F.lit(1.0 / n).alias("x"))
    return _converge(x, step, ["node"], tol, max_rounds).withColumnRenamed("x", "pagerank")


def personalized_pagerank(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, weight_col: str | None = "weight",
                          tol: float = TOL, max_rounds: int = MAX_ROUNDS, residual: float = 0.0) -> DataFrame:
    """Seed, node, score for every seed in ``seeds`` (column ``seed``):
    random walk with restart to the seed.  All seeds run in one job keyed by
    the seed column; dangling mass returns to the seed.

    ``residual`` > 0 is forward push until at most that much of a seed's mass is pending in
    all, which bounds the error of its scores together: a walk is followed from the nodes
    whose pending mass exceeds residual / (2 nodes), so what is left adds up to half of it."""
    trans = cut(transition(edges, weight_col))
    s = seeds.select("seed")
    if residual > 0:
        trans = cut_by(trans, "src")
        ends = trans.select(F.col("src").alias("node")).union(trans.select("dst")).distinct().count()
        return _push(trans, s, damping, residual / (2 * max(1, ends)), max_rounds)

    # What moves on is missing at the seed: a link back with the negative sum of a node's
    # links, so that a round reads the last one once.
    back = trans.groupBy("src").agg((-F.sum("t")).alias("t")).select("src", F.lit(None).cast("long").alias("dst"), "t")
    moves = cut_by(trans.unionByName(back), "src")
    start = cut(s.select("seed", F.col("seed").alias("node"), F.lit(1.0).alias("x")))

    def step(x: DataFrame) -> DataFrame:
        moved = x.join(moves, x.node == moves.src).select(
            "seed", F.coalesce("dst", "seed").alias("node"), (F.lit(damping) * F.col("x") * F.col("t")).alias("x"))
        return moved.unionByName(start).groupBy("seed", "node").agg(F.sum("x").alias("x"))

    x = start
    return _converge(x, step, ["seed", "node"], tol, max_rounds, per=["seed"]).withColumnRenamed("x", "score")


def _push(trans: DataFrame, s: DataFrame, damping: float, residual: float, max_rounds: int) -> DataFrame:
    """Rounds of pushes over (seed, node, p, r): settled and pending mass, until no node's pending
    mass exceeds ``residual``.  Mass pending at a node without links returns to the seed.

    Seeds do not meet: on a graph that a task can hold, blocks of seeds make their rounds in tasks.  A walk stays in
    its component, so of a larger graph each component that a task can hold is a graph of its own."""
    size = trans.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("src").isNull() | F.col("dst").isNull(), 1)).alias("nulls")).first()
    if size.nulls:
        return _push_joins(trans, s, damping, residual, max_rounds)
    count = trans.select(F.col("src").alias("node")).union(trans.select("dst")).distinct().count()
    if size.n <= PUSH_LINKS and count <= PUSH_NODES:
        return _push_blocks(trans.withColumn("graph", F.lit("")), s.withColumn("graph", F.lit("")), damping, residual, max_rounds)
    of = connected_components(trans.select(F.col("src").alias("u"), F.col("dst").alias("v")))
    of = cut(of.select("node", F.col("component").alias("graph")))
    links = cut(trans.join(of.withColumnRenamed("node", "src"), "src"))
    nodes_of, links_of = of.groupBy("graph").agg(F.count(F.lit(1)).alias("nodes")), links.groupBy("graph").agg(F.count(F.lit(1)).alias("links"))
    fits = (F.col("nodes") <= PUSH_NODES) & (F.col("links") <= PUSH_LINKS)
    kinds = cut(nodes_of.join(links_of, "graph").withColumn("kind", F.when(~fits, 2).when(F.col("nodes") < PUSH_SMALL, 0).otherwise(1)))
    shared = kinds.where("kind = 0").agg(F.sum("nodes")).first()[0] or 0
    mates = F.pmod(F.xxhash64("graph"), F.lit(max(1, math.ceil(shared / PUSH_SMALL))))
    kinds = kinds.select("graph", "kind", F.concat_ws("/", "kind", F.when(F.col("kind") == 0, mates).otherwise(F.col("graph"))).alias("by"))
    seeds = cut(s.join(of.withColumnRenamed("node", "seed"), "seed", "left").join(kinds, "graph", "left"))
    own = lambda x: x.where("kind < 2").drop("graph", "kind").withColumnRenamed("by", "graph")
    found = _push_blocks(own(links.join(kinds, "graph")), own(seeds), damping, residual, max_rounds)
    rest = seeds.where("kind = 2 or kind is null").select("seed")
    if rest.isEmpty():
        return found
    large = kinds.where("kind = 2").select("graph")
    return found.unionByName(_push_joins(cut_by(links.join(large, "graph", "left_semi").select("src", "dst", "t"), "src"), rest, damping, residual, max_rounds))


def _push_joins(trans: DataFrame, s: DataFrame, damping: float, residual: float, max_rounds: int) -> DataFrame:
    """The rounds on a graph of any size, each a join and a sum over all seeds."""
    # A node's row meets its links and itself in one join: what stays, and what is sent on.
    ends = trans.select(F.col("src").alias("node")).union(trans.select("dst")).union(s.select("seed")).distinct()
    loose = ends.join(trans.select(F.col("src").alias("node")), "node", "left_anti")
    moves = cut_by(trans.select("src", "dst", "t", F.lit(False).alias("stay"))
                   .unionByName(ends.select(F.col("node").alias("src"), F.col("node").alias("dst"), F.lit(0.0).alias("t"), F.lit(True).alias("stay")))
                   .unionByName(loose.select(F.col("node").alias("src"), F.lit(None).cast("long").alias("dst"), F.lit(1.0).alias("t"),
                                             F.lit(False).alias("stay"))), "src")
    state = s.select("seed", F.col("seed").alias("node"), F.lit(0.0).alias("p"), F.lit(1.0).alias("r"))
    states, hot = Steps(s.sparkSession), F.col("r") > residual
    for done in range(1, max_rounds + 1):
        state = (state.join(moves, F.col("node") == F.col("src")).where(F.col("stay") | hot).select(
            "seed", F.coalesce("dst", "seed").alias("node"),
            F.when(~F.col("stay"), 0.0).when(hot, F.col("p") + F.lit(1 - damping) * F.col("r")).otherwise(F.col("p")).alias("p"),
            F.when(~F.col("stay"), F.lit(damping) * F.col("r") * F.col("t")).when(hot, 0.0).otherwise(F.col("r")).alias("r"))
            .groupBy("seed", "node").agg(F.sum("p").alias("p"), F.sum("r").alias("r")))
        if done % CUT_EVERY == 0 or done == max_rounds:
            state = states.cut(state)
            if state.where(hot).isEmpty():
                return state.where("p > 0").select("seed", "node", F.col("p").alias("score"))
    raise RuntimeError(f"pending mass above {residual} after {max_rounds} rounds")


def _push_blocks(trans: DataFrame, s: DataFrame, damping: float, residual: float, max_rounds: int) -> DataFrame:
    """The same rounds for ``PUSH_SEEDS`` seeds of a graph (column ``graph``) a task, whose pending mass is a matrix (seeds x nodes)."""
    seeds = cut(s.where("seed is not null").groupBy("graph", "seed").agg(F.count(F.lit(1)).cast("double").alias("mass")))
    parts = cut(seeds.groupBy("graph").agg(F.ceil(F.count(F.lit(1)) / F.lit(PUSH_SEEDS)).cast("int").alias("parts")))
    left = seeds.join(parts, "graph").select("seed", "mass", "graph", F.pmod(F.xxhash64("seed"), F.col("parts")).cast("int").alias("part"))
    links = trans.groupBy("graph", "src").agg(F.collect_list(F.struct("dst", "t")).alias("out")).join(parts, "graph")
    right = links.select("graph", "src", F.col("out.dst").alias("dst"), F.col("out.t").alias("t"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    tasks = min(parts.agg(F.sum("parts")).first()[0] or 1, 8 * seeds.sparkSession.sparkContext.defaultParallelism)
    left, right = (x.repartition(tasks, "graph", "part").groupBy("graph", "part") for x in (left, right))

    def push(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if a.empty:
            return pd.DataFrame({"seed": [], "node": [], "score": [], "pending": []})
        seed = np.sort(a["seed"].to_numpy(np.int64))
        dst = np.concatenate([np.zeros(0, np.int64), *b["dst"]]).astype(np.int64)
        src = np.repeat(b["src"].to_numpy(np.int64), b["dst"].map(len).to_numpy(np.int64))
        nodes = np.unique(np.concatenate([seed, src, dst]))
        t = np.zeros((len(nodes), len(nodes)))
        np.add.at(t, (np.searchsorted(nodes, src), np.searchsorted(nodes, dst)), np.concatenate([np.zeros(0), *b["t"]]))
        loose = ~np.isin(nodes, src)
        row, home = np.arange(len(seed)), np.searchsorted(nodes, seed)
        p, r = np.zeros((2, len(seed), len(nodes)))
        r[row, home] = a.sort_values("seed")["mass"].to_numpy()
        for _ in range(max_rounds):
            hot = np.where(r > residual, r, 0.0)
            if not hot.any():
                break
            p += (1 - damping) * hot
            r = r - hot + damping * (hot @ t)
            r[row, home] += damping * hot[:, loose].sum(axis=1)
        pending = (r > residual).any(axis=1)
        i, j = np.nonzero(p > 0)
        return pd.DataFrame({"seed": seed[i], "node": nodes[j], "score": p[i, j], "pending": pending[i]})

    found = cut(left.cogroup(right).applyInPandas(push, "seed long, node long, score double, pending boolean"))
    if not found.where("pending").isEmpty():
        raise RuntimeError(f"pending mass above {residual} after {max_rounds} rounds")
    return found.drop("pending")


def topk_ppr(ppr: DataFrame, k: int) -> DataFrame:
    """The ``k`` highest-scoring nodes of every seed (seed itself included)."""
    return R.topk_per_key(ppr, "seed", "score", k, item="node")


def centrality_comparison(edges: DataFrame, tol: float = TOL) -> DataFrame:
    """Degree centrality, PageRank and HITS side by side per node."""
    from meridian.operators.graph.degree import degree_centrality
    return (degree_centrality(edges).join(pagerank(edges, tol=tol), "node").join(hits(edges, tol=tol), "node"))

"""Robustness of the graph to node removal.

The reference removes nodes one at a time and recomputes the giant component
after each removal (n component searches).  Here a removal *order* is computed
once (random: a hash of the node; semi-targeted: -ln(u)/degree), and one run gives the curve after
every single removal: an edge lives until the first of its ends goes, so the components
after any number of removals are those of the maximum spanning forest by that time
(``spanning_forest``: forests of the tasks' rows, then Boruvka's rounds over DataFrames).  The forest's links, latest
first, are merged in blocks of bounded size; degree moments come from running sums
(``scan.Ranges``) over the times.  The targeted order (highest current degree, in batches)
depends on what is left, so degrees are walked batch by batch; the components of all batches
come from one forest again.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meridian.functions.draws import hash_uniform
from meridian.operators.graph.build import nodes as graph_nodes
from meridian.operators.graph.components import connected_components
from meridian.operators.graph.degree import degree
from meridian.operators.sampling import smallest_n
from meridian.operators.scan import Ranges
from meridian.plans.iterate import Steps, cut

#: Nodes ranked in one task.
RANK_BUCKET = 200_000
#: Links of the spanning forest that one task merges at a time.
MERGE_BLOCK = 2_000_000
#: Rows of which a task finds the forest at a time.
FOREST_ROWS = 500_000


def theoretical_thresholds(kappa: float, gamma: float, kmin: float, x0: float = 0.3) -> dict:
    """Random f_c = 1 - 1/(κ - 1); targeted: the root nearest x0 of
    2 + (2-γ)/(3-γ) kmin (x^((3-γ)/(1-γ)) - 1) - x^((2-γ)/(1-γ)) on (0, 1),
    found by a sign-change scan and bisection (scalar work on the driver)."""
    fr = 1 - 1 / (kappa - 1) if kappa and kappa != 1 else None

    def f(x):
        return 2 + (2 - gamma) / (3 - gamma) * kmin * (x ** ((3 - gamma) / (1 - gamma)) - 1) \
            - x ** ((2 - gamma) / (1 - gamma))
    xs = np.linspace(1e-6, 1 - 1e-6, 20001)
    with np.errstate(all="ignore"):
        ys = np.array([f(x) for x in xs])
    roots = []
    for i in range(len(xs) - 1):
        if np.isfinite(ys[i]) and np.isfinite(ys[i + 1]) and ys[i] * ys[i + 1] <= 0:
            lo, hi = xs[i], xs[i + 1]
            for _ in range(60):
                mid = (lo + hi) / 2
                if f(lo) * f(mid) <= 0:
                    hi = mid
                else:
                    lo = mid
            roots.append((lo + hi) / 2)
    ft = float(min(roots, key=lambda r: abs(r - x0))) if roots else None
    return {"fc_random": None if fr is None else float(fr), "fc_targeted": ft}


def _kruskal(pdf: pd.DataFrame) -> pd.DataFrame:
    """The rows (a, b, u, v, w) of a maximum spanning forest between the nodes a and b, ties by u, v."""
    pdf = pdf.sort_values(["w", "u", "v"], ascending=[False, True, True])
    parent: dict = {}

    def root(x):
        while (p := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[p]
        return x

    keep = []
    for a, b in zip(pdf["a"].tolist(), pdf["b"].tolist(), strict=True):
        a, b = root(a), root(b)
        parent[b] = a
        keep.append(a != b)
    return pdf[np.array(keep, bool)]


def _task_forest(batches):
    """The forest of a task's own rows: what is not in it is in no forest of the whole."""
    held: list = []
    for pdf in batches:
        held.append(pdf)
        if sum(map(len, held)) > FOREST_ROWS:
            held = [_kruskal(pd.concat(held))]
            if len(held[0]) > FOREST_ROWS // 2:              # sparse rows: they go on as they are
                yield held.pop()
    if held:
        yield _kruskal(pd.concat(held))


def spanning_forest(edges: DataFrame, block: int | None = None) -> DataFrame:
    """u, v, w: a maximum spanning forest (ties by u, v) of the edges u, v, w.

    Tasks leave out what is in no forest of their own rows.  Boruvka: in every round each component
    takes its heaviest edge out, and what these edges connect becomes one component, so there are at
    most log2(nodes) rounds.  Of the edges between two components only the heaviest goes on.  The last
    ``block`` of them are merged in one task."""
    block = MERGE_BLOCK if block is None else block
    steps, found = Steps(edges.sparkSession, 2), []
    best = F.max(F.struct("w", (-F.col("u")).alias("nu"), (-F.col("v")).alias("nv"))).alias("e")
    pick = [(-F.col("e.nu")).alias("u"), (-F.col("e.nv")).alias("v"), F.col("e.w").alias("w")]
    state = edges.where("u <> v").select(F.col("u").alias("a"), F.col("v").alias("b"), "u", "v", "w")
    state = steps.cut(state.mapInPandas(_task_forest, state.schema))
    while True:
        if state.count() <= block:
            found.append(state.groupBy(F.lit(0).alias("k")).applyInPandas(_kruskal, state.schema).select("u", "v", "w"))
            break
        both = state.unionByName(state.select(F.col("b").alias("a"), F.col("a").alias("b"), "u", "v", "w"))
        out = cut(both.groupBy("a").agg(F.max(F.struct("w", (-F.col("u")).alias("nu"), (-F.col("v")).alias("nv"), "b")).alias("e"))
                  .select("a", F.col("e.b").alias("b"), *pick))
        found.append(out.select("u", "v", "w").distinct())
        comp = cut(connected_components(out.select(F.col("a").alias("u"), F.col("b").alias("v"))))
        ca, cb = (comp.select(F.col("node").alias(x), F.col("component").alias(f"c{x}")) for x in "ab")
        state = steps.cut(state.join(ca, "a").join(cb, "b").where("ca <> cb")
                          .groupBy(F.least("ca", "cb").alias("a"), F.greatest("ca", "cb").alias("b")).agg(best)
                          .select("a", "b", *pick))
    return cut(functools.reduce(DataFrame.unionByName, found))


def _merge_block(pdf: pd.DataFrame) -> pd.DataFrame:
    """Links of one block, latest first: the largest component that each link makes, and
    every component's label and size behind the block."""
    pdf = pdf.sort_values("w", ascending=False, kind="stable")
    size = {**dict(zip(pdf["a"], pdf["na"], strict=True)), **dict(zip(pdf["b"], pdf["nb"], strict=True))}
    parent = {x: x for x in size}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    made = []
    for a, b in zip(pdf["a"], pdf["b"], strict=True):
        a, b = sorted((root(a), root(b)))
        if a != b:
            parent[b] = a
            size[a] += size[b]
        made.append(size[a])
    first = pd.DataFrame({"kind": 0, "x": pdf["w"].to_numpy(), "y": made, "n": 0})
    return pd.concat([first, pd.DataFrame({"kind": 1, "x": list(parent), "y": [root(x) for x in parent], "n": [size[root(x)] for x in parent]})])


def giant_by_time(forest: DataFrame, block: int = MERGE_BLOCK) -> DataFrame:
    """w, giant: the size of the component that each link of the forest makes when links come
    latest first.  Blocks of links are merged one after another, each in one task; between
    blocks the labels of the components that changed go on as a table."""
    spark = forest.sparkSession
    total = forest.count()
    cuts = forest.approxQuantile("w", [i / (total // block + 1) for i in range(1, total // block + 1)], 0.01 * block / max(1, total)) if total > block else []
    cuts = sorted(set(cuts), reverse=True)
    labels = cut(spark.createDataFrame([], "node long, label long, n long"))
    out = None
    for high, low in zip([None, *cuts], [*cuts, None], strict=True):
        part = forest if high is None else forest.where(F.col("w") < high)
        part = part if low is None else part.where(F.col("w") >= low)
        la, lb = (labels.select(F.col("node").alias(x), F.col("label").alias(f"l{x}"), F.col("n").alias(f"n{x}")) for x in "uv")
        named = part.join(la, "u", "left").join(lb, "v", "left").select(
            "w", F.coalesce("lu", "u").alias("a"), F.coalesce("lv", "v").alias("b"), F.coalesce("nu", F.lit(1)).alias("na"), F.coalesce("nv", F.lit(1)).alias("nb"))
        found = cut(named.groupBy(F.lit(0).alias("k")).applyInPandas(_merge_block, "kind int, x long, y long, n long"))
        made = found.where("kind = 0").select(F.col("x").alias("w"), F.col("y").alias("giant"))
        out = made if out is None else out.unionByName(made)
        if low is not None:
            merged = found.where("kind = 1").select(F.col("x").alias("label"), F.col("y").alias("to"), F.col("n").alias("size"))
            known = labels.join(merged, "label", "left").select("node", F.coalesce("to", "label").alias("label"), F.coalesce("size", "n").alias("n"))
            new = merged.join(labels.select(F.col("node").alias("label")), "label", "left_anti").select(
                F.col("label").alias("node"), F.col("to").alias("label"), F.col("size").alias("n"))
            labels = cut(known.unionByName(new))
    return out.groupBy("w").agg(F.max("giant").alias("giant"))


def removal_curve(edges: DataFrame, order: DataFrame) -> DataFrame:
    """n_removed, fraction, giant_share, kappa after every number of removals from 0 to n - 1.

    ``order``: node, rank (0 = removed first).  giant_share is relative to the whole graph's
    largest component; kappa = <k^2> / <k> over what is left (null without links)."""
    order = cut(order.select("node", F.col("rank").cast("long").alias("rank")))
    n = order.count()
    if n == 0:
        return order.select(F.col("rank").alias("n_removed"), F.lit(0.0).alias("fraction"), F.lit(0.0).alias("giant_share"), F.lit(0.0).alias("kappa"))
    ru, rv = (order.select(F.col("node").alias(x), F.col("rank").alias(f"r{x}")) for x in "uv")
    timed = cut(edges.select("u", "v").distinct().join(ru, "u").join(rv, "v").select("u", "v", F.least("ru", "rv").alias("w")))
    giant = giant_by_time(spanning_forest(timed))
    # A node's j-th link to come (latest first) raises its k^2 by 2 j - 1; a self-loop counts twice.
    ends = timed.select(F.col("u").alias("node"), "w").unionByName(timed.select(F.col("v").alias("node"), "w"))
    j = F.row_number().over(Window.partitionBy("node").orderBy(F.desc("w")))
    moments = ends.select("w", (2 * j - 1).alias("k2")).groupBy("w").agg(F.count(F.lit(1)).alias("k1"), F.sum("k2").alias("k2"))
    times = order.select(F.col("rank").alias("w")).join(giant, "w", "left").join(moments, "w", "left").select(
        "w", "giant", F.coalesce("k1", F.lit(0)).alias("k1"), F.coalesce("k2", F.lit(0)).alias("k2"))
    ranges = Ranges(times, [F.desc("w")])
    sums = ranges.sums(s1="k1", s2="k2")
    top = ranges.running_max("giant", "most")
    base = giant.agg(F.max("giant")).first()[0] or 1
    return (sums.select("w", "s1", "s2").join(top.select("w", "most"), "w")
            .select(F.col("w").alias("n_removed"), (F.col("w") / F.lit(float(n))).alias("fraction"),
                    (F.coalesce("most", F.lit(1)) / F.lit(float(base))).alias("giant_share"),
                    F.when(F.col("s1") > 0, F.col("s2") / F.col("s1")).alias("kappa")))


def _curve(edges: DataFrame, order: DataFrame, fractions: list[float] | None) -> DataFrame:
    """fraction, giant_share, kappa; with ``fractions`` only after floor(f n) removals for each f."""
    curve = removal_curve(edges, order)
    if fractions is None:
        return curve.select("fraction", "giant_share", "kappa")
    n = order.count()
    wanted = edges.sparkSession.createDataFrame([(float(f), int(math.floor(f * n))) for f in fractions], "fraction double, n_removed long")
    return wanted.join(curve.drop("fraction"), "n_removed", "left").select("fraction", "giant_share", "kappa")


def default_fractions(steps: int = 20) -> list[float]:
    return [i / steps for i in range(steps)]


def random_removal_curve(edges: DataFrame, fractions: list[float] | None = None, seed: int = 0) -> DataFrame:
    """Removal in a hash-random order."""
    return _curve(edges, random_order(edges, seed), fractions or default_fractions())


def random_order(edges: DataFrame, seed: int = 0) -> DataFrame:
    """node, rank by a hash of the node."""
    return _rank(graph_nodes(edges).withColumn("_k", hash_uniform("node", seed)))


def semi_targeted_removal_curve(edges: DataFrame, fractions: list[float] | None = None, seed: int = 0) -> DataFrame:
    """Removal with probability proportional to degree: order by the
    Efraimidis-Spirakis key -ln(u)/degree."""
    deg = degree(edges)
    u = hash_uniform("node", seed) + F.lit(1e-12)
    order = _rank(deg.withColumn("_k", -F.ln(u) / F.col("degree")))
    return _curve(edges, order, fractions or default_fractions())


def _rank(keyed: DataFrame) -> DataFrame:
    """node, rank by (_k, node): ranges of the key cut at approximate quantiles, exact
    counts of the ranges (a few numbers), and a row number inside each."""
    keyed = cut(keyed.select("node", "_k"))
    n = keyed.count()
    parts = max(1, n // RANK_BUCKET)
    cuts = keyed.approxQuantile("_k", [i / parts for i in range(1, parts)], 0.1 / parts) if parts > 1 else []
    bucket = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c < F.col("_k"))) if cuts else F.lit(0)
    keyed = keyed.withColumn("_b", bucket)
    base, acc = {}, 0
    for r in sorted(keyed.groupBy("_b").count().collect()):
        base[r["_b"]] = acc
        acc += r["count"]
    starts = F.array(*[F.lit(base.get(i, 0)).cast("long") for i in range(max(base, default=0) + 1)])
    w = Window.partitionBy("_b").orderBy("_k", "node")
    return keyed.select("node", (F.row_number().over(w) - 1 + F.get(starts, F.col("_b"))).alias("rank"))


def targeted_removal_curve(edges: DataFrame, steps: int = 20) -> DataFrame:
    """Repeatedly remove the nodes of highest current degree (ties: lowest
    id), ceil(n/steps) nodes per step (one node per step when steps >= n)."""
    n = graph_nodes(edges).count()
    batch = max(1, math.ceil(n / steps))
    spark, states = edges.sparkSession, Steps(edges.sparkSession, 2)
    edges = cut(edges)
    cur, removed, found, gone = edges, 0, [], []
    for s in range(steps + 1):
        dg = cut(degree(cur).withColumn("_key", F.lit(2147483647) - F.col("degree")))     # read many times below
        k = dg.agg(F.count(F.lit(1)).alias("n"), (F.avg(F.col("degree") * F.col("degree")) / F.avg("degree")).alias("kappa")).first()
        found.append((removed, k.kappa, k.n))
        if removed >= n - 1 or k.n == 0:
            break
        take = min(batch, k.n)
        top = smallest_n(dg, take, "_key", ["node"]).select("node")
        gone.append(top.select("node", F.lit(s).cast("long").alias("w")))
        removed += take
        cu = top.select(F.col("node").alias("u"))
        cv = top.select(F.col("node").alias("v"))
        cur = states.cut(cur.join(cu, "u", "left_anti").join(cv, "v", "left_anti"))
    # A link lives until the step that takes its first end, so one forest has the components of every step.
    giant = {}
    if gone:
        out = cut(functools.reduce(DataFrame.unionByName, gone))
        wu, wv = (out.select(F.col("node").alias(x), F.col("w").alias(f"w{x}")) for x in "uv")
        stays = F.lit(len(found)).cast("long")
        timed = edges.join(wu, "u", "left").join(wv, "v", "left").select(
            "u", "v", F.least(F.coalesce("wu", stays), F.coalesce("wv", stays)).alias("w"))
        giant = {r.w: r.giant for r in giant_by_time(spanning_forest(timed)).collect()}       # a row a step
    rows, base = [], None
    for s, (removed, kappa, linked) in enumerate(found):
        # nodes without links are components of one
        most = max([1 if linked or removed < n else 0, *(g for w, g in giant.items() if w >= s)])
        base = base or most or 1
        rows.append((removed / n, most / base, kappa))
    return spark.createDataFrame(rows, "fraction double, giant_share double, kappa double")


def empirical_thresholds(curve: DataFrame) -> DataFrame:
    """Q13: first and last removed fraction with κ <= 2."""
    return curve.filter(F.col("kappa") <= 2).agg(F.min("fraction").alias("fc_first"),
                                                 F.max("fraction").alias("fc_last"))

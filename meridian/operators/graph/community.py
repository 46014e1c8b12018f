"""Modularity, Louvain, co-association, consensus, authority shifting.

Partitions are (node, community) tables.  All community statistics are
grouped aggregations; per-node choices use ``max`` over a struct (a partial
aggregate), so a hub's candidate list is reduced map-side rather than sorted in
one task.

Synchronous local moves (every node picks its best neighbouring community at
once) can undo each other; a hash of (node, run, round) lets only half of the nodes that gain
move per round, and a round whose modularity does not rise is rolled back and tried with fewer, in
the end with one.  So modularity never decreases, and a level ends only where no node gains by a
move.  Many runs (of a consensus) are one job a round, keyed by run.
"""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meridian.operators.graph.build import nodes as graph_nodes
from meridian.operators.graph.degree import weighted_degree
from meridian.plans.iterate import Steps, cut

#: Rounds that do not raise Q, with ever fewer nodes moving, before a single node moves.
IDLE = 3


def modularity(edges: DataFrame, part: DataFrame, resolution: float = 1.0, comm_col: str = "community") -> float:
    """Σ_c [L_c / m - γ (s_c / 2m)^2], m = Σ weights, s_c = Σ weighted
    degrees (self-loop twice), L_c = weight of edges inside c.

    One job: per edge, its weight counts towards m, towards L_c when both ends
    share c, and towards s_c of each end's community; one aggregation by
    community then gives every term."""
    p = part.select("node", F.col(comm_col).alias("c"))
    pu = p.select(F.col("node").alias("u"), F.col("c").alias("cu"))
    pv = p.select(F.col("node").alias("v"), F.col("c").alias("cv"))
    e = edges.select("u", "v", F.col("weight").cast("double").alias("w")).join(pu, "u").join(pv, "v")
    ends = (e.select(F.col("cu").alias("c"), F.col("w").alias("s"),
                     F.when(F.col("cu") == F.col("cv"), F.col("w")).otherwise(0.0).alias("l"), F.col("w").alias("m"))
            .unionByName(e.select(F.col("cv").alias("c"), F.col("w").alias("s"), F.lit(0.0).alias("l"),
                                  F.lit(0.0).alias("m"))))
    per_c = ends.groupBy("c").agg(F.sum("s").alias("s"), F.sum("l").alias("l"), F.sum("m").alias("m"))
    r = per_c.agg(F.sum("l").alias("l"), F.sum(F.col("s") * F.col("s")).alias("ss"), F.sum("m").alias("m")).first()
    m = float(r.m or 0.0)
    if m == 0:
        return 0.0
    return float(r.l) / m - resolution * float(r.ss) / (4.0 * m * m)


def modularity_by_run(edges: DataFrame, part: DataFrame, resolution: float = 1.0) -> dict[int, float]:
    """H17 of many runs at once: ``edges`` run, u, v, weight; ``part`` run, node, c.  One job, one row a run."""
    pu = part.select("run", F.col("node").alias("u"), F.col("c").alias("cu"))
    pv = part.select("run", F.col("node").alias("v"), F.col("c").alias("cv"))
    e = edges.select("run", "u", "v", F.col("weight").cast("double").alias("w")).join(pu, ["run", "u"]).join(pv, ["run", "v"])
    ends = F.array(F.struct(F.col("cu").alias("c"), F.col("w").alias("s"), F.when(F.col("cu") == F.col("cv"), F.col("w")).otherwise(0.0).alias("l"),
                            F.col("w").alias("m")),
                   F.struct(F.col("cv").alias("c"), F.col("w").alias("s"), F.lit(0.0).alias("l"), F.lit(0.0).alias("m")))
    per_c = e.select("run", F.inline(ends)).groupBy("run", "c").agg(*[F.sum(x).alias(x) for x in "slm"])
    found = per_c.groupBy("run").agg(F.sum("l").alias("l"), F.sum(F.col("s") * F.col("s")).alias("ss"), F.sum("m").alias("m")).collect()
    return {r.run: r.l / r.m - resolution * r.ss / (4.0 * r.m * r.m) if r.m else 0.0 for r in found}


def _local_moving(edges: DataFrame, resolution: float, seed: int) -> DataFrame:
    """One Louvain level of every run: run, node, c by synchronous guarded moves, until no
    move of a run raises its modularity.  All runs of a round are one job."""
    keyed = edges.select("run", "u", "v", F.col("weight").cast("double").alias("weight"))
    sym = cut(keyed.select("run", F.col("u").alias("src"), F.col("v").alias("dst"), F.col("weight").alias("w")).unionByName(
        keyed.where("u <> v").select("run", F.col("v").alias("src"), F.col("u").alias("dst"), F.col("weight").alias("w"))))
    k = cut(sym.groupBy("run", F.col("src").alias("node")).agg(
        F.sum(F.when(F.col("src") == F.col("dst"), 2 * F.col("w")).otherwise(F.col("w"))).alias("k")))
    mass = {r.run: r.m for r in keyed.groupBy("run").agg(F.sum("weight").alias("m")).collect()}
    steps = Steps(edges.sparkSession, 3)
    part = steps.cut(k.select("run", "node", F.col("node").alias("c")))
    live = sorted(r for r, m in mass.items() if m)
    if not live:
        return part
    m = F.element_at(F.create_map(*[F.lit(x) for r, v in mass.items() for x in (r, float(v))]), F.col("run"))
    q_old = modularity_by_run(keyed, part, resolution)
    idle = dict.fromkeys(live, 0)
    for r in itertools.count():
        own = part.where(F.col("run").isin(live))
        me = own.join(k, ["run", "node"])
        stot = me.groupBy("run", "c").agg(F.sum("k").alias("stot"))
        nbc = (sym.where(F.col("run").isin(live) & (F.col("src") != F.col("dst")))
               .join(own.select("run", F.col("node").alias("dst"), F.col("c").alias("cn")), ["run", "dst"])
               .groupBy("run", F.col("src").alias("node"), "cn").agg(F.sum("w").alias("kic")))
        near = nbc.join(me, ["run", "node"]).join(stot.withColumnRenamed("c", "cn"), ["run", "cn"])
        # A node's link weight into its own community, and that community's degrees, ride with each candidate.
        inside = F.when(F.col("cn") == F.col("c"), F.struct("kic"))
        at_home = near.groupBy("run", "node").agg(F.max(inside).alias("home"))
        sizes = me.join(stot, ["run", "c"]).select("run", "node", F.col("stot").alias("stot_own"))
        gain = ((F.col("kic") - F.coalesce("home.kic", F.lit(0.0))) / m
                - F.lit(resolution) * F.col("k") * (F.col("stot") - (F.col("stot_own") - F.col("k"))) / (2.0 * m * m))
        best = (near.where("cn <> c").join(at_home, ["run", "node"]).join(sizes, ["run", "node"])
                .groupBy("run", "node").agg(F.max(F.struct(gain.alias("g"), (-F.col("cn")).alias("neg_c"))).alias("b")))
        # Half of the nodes that gain may move; after a round that did not raise Q a quarter, and so
        # on; in the end the one node that gains most, which always raises Q.
        want = best.select("run", "node", (-F.col("b.neg_c")).alias("to"), F.col("b.g").alias("g")).where("g > 1e-12")
        share = F.element_at(F.create_map(*[F.lit(x) for k_, v in idle.items() for x in (k_, 2 << v)]), F.col("run"))
        drawn = F.pmod(F.xxhash64("node", "run", F.lit(seed + r)), share) == 0
        single = [x for x in live if idle[x] >= IDLE]
        want = cut(want.withColumn("drawn", drawn))
        top = want.groupBy("run").agg(F.max(F.struct("g", (-F.col("node")).alias("n"))).alias("t"), F.count(F.lit(1)).alias("wants"),
                                      F.sum(F.col("drawn").cast("int")).alias("draws")).collect()
        one = F.lit(False)
        for x in top:
            if x.run in single:
                one = one | ((F.col("run") == x.run) & (F.col("node") == -x.t.n))
        goes = F.coalesce(F.when(F.col("run").isin(single), one).otherwise(F.col("drawn")) if single else F.col("drawn"), F.lit(False))
        moved = cut(own.join(want, ["run", "node"], "left").select("run", "node", F.when(goes, F.col("to")).otherwise(F.col("c")).alias("c")))
        live = [x.run for x in top]                       # in the others no node gains by a move
        some = [x.run for x in top if x.run in single or x.draws]
        q_new = modularity_by_run(keyed.where(F.col("run").isin(some)), moved.where(F.col("run").isin(some)), resolution) if some else {}
        better = [x for x in some if q_new[x] > q_old[x] + 1e-12]
        if better:
            take = F.col("run").isin(better)
            part = steps.cut(moved.where(take).select("run", "node", "c").unionByName(part.where(~take)))
            q_old.update((x, q_new[x]) for x in better)
        idle = {x: 0 if x in better else idle[x] + 1 for x in live if x in better or x not in single}
        live = sorted(idle)
        if not live:
            return cut(part)


def louvain_runs(edges: DataFrame, resolution: float = 1.0, seed: int = 0) -> DataFrame:
    """H18 of many runs at once: run, node, community.  ``edges``: run, u, v, weight.

    Levels: local moving, then contraction of each community into one node (internal
    weight as a self-loop); a run ends when its partition does not change any more."""
    nodes = edges.select("run", F.col("u").alias("node")).union(edges.select("run", "v")).distinct()
    steps = Steps(edges.sparkSession, 2)
    labels = steps.cut(nodes.select("run", "node", F.col("node").alias("community")))
    g = edges
    for level in itertools.count():
        part = _local_moving(g, resolution, seed + 101 * level)
        shrunk = [r.run for r in part.groupBy("run").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("c").alias("d")).where("d < n").collect()]
        labels = steps.cut(labels.join(part.select("run", F.col("node").alias("community"), "c"), ["run", "community"], "left")
                           .select("run", "node", F.coalesce("c", "community").alias("community")))
        if not shrunk:
            return labels
        pu = part.select("run", F.col("node").alias("u"), F.col("c").alias("cu"))
        pv = part.select("run", F.col("node").alias("v"), F.col("c").alias("cv"))
        g = cut(g.where(F.col("run").isin(shrunk)).join(pu, ["run", "u"]).join(pv, ["run", "v"])
                .groupBy("run", F.least("cu", "cv").alias("u"), F.greatest("cu", "cv").alias("v")).agg(F.sum("weight").alias("weight")))


def louvain(edges: DataFrame, resolution: float = 1.0, seed: int = 0) -> DataFrame:
    """Node, community, to the end of the last level."""
    return louvain_runs(edges.select(F.lit(0).alias("run"), "u", "v", "weight"), resolution, seed).select("node", "community")


def co_association(runs: DataFrame, pairs: DataFrame, n_runs: int | None = None) -> DataFrame:
    """For every candidate pair (u, v), the share of runs in which u and v
    share a community.  ``runs``: run, node, community; ``pairs``: u, v.

    Evaluated on given pairs (e.g. the graph's edges) rather than on all pairs
    of every community, so the work is |pairs| x runs."""
    nr = n_runs or runs.select("run").distinct().count()
    ru = runs.select("run", F.col("node").alias("u"), F.col("community").alias("cu"))
    rv = runs.select("run", F.col("node").alias("v"), F.col("community").alias("cv"))
    same = (pairs.select("u", "v").join(ru, "u").join(rv, ["run", "v"])
            .groupBy("u", "v").agg(F.sum(F.when(F.col("cu") == F.col("cv"), 1).otherwise(0)).alias("_n")))
    return same.select("u", "v", (F.col("_n") / F.lit(float(nr))).alias("share"))


def consensus_clustering(edges: DataFrame, runs: int = 5, tol: float = 0.01, max_iter: int = 3,
                         resolution: float = 1.0, seed: int = 0) -> DataFrame:
    """H20 (Q9): ``runs`` Louvain runs (one job a round for all of them), co-association on the current
    edges as the new weights, repeat until the weights change by less than ``tol``
    (Frobenius) or ``max_iter``; then one more Louvain run."""
    g = edges.select("u", "v", F.col("weight").cast("double").alias("weight"))
    for it in range(max_iter):
        every = cut(g.withColumn("run", F.explode(F.array(*[F.lit(r) for r in range(runs)]))))
        labs = louvain_runs(every, resolution, seed + 1000 * it)
        new = cut(co_association(labs, g, runs).filter(F.col("share") > 0).select("u", "v", F.col("share").alias("weight")))
        diff = (g.join(new.withColumnRenamed("weight", "_n"), ["u", "v"], "full")
                .agg(F.sum(F.pow(F.coalesce("weight", F.lit(0.0)) - F.coalesce("_n", F.lit(0.0)), 2))).first()[0])
        g = new
        if (diff or 0.0) ** 0.5 < tol:
            break
    # Nodes that share no run with any neighbour have lost all their edges: they stay communities of their own.
    last = louvain(g, resolution, seed + 99991)
    return graph_nodes(edges).join(last, "node", "left").select("node", F.coalesce("community", "node").alias("community"))


def authority_shifting(edges: DataFrame, k: int = 2, resolution: float = 1.0, residual: float = 1e-9,
                       damping: float = 0.85) -> DataFrame:
    """H21 (Q11): merge a node's community with those of its k highest
    personalised-PageRank nodes when modularity does not fall.

    Round based: every candidate merge (A, B) gets its exact modularity change
    ΔQ = L_AB / m - 2γ s_A s_B / (2m)^2; each community keeps its best
    candidate, and only mutual best pairs (a matching) with ΔQ >= 0 merge, so
    merges of one round are disjoint and their changes add up: Q never falls."""
    from meridian.operators.graph.rank import personalized_pagerank, topk_ppr
    seeds = graph_nodes(edges).select(F.col("node").alias("seed"))
    top = cut(topk_ppr(personalized_pagerank(edges, seeds, damping, residual=residual), k)
              .filter(F.col("seed") != F.col("node")).select(F.col("seed").alias("a"), F.col("node").alias("b")))
    m = float(edges.agg(F.sum("weight")).first()[0] or 0.0)
    kdeg = cut(weighted_degree(edges).select("node", F.col("weighted_degree").alias("k")))
    part = cut(graph_nodes(edges).select("node", F.col("node").alias("community")))
    while True:                               # every round merges, so there are fewer rounds than nodes
        pa = part.select(F.col("node").alias("a"), F.col("community").alias("ca"))
        pb = part.select(F.col("node").alias("b"), F.col("community").alias("cb"))
        cand = (top.join(pa, "a").join(pb, "b").filter(F.col("ca") != F.col("cb"))
                .select(F.least("ca", "cb").alias("x"), F.greatest("ca", "cb").alias("y")).distinct())
        pu = part.select(F.col("node").alias("u"), F.col("community").alias("cu"))
        pv = part.select(F.col("node").alias("v"), F.col("community").alias("cv"))
        lab = (edges.join(pu, "u").join(pv, "v").filter(F.col("cu") != F.col("cv"))
               .select(F.least("cu", "cv").alias("x"), F.greatest("cu", "cv").alias("y"), "weight")
               .groupBy("x", "y").agg(F.sum("weight").alias("lxy")))
        s = part.join(kdeg, "node").groupBy("community").agg(F.sum("k").alias("s"))
        sx = s.select(F.col("community").alias("x"), F.col("s").alias("sx"))
        sy = s.select(F.col("community").alias("y"), F.col("s").alias("sy"))
        dq = (cand.join(lab, ["x", "y"], "left").join(sx, "x").join(sy, "y")
              .select("x", "y", (F.coalesce("lxy", F.lit(0.0)) / F.lit(m)
                                 - F.lit(2.0 * resolution) * F.col("sx") * F.col("sy") / F.lit(4.0 * m * m)).alias("dq")))
        dq = cut(dq.filter(F.col("dq") >= 0))
        both = (dq.select(F.col("x").alias("c"), F.col("y").alias("o"), "dq")
                .unionByName(dq.select(F.col("y").alias("c"), F.col("x").alias("o"), "dq")))
        best = (both.groupBy("c").agg(F.max(F.struct("dq", (-F.col("o")).alias("neg_o"))).alias("b"))
                .select("c", (-F.col("b.neg_o")).alias("o")))
        mutual = (best.alias("p").join(best.alias("q"), (F.col("p.o") == F.col("q.c")) & (F.col("q.o") == F.col("p.c")))
                  .filter(F.col("p.c") > F.col("p.o")).select(F.col("p.c").alias("from_c"), F.col("p.o").alias("to_c")))
        mutual = cut(mutual)
        if mutual.limit(1).count() == 0:
            break
        part = cut(part.join(mutual, part.community == mutual.from_c, "left")
                   .select("node", F.coalesce("to_c", "community").alias("community")))
    return part

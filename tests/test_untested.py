"""Brute force and invariants for the iterative and randomised operators."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from meridian.operators import kcenter as KC
from meridian.operators import linalg as LA
from meridian.operators import linkpred as LP
from meridian.operators.graph import build as GB
from meridian.operators.graph import community as CM
from meridian.operators.graph import components as GC
from meridian.operators.graph import degree as GD
from meridian.operators.graph import null as NL
from meridian.operators.graph import rank as GR
from meridian.operators.graph import robustness as RB
from meridian.operators.graph import spectral as SP
from meridian.functions.draws import hash_int, hash_keys
from conftest import edges_df


def cliques(spark, sizes, bridges):
    pairs, at = [], 0
    for n in sizes:
        pairs += [(at + i, at + j) for i in range(n) for j in range(i)]
        at += n
    return edges_df(spark, pairs + bridges)


@pytest.fixture(scope="module")
def graph(spark):
    """Three cliques in a ring and a triangle of its own."""
    return cliques(spark, [6, 6, 6], [(0, 6), (7, 12), (13, 1), (100, 101), (101, 102), (102, 100)]).cache()


def adjacency(edges):
    rows = edges.collect()
    nodes = sorted({r.u for r in rows} | {r.v for r in rows})
    at = {n: i for i, n in enumerate(nodes)}
    a = np.zeros((len(nodes), len(nodes)))
    for r in rows:
        a[at[r.u], at[r.v]] = a[at[r.v], at[r.u]] = r.weight
    return nodes, a


def test_components_of_shuffled_paths(spark):
    for n in (400, 1600):
        ids = np.random.default_rng(n).permutation(n).tolist()
        got = GC.connected_components(edges_df(spark, list(zip(ids, ids[1:], strict=False)))).select("component").distinct().collect()
        assert [r.component for r in got] == [0]


def test_draws_take_any_key(spark):
    big = spark.createDataFrame([(10 ** 12, 9000), (8_360_000_001, 3), ((1 << 62) + 5, 1), (-7, -1)], "u long, v long")
    got = big.select(hash_int("u").alias("a"), hash_keys(["u", "v"], 12346).alias("b")).collect()
    assert all(0 <= r.a < 1 << 31 and 0 <= r.b < 1 << 31 for r in got) and len({r.b for r in got}) == 4


def test_edge_split_and_rewire_with_large_ids(spark):
    e = edges_df(spark, [(10 ** 12 + i, 10 ** 12 + j) for i in range(12) for j in range(i)])
    tr, va, te = LP.edge_split(e)
    assert (tr.count(), va.count(), te.count()) == (66 - 13 - 10, 10, 13)
    ring = edges_df(spark, [(10 ** 12 + i, 10 ** 12 + (i + 1) % 40) for i in range(40)])
    out = NL.rewire(ring, rounds=3).collect()
    degree = np.unique([r.u for r in out] + [r.v for r in out], return_counts=True)[1]
    assert len(out) == 40 and set(degree) == {2} and len({(r.u, r.v) for r in out}) == 40
    assert all(r.u < r.v for r in out)


def test_louvain_finds_cliques(spark, graph):
    lab = {r.node: r.community for r in CM.louvain(graph).collect()}
    groups = [range(0, 6), range(6, 12), range(12, 18), range(100, 103)]
    assert all(len({lab[n] for n in g}) == 1 for g in groups) and len(set(lab.values())) == 4


def test_runs_together_are_as_good_as_runs_alone(spark, graph):
    """Three graphs of different kinds as three runs of one job; each run ends as if it were alone."""
    pairs = {0: [(r.u, r.v, r.weight) for r in graph.collect()], 1: [(i, (i + 1) % 30, 1) for i in range(30)], 2: [(i, i + 1, 1) for i in range(0, 20, 2)]}
    every = spark.createDataFrame([(k, *e) for k, es in pairs.items() for e in es], "run int, u long, v long, weight long")
    lab = {k: {} for k in pairs}
    for r in CM.louvain_runs(every).collect():
        lab[r.run][r.node] = r.community
    q = CM.modularity_by_run(every, spark.createDataFrame([(k, n, c) for k, x in lab.items() for n, c in x.items()], "run int, node long, c long"))
    assert q[0] == pytest.approx(CM.modularity(graph, CM.louvain(graph)), abs=1e-9)
    assert q[1] > 0.55 and q[2] == pytest.approx(0.9) and len(set(lab[2].values())) == 10


def test_consensus_and_authority_shifting(spark, graph):
    single = CM.modularity(graph, GB.nodes(graph).withColumn("community", F.col("node")))
    for lab in (CM.consensus_clustering(graph, runs=3), CM.authority_shifting(graph, residual=1e-6)):
        lab = lab.cache()
        assert lab.count() == lab.select("node").distinct().count() == 21
        assert CM.modularity(graph, lab) > single


def test_ranks_against_numpy(spark, graph):
    nodes, a = adjacency(graph)
    t = a / a.sum(axis=1, keepdims=True)
    n = len(nodes)
    x = np.linalg.solve(np.eye(n) - 0.85 * t.T, np.full(n, 0.15 / n))
    got = {r.node: r.pagerank for r in GR.pagerank(graph).collect()}
    assert np.allclose([got[v] for v in nodes], x, atol=1e-6)
    vals, vecs = np.linalg.eigh(a)
    top = np.abs(vecs[:, vals.argmax()])
    h = {r.node: (r.hub, r.authority) for r in GR.hits(graph).collect()}
    assert np.allclose([h[v][0] for v in nodes], top / top.sum(), atol=1e-4)
    assert np.allclose([h[v][1] for v in nodes], top / top.sum(), atol=1e-4)
    seeds = spark.createDataFrame([(0,), (101,)], "seed long")
    for residual, tol in ((0.0, 1e-6), (1e-6, 1e-4)):
        p = {(r.seed, r.node): r.score for r in GR.personalized_pagerank(graph, seeds, residual=residual).collect()}
        for s in (0, 101):
            e = np.zeros(n)
            e[nodes.index(s)] = 0.15
            want = np.linalg.solve(np.eye(n) - 0.85 * t.T, e)
            assert np.allclose([p.get((s, v), 0.0) for v in nodes], want, atol=tol)


def test_rank_error_instead_of_unfinished_scores(graph):
    with pytest.raises(RuntimeError):
        GR.pagerank(graph, tol=1e-15, max_rounds=8)


def test_rwr_score(spark, graph):
    nodes, a = adjacency(graph)
    t = (a > 0) / (a > 0).sum(axis=1, keepdims=True)
    p = 0.15 * np.linalg.inv(np.eye(len(nodes)) - 0.85 * t.T).T            # p[s, v]
    got = {(r.u, r.v): r.score for r in LP.rwr_score(graph).collect()}
    for (u, v), s in got.items():
        i, j = nodes.index(u), nodes.index(v)
        assert abs(p[i, j] + p[j, i] - s) < 1e-6
    assert len(got) == 18 * 17 // 2 + 3


def test_spectrum_and_embedding(spark, graph):
    nodes, a = adjacency(graph)
    d = a.sum(axis=1)
    lap = np.eye(len(nodes)) - a / np.sqrt(np.outer(d, d))
    values, _ = SP.spectrum(graph)
    rows = values.collect()
    assert np.allclose(sorted(r.value for r in rows), np.linalg.eigvalsh(lap), atol=1e-9)
    emb, _, k = SP.spectral_embedding(graph)
    assert emb.count() == 21 and 1 <= k < 21
    cl, q = SP.spectral_clusters(graph)
    lab = {r.node: r.community for r in cl.collect()}
    assert len(lab) == 21 and len({lab[n] for n in range(18)} & {lab[n] for n in (100, 101, 102)}) == 0 and q > 0


def test_krylov_pairs_have_small_residuals(spark):
    rng = np.random.default_rng(4)
    b = rng.random((40, 40))
    m = b + b.T
    coo = spark.createDataFrame([(i, j, float(m[i, j])) for i in range(40) for j in range(40)], "i long, j long, v double")
    vals, vec, residual = LA.block_krylov_eigs(coo, 3, steps=5)
    assert residual < 1e-4 and np.allclose(vals, np.linalg.eigvalsh(m)[:3], atol=1e-5)
    assert LA.spectral_norm(coo) == pytest.approx(np.abs(np.linalg.eigvalsh(m)).max(), rel=1e-8)


def test_xmeans_separated_blobs(spark):
    rng = np.random.default_rng(8)
    pts = np.concatenate([rng.normal(c, 0.1, (40, 2)) for c in ((0, 0), (5, 5), (0, 6))])
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(pts)], "node long, coords array<double>")
    lab = {r.id: r.cluster for r in SP.xmeans(df).collect()}
    assert all(len({lab[i] for i in range(40 * g, 40 * g + 40)}) == 1 for g in range(3)) and len(set(lab.values())) == 3


def test_removal_curves(spark):
    star = edges_df(spark, [(0, i) for i in range(1, 11)])
    c = [(round(r.fraction, 3), round(r.giant_share, 3)) for r in RB.targeted_removal_curve(star, steps=11).collect()]
    assert c == [(0.0, 1.0), (0.091, 0.091)]              # without the hub every node is alone
    for curve in (RB.random_removal_curve(star), RB.semi_targeted_removal_curve(star)):
        rows = sorted(curve.collect(), key=lambda r: r.fraction)
        assert rows[0].giant_share == 1.0 and all(0 < r.giant_share <= 1 for r in rows)
    th = RB.theoretical_thresholds(4.0, 2.5, 2.0)
    assert th["fc_random"] == pytest.approx(1 - 1 / 3)


def test_knn_null_comparison(spark, graph):
    out = NL.knn_null_comparison(graph, replicas=5).collect()
    assert len(out) == 21 and all(r.knn > 0 and r.knn_null_unweighted > 0 for r in out)

def test_rewire_does_not_broadcast_edges(spark, graph, monkeypatch):
    """copies of the edge table are small in their files, and were broadcast for it."""
    plans, cut = [], NL.cut
    monkeypatch.setattr(NL, "cut", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or cut(df))
    rewired = NL.rewire(graph, rounds=2, seed=3, replicas=4).collect()
    joins = [x for p in plans for x in p.splitlines() if "BroadcastHashJoin" in x and "u#" in x]
    assert plans and not joins
    degree = {r.node: r.degree for r in GD.degree(graph.where("u <> v")).collect()}
    for replica in range(4):
        ends = [x for r in rewired if r.replica == replica for x in (r.u, r.v)]
        assert {n: ends.count(n) for n in set(ends)} == degree
    by = {}
    for r in NL.rewire(graph, replicas=3).collect():
        for a, b in ((r.u, r.v), (r.v, r.u)):
            by.setdefault((r.replica, a), []).append(degree[b])
    for r in NL.knn_null_comparison(graph, replicas=3).collect():
        assert abs(r.knn_null_unweighted - sum(sum(by[i, r.node]) / len(by[i, r.node]) for i in range(3)) / 3) < 1e-9



def _brute_greedy(x, w, k, z, alpha):
    first = x[:k + z + 1]
    d = np.sqrt(((first[:, None] - first[None]) ** 2).sum(-1))
    r = d[d > 0].min() / 2
    full = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    while True:
        left, chosen = set(range(len(x))), []
        while len(chosen) < k and left:
            ball = [sum(w[j] for j in left if full[i, j] <= (1 + 2 * alpha) * r) for i in range(len(x))]
            c = int(np.argmax(ball))
            chosen.append(c)
            left = {j for j in left if full[c, j] > (3 + 4 * alpha) * r}
        if sum(w[j] for j in left) <= z:
            return chosen, r
        r *= 2


def test_kcenter_with_outliers(spark):
    rng = np.random.default_rng(6)
    x = np.concatenate([rng.normal(c, 0.2, (20, 3)) for c in (0, 4, 9)] + [np.array([[50.0] * 3, [-40.0] * 3])])
    w = rng.integers(1, 3, len(x)).astype(float)
    w[-2:] = 1
    df = spark.createDataFrame([(i, p.tolist(), float(v)) for i, (p, v) in enumerate(zip(x, w, strict=True))],
                               "id long, features array<double>, weight double")
    centers, rep = KC.weighted_kcenter_outliers(df, 3, 2, 0.0)
    chosen, r = _brute_greedy(x, w, 3, 2, 0.0)
    assert [c.id for c in centers.orderBy("rank").collect()] == chosen and rep["final_guess"] == pytest.approx(r)
    points = df.select("id", "features")
    core = KC.extract_coreset(points, 3, 2, 4).collect()
    assert sum(c.weight for c in core) == len(x) and len(core) <= 4 * 6
    centers, _ = KC.mr_kcenter_outliers(points, 3, 2)
    assert KC.kcenter_objective(points, centers, 2) < 4


def test_push_by_blocks_of_seeds_equals_push_by_joins(spark, graph, monkeypatch):
    seeds = spark.createDataFrame([(i,) for i in (0, 1, 2, 3, 101, 101, 999)], "seed long")     # one twice, one outside the graph
    monkeypatch.setattr(GR, "PUSH_SEEDS", 2)
    found = []
    for nodes in (GR.PUSH_NODES, 0):
        monkeypatch.setattr(GR, "PUSH_NODES", nodes)
        found.append({(r.seed, r.node): r.score for r in GR.personalized_pagerank(graph, seeds, residual=1e-9).collect()})
        with pytest.raises(RuntimeError):
            GR.personalized_pagerank(graph, seeds, residual=1e-9, max_rounds=3)
    assert found[0].keys() == found[1].keys() and {s for s, _ in found[0]} == {0, 1, 2, 3, 101, 999}
    assert all(abs(found[0][k] - found[1][k]) < 1e-9 for k in found[0])


def test_components_that_tasks_can_hold_are_pushed_without_joins(spark, graph, monkeypatch):
    """a graph too large for a task, of components that are not; one of them is."""
    pairs = [(1000 * c + i, 1000 * c + (i + 1) % n, 1) for c, n in enumerate((5, 9, 30)) for i in range(n)]
    edges = spark.createDataFrame(pairs, "u long, v long, weight long").unionByName(graph.selectExpr("u + 5000 u", "v + 5000 v", "weight"))
    seeds = GB.nodes(edges).select(F.col("node").alias("seed"))
    monkeypatch.setattr(GR, "PUSH_SEEDS", 4)
    monkeypatch.setattr(GR, "PUSH_SMALL", 8)
    joins, rows = GR._push_joins, []
    monkeypatch.setattr(GR, "_push_joins", lambda trans, s, *a: rows.append(s.count()) or joins(trans, s, *a))
    monkeypatch.setattr(GR, "PUSH_NODES", 25)
    found = {(r.seed, r.node): r.score for r in GR.personalized_pagerank(edges, seeds, residual=1e-2).collect()}
    assert rows == [30]
    nodes, a = adjacency(edges)
    t = a / a.sum(axis=1, keepdims=True)
    p = 0.15 * np.linalg.inv(np.eye(len(nodes)) - 0.85 * t.T).T
    at = {x: i for i, x in enumerate(nodes)}
    assert all(abs(p[at[s], at[v]] - x) < 1e-2 for (s, v), x in found.items()) and {s for s, _ in found} == set(nodes)
    assert all((s, v) in found for s in nodes for v in nodes if p[at[s], at[v]] > 1e-2)


def test_node_statistics_measures_run_side_by_side(spark, graph, monkeypatch):
    """each measure waits here until the others are under way too."""
    from threading import Barrier

    from meridian.plans import catalog_community as C
    together = Barrier(5)

    def fake(*columns):
        def measure(edges, **kw):
            together.wait(60)
            out = GB.nodes(edges)
            return out.select("node", *[F.col("node").alias(c) for c in columns])
        return measure

    monkeypatch.setattr(C, "_edges", lambda *a: graph)
    monkeypatch.setattr(C.GR, "pagerank", fake("pagerank"))
    monkeypatch.setattr(C.GR, "hits", fake("hub", "authority"))
    monkeypatch.setattr(C.CM, "louvain", fake("community"))
    monkeypatch.setattr(C.CM, "authority_shifting", fake("community"))
    monkeypatch.setattr(C.SP, "spectral_clusters", lambda e: (fake("community")(e), None))
    out = C.q_node_stats(spark, "")
    assert out.columns == ["node", "degree_centrality", "clustering_coeffs", "pagerank_centrality", "hub_centrality", "authority_centrality",
                           "louvain_communities", "authority_shifting", "spectral_clusters"]
    rows = out.collect()
    assert len(rows) == 21 and all(r.node == r.authority_shifting == r.spectral_clusters == r.hub_centrality for r in rows)

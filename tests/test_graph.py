import numpy as np

from conftest import edges_df
from meridian.operators.graph import build as GB
from meridian.operators.graph import components as GC
from meridian.operators.graph import degree as GD
from meridian.operators.graph import rank as GR
from meridian.operators.graph.wedges import common_neighbor_pairs, oriented_triangles
from meridian.operators.graph.build import symmetric

# hand-made graphs: path, star, triangle + tail, two cliques joined by an edge,
# cycle of 6, isolated self-loop
GRAPHS = {
    "path": [(1, 2), (2, 3), (3, 4)],
    "star": [(0, 1), (0, 2), (0, 3), (0, 4)],
    "tri_tail": [(1, 2), (2, 3), (1, 3), (3, 4)],
    "cliques": [(a, b) for a in range(4) for b in range(a + 1, 4)]
               + [(a, b) for a in range(10, 14) for b in range(a + 1, 14)] + [(3, 10)],
    "cycle6": [(i, (i + 1) % 6) for i in range(6)],
    "mixed": [(1, 2), (2, 3), (7, 7), (8, 9)],
}


def _adj(pairs):
    nodes = sorted({x for p in pairs for x in p})
    idx = {n: i for i, n in enumerate(nodes)}
    A = np.zeros((len(nodes), len(nodes)))
    for u, v in pairs:
        A[idx[u], idx[v]] = 1
        A[idx[v], idx[u]] = 1
    return nodes, A


def test_components(spark):
    c = {r.node: r.component for r in GC.connected_components(edges_df(spark, GRAPHS["mixed"])).collect()}
    assert c == {1: 1, 2: 1, 3: 1, 7: 7, 8: 8, 9: 8}
    c = {r.node: r.component for r in GC.connected_components(edges_df(spark, GRAPHS["cliques"])).collect()}
    assert set(c.values()) == {0}


def test_degree_self_loop_counts_two(spark):
    d = {r.node: r.degree for r in GD.degree(edges_df(spark, GRAPHS["mixed"])).collect()}
    assert d == {1: 1, 2: 2, 3: 1, 7: 2, 8: 1, 9: 1}


def test_clustering_matches_brute_force(spark):
    for name in ("tri_tail", "cliques", "star", "cycle6"):
        nodes, A = _adj(GRAPHS[name])
        exp = {}
        for i, n in enumerate(nodes):
            nb = np.nonzero(A[i])[0]
            d = len(nb)
            t = sum(A[a, b] for x, a in enumerate(nb) for b in nb[x + 1:])
            exp[n] = 0.0 if d < 2 else 2 * t / (d * (d - 1))
        got = {r.node: r.clustering for r in GD.clustering_coefficient(edges_df(spark, GRAPHS[name])).collect()}
        assert got.keys() == exp.keys()
        assert all(abs(got[k] - exp[k]) < 1e-12 for k in exp), name


def test_triangles_found_once(spark):
    tri = oriented_triangles(edges_df(spark, GRAPHS["cliques"])).collect()
    assert len(tri) == 8  # two K4 -> 4 triangles each


def test_common_neighbor_pairs_chunked_equals_plain(spark):
    e = edges_df(spark, GRAPHS["star"] + [(0, i) for i in range(5, 40)])
    plain = sorted(tuple(r) for r in common_neighbor_pairs(symmetric(e), chunk=10_000).collect())
    chunked = sorted(tuple(r) for r in common_neighbor_pairs(symmetric(e), chunk=4).collect())
    assert plain == chunked and len(plain) == 39 * 38 // 2


def test_pagerank_matches_power_iteration(spark):
    pairs = GRAPHS["tri_tail"] + [(4, 5), (5, 6), (2, 6)]
    nodes, A = _adj(pairs)
    P = A / A.sum(axis=1, keepdims=True)
    n = len(nodes)
    x = np.linalg.solve(np.eye(n) - 0.85 * P.T, np.full(n, 0.15 / n))
    got = {r.node: r.pagerank for r in GR.pagerank(edges_df(spark, pairs), tol=1e-12).collect()}
    assert abs(sum(got.values()) - 1) < 1e-9
    assert all(abs(got[nd] - x[i]) < 1e-9 for i, nd in enumerate(nodes))


def test_hits_sums_to_one(spark):
    h = GR.hits(edges_df(spark, GRAPHS["tri_tail"])).collect()
    assert abs(sum(r.hub for r in h) - 1) < 1e-9 and abs(sum(r.authority for r in h) - 1) < 1e-9


def test_personalized_pagerank_mass(spark):
    seeds = spark.createDataFrame([(1,), (4,)], "seed long")
    p = GR.personalized_pagerank(edges_df(spark, GRAPHS["tri_tail"]), seeds).collect()
    for s in (1, 4):
        assert abs(sum(r.score for r in p if r.seed == s) - 1) < 1e-9


def test_orientations_and_nodes_read_edges_once(spark):
    e = edges_df(spark, [(1, 2, 3), (2, 2, 1), (2, 5, 4)])
    for d in (GB.symmetric(e), GB.nodes(e)):
        assert d._jdf.queryExecution().executedPlan().toString().count("Scan") == 1
    assert sorted(map(tuple, GB.symmetric(e).collect())) == [(1, 2, 3), (2, 1, 3), (2, 2, 1), (2, 5, 4), (5, 2, 4)]
    assert sorted(r.node for r in GB.nodes(e).collect()) == [1, 2, 5]


def test_personalized_pagerank_round_reads_the_last_once(spark, monkeypatch):
    e = edges_df(spark, [(1, 2, 3), (2, 2, 1), (2, 5, 4), (7, 8, 0)])
    seeds = spark.createDataFrame([(1,), (7,), (9,)], "seed long")
    chain = []

    def converge(x, step, *rest, **more):
        for _ in range(4):
            x = step(x)
        chain.append(x)
        return x

    with monkeypatch.context() as m:
        m.setattr(GR, "_converge", converge)
        GR.personalized_pagerank(e, seeds)
    assert chain[0]._jdf.queryExecution().optimizedPlan().toString().count("Join") == 4
    got = {(r.seed, r.node): r.score for r in GR.personalized_pagerank(e, seeds, tol=1e-12).collect()}
    t = np.array([[0, 1, 0], [3 / 8, 1 / 8, 4 / 8], [0, 1, 0]])
    x = 0.15 * np.linalg.inv(np.eye(3) - 0.85 * t.T)[:, 0]
    assert all(abs(got[1, n] - v) < 1e-9 for n, v in zip((1, 2, 5), x, strict=True)) and got[7, 7] == got[9, 9] == 1.0

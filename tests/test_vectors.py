import numpy as np
from pyspark.sql import functions as F

from conftest import SF_SMALL
from meridian.operators import kcenter as KC
from meridian.operators import pivots as P
from meridian.operators import vectors as V
from meridian.plans.iterate import cut
from meridian.sources import testdata as T


def _np(pts):
    rows = sorted(pts.collect(), key=lambda r: r.id)
    return np.array([r.id for r in rows]), np.array([r.features for r in rows])


def test_knn_join_matches_brute_force(spark):
    pts = T.points(spark, SF_SMALL, 8)
    ids, X = _np(pts)
    got = V.knn_join(pts, pts, 4, block=64).collect()   # several blocks on each side
    D = ((X[:, None] - X[None]) ** 2).sum(-1)
    for r in got:
        i = int(np.where(ids == r.qid)[0][0])
        order = sorted(range(len(ids)), key=lambda j: (D[i, j], ids[j]))[:4]
        assert r.nid == ids[order[r.rank - 1]]


def test_ball_join_matches_brute_force_with_blocks(spark):
    pts = T.points(spark, SF_SMALL, 2)
    ids, X = _np(pts)
    r = 0.05
    got = sorted((a.id_a, a.id_b) for a in V.ball_join(pts, pts, r, block=24).collect())
    D = np.sqrt(((X[:, None] - X[None]) ** 2).sum(-1))
    exp = sorted((ids[i], ids[j]) for i in range(len(ids)) for j in range(len(ids)) if D[i, j] <= r)
    assert got == exp


def clustered(spark, n=6000, dim=8, hot=1500):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(40, dim))[rng.integers(0, 40, n)] * 4 + 0.2 * rng.normal(size=(n, dim))
    x[:hot] = x[0]                                        # one vector with a quarter of all rows
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in enumerate(x)], "id long, features array<double>")
    return x, cut(df)


def test_pivots_exclude_most_blocks_and_lose_nothing(spark, monkeypatch):
    x, df = clustered(spark)
    q = df.where("id % 7 = 3")
    base = df.select(F.col("id").alias("nid"), F.col("features").alias("nf"))
    index = P.PivotBlocks(base, 200)
    assert index.size.sum() == len(x) and index.size.max() < 500 and index.blocks > 20
    visits = []
    plain = P.PivotBlocks.meet
    monkeypatch.setattr(P.PivotBlocks, "meet", lambda self, routed, *a: plain(self, (visits.append(cut(routed)), visits[-1])[1], *a))
    got = {}
    for r in V.knn_join(q, df, 4, block=200).collect():
        got.setdefault(r.qid, {})[r["rank"]] = (r.nid, r.distance)
    ids = [r.id for r in q.collect()]
    d = np.sqrt(((x[ids][:, None] - x[None]) ** 2).sum(-1))
    for i, row in zip(ids, d, strict=True):
        order = np.lexsort((np.arange(len(x)), row))[:4]
        assert [got[i][k][0] for k in (1, 2, 3, 4)] == order.tolist()
    assert sum(v.count() for v in visits) < 0.25 * len(ids) * index.blocks
    near = {(r.id_a, r.id_b) for r in V.ball_join(q, df, 0.6, block=200).collect()}
    assert near == {(i, int(j)) for i, row in zip(ids, d, strict=True) for j in np.flatnonzero(row <= 0.6)}
    weight = {r.id: r.ball_weight for r in V.ball_weights(q, df, 0.6, block=200).collect()}
    assert weight == {i: float((row <= 0.6).sum()) for i, row in zip(ids, d, strict=True)}


def test_knn_with_few_rows_and_none(spark):
    df = spark.createDataFrame([(i, [float(i), 0.0]) for i in range(5)], "id long, features array<double>")
    got = sorted((r.qid, r["rank"], r.nid) for r in V.knn_join(df.where("id < 2"), df, 9, block=2).collect())
    assert got == [(0, i + 1, i) for i in range(5)] + [(1, 1, 1), (1, 2, 0), (1, 3, 2), (1, 4, 3), (1, 5, 4)]
    assert V.knn_join(df, df.limit(0), 3).count() == 0 and V.knn_join(df.limit(0), df, 3).count() == 0


def test_coreset_weights_sum_to_n(spark):
    pts = T.points(spark, SF_SMALL, 2)
    core = KC.extract_coreset(pts, 3, 2, 4).collect()
    assert abs(sum(r.weight for r in core) - pts.count()) < 1e-9
    assert len(core) <= 4 * (3 + 2 + 1)


def test_farthest_first_brute_force(spark):
    pts = T.points(spark, SF_SMALL, 2)
    ids, X = _np(pts)
    chosen = [0]
    d = ((X - X[0]) ** 2).sum(1)
    for _ in range(3):
        j = int(np.argmax(d))
        chosen.append(j)
        d = np.minimum(d, ((X - X[j]) ** 2).sum(1))
    got = [r.id for r in KC.farthest_first(pts, 4).orderBy("rank").collect()]
    assert got == [int(ids[c]) for c in chosen]


def test_two_round_objective_close_to_sequential(spark):
    pts = T.points(spark, SF_SMALL, 2)
    w = pts.select("id", "features").withColumn("weight", __import__("pyspark.sql.functions", fromlist=["lit"]).lit(1.0))
    seq_centers, _ = KC.weighted_kcenter_outliers(w, 3, 2, 0.0)
    mr_centers, rep = KC.mr_kcenter_outliers(pts, 3, 2, 4)
    o_seq = KC.kcenter_objective(pts, seq_centers, 2)
    o_mr = KC.kcenter_objective(pts, mr_centers, 2)
    assert 0 < o_mr <= 10 * o_seq and rep["n_guesses"] >= 1


def test_products_sort_out_what_differences_decide():
    rng = np.random.default_rng(9)
    x = rng.normal(size=(300, 5)) + 1e4                       # squared distances cancel in a product
    x[40:90] = x[7]
    x[100:140] = x[7] + 1e-7 * rng.normal(size=(40, 5))
    a = x[::3]
    d = P.distances(a, x)
    for worst in (np.full(len(a), np.inf), np.sort(d, axis=1)[:, 20]):
        i, j, got = P.k_nearest(a, x, 6, worst)
        order = np.argsort(d, axis=1, kind="stable")[:, :6]
        assert (j.reshape(-1, 6) == order).all() and (got.reshape(-1, 6) == np.take_along_axis(d, order, axis=1)).all()
    for radius in (0.0, float(d[0, 110]), 1.5, -1.0, float("inf")):
        ok = np.concatenate([ok for _, ok in P.is_within(a, x, radius)])
        assert (ok == (d <= radius)).all()


def test_a_query_goes_once_to_a_group_of_blocks(spark, monkeypatch):
    monkeypatch.setattr(P, "GROUPS", 3)
    x, df = clustered(spark, n=1500, hot=300)
    q = df.where("id % 5 = 3").selectExpr("id AS qid", "features AS qf")
    index = P.PivotBlocks(df.selectExpr("id AS nid", "features AS nf"), 60)
    assert index.blocks > 20 and index.groups == 3
    routed = index.route(q, lambda index, x, batch: np.ones((len(x), index.blocks), bool)).collect()
    assert len(routed) == 3 * q.count()
    for i in {r.qid for r in routed}:
        assert sorted(b for r in routed if r.qid == i for b in r.blocks) == list(range(index.blocks))
    ids = sorted(r.qid for r in q.collect())
    d = np.sqrt(((x[ids][:, None] - x[None]) ** 2).sum(-1))
    got = {(r.qid, r["rank"]): r.nid for r in V.knn_join(df.where("id % 5 = 3"), df, 7, block=60).collect()}
    for i, row in zip(ids, d, strict=True):
        assert [got[i, k + 1] for k in range(7)] == np.lexsort((np.arange(len(x)), row))[:7].tolist()


def test_screens_in_single_precision_stay_exact():
    """Rows are sorted out by a product in single precision; what it cannot tell apart goes to differences."""
    rng = np.random.default_rng(5)
    for shift, scale in ((0, 1), (1e6, 1e-3), (0, 1e30), (0, 1e-30), (3, 1e-9)):
        a, x = (shift + scale * rng.normal(size=(n, 9)) for n in (300, 700))
        assert all(near.dtype == np.float32 for _, near, *_ in P.closeness(a, x))
        d = P.distances(a, x)
        radius = float(np.partition(d.ravel(), 5000)[5000])             # a pair lies at just this distance
        for r in (radius, float(np.median(d)), 0.0, -1.0):
            assert (np.concatenate([ok for _, ok in P.is_within(a, x, r)]) == (d <= r)).all()
        i, j, got = P.k_nearest(a, x, 4, np.full(len(a), np.inf))
        assert (j.reshape(-1, 4) == np.argsort(d, axis=1, kind="stable")[:, :4]).all() and (got == d[i, j]).all()

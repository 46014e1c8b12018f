import numpy as np
import pytest

from conftest import SF_SMALL
from meridian.operators import kernel as K
from meridian.operators import ssl as S
from meridian.plans.iterate import cut
from meridian.sources import testdata as T


@pytest.fixture(scope="module")
def lp(spark):
    return cut(T.labeled_points(spark, SF_SMALL, dims=4))


@pytest.fixture(scope="module")
def dense(lp):
    """ids, S + S_bar, W_bar, B, truth of the unlabelled rows by plain numpy."""
    rows = sorted(lp.collect(), key=lambda r: r.id)
    x, lab = np.array([r.features for r in rows]), np.array([r.is_labeled for r in rows])
    ybar, ids = np.array([r.label for r in rows], float), np.array([r.id for r in rows])
    w = np.exp(-0.5 * np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1)))
    inner = w[np.ix_(~lab, ~lab)]
    outer = w[np.ix_(lab, ~lab)]
    return ids[~lab], outer.sum(0) + inner.sum(0), inner, ybar[lab] @ outer, np.array([r.y_true for r in rows])[~lab]


def test_gradient_matches_dense_numpy(lp, dense):
    ids, total, inner, b, _ = dense
    y0 = {r.id: r.y for r in S.random_start(lp).collect()}
    y = np.array([y0[i] for i in ids])
    grad = 2 * (y * total - b - inner @ y)
    totals = S.similarity_totals(lp)
    tiles = K.KernelTiles(lp.where("not is_labeled"), tile=60)
    for t in (None, tiles):
        got = {r.id: r.grad for r in S.gradient(lp, totals, S.random_start(lp), tiles=t).collect()}
        assert np.allclose([got[i] for i in ids], grad, atol=1e-9)


def test_tiles_in_one_task_in_many_and_in_jobs(lp, dense):
    ids, _, inner, _, _ = dense
    tiles = K.KernelTiles(lp.where("not is_labeled"), tile=60)
    assert tiles.tiles.count() > 3 and sorted(tiles.ids) == sorted(ids)
    at = np.searchsorted(ids, tiles.ids)
    want = inner[np.ix_(at, at)]
    d = np.random.default_rng(1).random((len(ids), 2))
    d[:100, 0] = 0

    def program():
        first = yield d
        second = yield first[:, :1]
        return [(i, float(first[i, 0]), float(second[i, 0])) for i in range(len(d))]

    for tasks in (0, 1, 2):
        got = np.array(sorted(tuple(r) for r in tiles.run(program, "i int, a double, b double", tasks).collect()))
        assert np.allclose(got[:, 1], want @ d[:, 0], rtol=1e-12)
        assert np.allclose(got[:, 2], want @ (want @ d[:, 0]), rtol=1e-12)


def test_every_method_ends_at_the_minimum(lp, dense):
    ids, total, inner, b, truth = dense
    best = np.linalg.solve(np.diag(total) - inner, b)
    columns = [(m, s) for s in S.STARTS for m in S.METHODS]
    found = S.solve(S.problem(lp), columns).collect()
    history = [r for r in found if r.iteration is not None]
    for m, s in columns:
        y = {r.id: r.y for r in found if r.id is not None and (r.method, r.start) == (m, s)}
        assert np.allclose([y[i] for i in ids], best, atol=1e-8)
        own = sorted((r.iteration, r.grad_norm, r.accuracy) for r in history if (r.method, r.start) == (m, s))
        assert own[-1][1] <= 1e-8 and [x[0] for x in own] == list(range(len(own))) and len(own) < 10_000
        assert own[-1][2] == pytest.approx((np.where(best >= 0, 1, -1) == truth).mean())
        if m != "gd_nesterov":                             # the loss never rises, nor does plain descent's gradient
            assert m != "gd" or all(p[1] >= q[1] for p, q in zip(own, own[1:]))


def test_first_rounds_are_the_textbook_ones(lp, dense):
    ids, total, inner, b, _ = dense
    L = 2 * np.linalg.eigvalsh(np.diag(total) - inner).max()
    assert S.lipschitz_constant(lp).first().L == pytest.approx(L, rel=1e-8)
    y0 = {r.id: r.y for r in S.random_start(lp).collect()}
    h = {(r.method, r.iteration): r.grad_norm for r in S.training_history(
        lp, [("gd", "random"), ("gd_nesterov", "random"), ("bcgd_cyclic", "random"), ("bcgd_gauss_southwell", "random")], rounds=8).collect()}
    group = {r.id: r.g for r in lp.selectExpr("id").withColumn("g", __import__("pyspark").sql.functions.pmod(
        S.hash_int("id", S.BLOCK_SEED), __import__("pyspark").sql.functions.lit(4))).collect()}
    group = np.array([group[i] for i in ids])
    grad = lambda y: 2 * (y * total - b - inner @ y)
    bound = [max(2 * (total - 1)[group == k] + 2 * (inner[np.ix_(group == k, group == k)].sum(1) - 1)) for k in range(4)]
    for method in ("gd", "gd_nesterov", "bcgd_cyclic", "bcgd_gauss_southwell"):
        y = np.array([y0[i] for i in ids])
        x, lam = y.copy(), 1.0
        for r in range(9):
            g = grad(y)
            assert h[method, r] == pytest.approx(np.linalg.norm(g), rel=1e-7)
            if method == "gd":
                y = y - g / L
            elif method == "gd_nesterov":
                then = (1 + np.sqrt(1 + 4 * lam * lam)) / 2
                new = y - g / L
                y, x, lam = new + (lam - 1) / then * (new - x), new, then
            else:
                k = r % 4 if method == "bcgd_cyclic" else int(np.argmax([np.linalg.norm(g[group == j]) for j in range(4)]))
                y = y - np.where(group == k, g / bound[k], 0)


def test_no_unlabelled_and_one_unlabelled_row(spark):
    df = spark.createDataFrame([(1, [0.0, 1.0], 1, 1, True), (2, [1.0, 1.0], 0, -1, False)],
                               "id long, features array<double>, label int, y_true int, is_labeled boolean")
    assert [(r.id, round(r.y, 6)) for r in S.solution(df, "gd", "knn").collect()] == [(2, 1.0)]
    assert S.solution(df.where("is_labeled"), "bcgd_cyclic", "random").count() == 0


def test_tiles_are_stored_in_strips_or_not_at_all(lp, dense, monkeypatch):
    ids, _, inner, _, _ = dense
    monkeypatch.setattr(K, "STRIP", 16)
    monkeypatch.setattr(K, "SLICE", 23)
    points = lp.where("not is_labeled")
    stored = K.KernelTiles(points, tile=60)
    assert max(len(r.w) for r in stored.tiles.collect()) <= 16 * 8 * max(np.diff(stored.first))
    monkeypatch.setattr(K, "HELD_BYTES", 64)
    for tiles in (stored, K.KernelTiles(points, tile=60)):
        d = np.random.default_rng(5).random((len(ids), 2))
        d[3:40, 1] = 0
        at = np.searchsorted(ids, tiles.ids)
        want = inner[np.ix_(at, at)] @ d
        assert np.allclose(tiles.product(d), want)

        def program(d=d):
            got = yield d
            return [(i, float(x[0]), float(x[1])) for i, x in enumerate(got)]

        assert np.allclose([r[1:] for r in sorted(tiles.run(program, "i int, a double, b double").collect())], want)
    assert "w" in stored.tiles.columns and "w" not in tiles.tiles.columns


def test_kernel_sums_blocks_stay_few(lp, dense, monkeypatch):
    ids, total, _, b, _ = dense
    monkeypatch.setattr(S, "STEP", 17)
    lab, unl = lp.where("is_labeled").selectExpr("id", "features", "label ybar"), lp.where("not is_labeled")
    got = {r.id: r for r in S.kernel_sums(unl, lab, ["one", "ybar"], tile=4).collect()}
    assert np.allclose([got[i].s_ybar for i in ids.tolist()], b)
    sent = []
    explode = S.F.explode
    monkeypatch.setattr(S.F, "explode", lambda c: sent.append(c) or explode(c))
    inner = S.kernel_sums(unl, unl, ["one"], tile=4)
    outer = {i: got[i].s_one for i in got}
    assert np.allclose([outer[r.id] + r.s_one for r in sorted(inner.collect())], total)
    assert unl.limit(1).select(explode(sent[0])).count() <= S.SPLITS


def test_cores_of_an_executor_are_found_where_the_master_names_them():
    from types import SimpleNamespace as N

    from meridian.operators.kernel import executor_cores

    def session(master, cores=None):
        conf = N(get=lambda key, default=None: cores or default)
        return N(sparkContext=N(master=master, defaultParallelism=8, getConf=lambda: conf))

    assert executor_cores(session("local-cluster[3,4,10240]")) == 4
    assert executor_cores(session("local[*]")) == 8
    assert executor_cores(session("spark://host:7077", "6")) == 6 and executor_cores(session("yarn")) == 1


def test_solvers_multiply_only_new_directions(dense):
    ids, total, inner, b, truth = dense
    group = np.sort(ids % 4)
    first = np.searchsorted(group, np.arange(5))
    start = {"random": np.random.default_rng(3).random(len(ids)) * 2 - 1}
    columns = [("gd", "random"), ("bcgd_cyclic", "random"), ("bcgd_random_lipschitz", "random")]
    running, times = S.descent(total - inner.sum(1), b, truth, group, first, columns, start, 10_000, 1e-8), 0
    try:
        d = next(running)
        while True:
            times, d = times + 1, running.send(inner @ d)
    except StopIteration as end:
        rows, y = end.value
    assert np.allclose(y, np.linalg.solve(np.diag(total) - inner, b)[:, None], atol=1e-8)
    grad = np.linalg.norm(2 * (y * total[:, None] - b[:, None] - inner @ y), axis=0)
    assert (grad <= 1.05e-8).all()                          # measured with all products, not with the span
    assert len(rows) > 1_000 and times < len(rows) / 5


def test_span_allows_no_more_than_it_is_told():
    rng = np.random.default_rng(8)
    w = rng.random((40, 40))
    own, d = [slice(0, 25), slice(25, 40)], rng.random((3, 40))
    span, sums, asked = K.Span(40, 2, own, np.linalg.norm(w, 2)), np.zeros((2, 40)), 0

    def product(step, allowed):
        nonlocal asked
        running = span.product(step, allowed)
        try:
            x = next(running)
            asked += x.shape[1]
            running.send(w @ x)
        except StopIteration as end:
            return end.value

    moved = np.zeros((2, 40))
    for r in range(60):
        step = np.stack([(0.8 ** r) * d[r % 2], (0.7 ** r) * np.where(np.arange(40) < 25, d[2], 0)])
        moved += step
        sums += product(step, np.array([1e-6, 1e-9]))
        assert (np.linalg.norm(sums - moved @ w.T, axis=1) <= (1e-6, 1e-9)).all()
    sums += product(np.zeros((2, 40)), np.zeros(2))
    assert np.allclose(sums, moved @ w.T, rtol=0, atol=1e-12) and asked < 12


def test_one_task_is_sent_vectors_and_writes_no_tiles(lp, dense):
    ids, _, inner, _, _ = dense
    tiles = K.KernelTiles(lp.where("not is_labeled"), tile=60)

    def program():
        got = yield np.ones((len(ids), 1))
        return [(i, float(x)) for i, x in enumerate(got[:, 0])]

    got = [r.a for r in sorted(tiles.run(program, "i int, a double").collect())]
    assert np.allclose(got, inner[np.searchsorted(ids, tiles.ids)].sum(1)) and "tiles" not in vars(tiles)

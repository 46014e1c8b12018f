"""Hard negatives against brute force, and the tree's bounds."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from meridian.llm import hard_negatives as H

ROWS = "vec_id long, embedding array<float>, label int, row int, q string, block int"


def table(seed, n, dim=6, spread=0.3):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(6, dim))
    x = (centre[rng.integers(0, 6, n)] + spread * rng.normal(size=(n, dim))).astype(np.float32)
    x[n // 2:n // 2 + 40] = x[n // 2]                     # equal vectors: ties
    label = rng.integers(0, 4, n)
    label[: n // 3] = 1                                   # a label with a third of all rows
    rows = [(i, v.tolist(), int(y), 1, "x", 2) for i, (v, y) in enumerate(zip(x, label, strict=True))]
    rows += [(n, None, 1, 1, "x", 2), (n + 1, [0.5] * dim, None, 1, "x", 2), (n + 2, [0.5] * (dim - 1) + [None], 1, None, None, None),
             (n + 3, [float("nan")] * dim, 1, 1, "x", 2), (n + 4, [float("inf")] + [0.0] * (dim - 1), 1, 1, "x", 2),
             (None, [0.1] * dim, 1, 1, "x", 2), (n + 5, [], 2, 1, "x", 2), (1000, [0.25] * (dim - 2), 2, 1, "x", 2), (2000, [1e-9] * dim, 3, 1, "x", 2)]
    return rows


def brute(rows, every):
    rows = [(i, np.floor(256 * np.array(v, np.float64)).astype(int).tolist(), y) for i, v, y, *_ in rows
            if i is not None and y is not None and v is not None and all(c is not None and np.isfinite(c) for c in v)]
    out = []
    for k, (i, a, y) in enumerate(rows):
        if i % every:
            continue
        scored = sorted((-sum(p * q for p, q in zip(a, x)), j, z) for m, (j, x, z) in enumerate(rows) if m != k)
        for s, j, _ in [r for r in scored if r[2] == y][:5]:
            p = -s
            ok = [(-t, m) for t, m, z in scored if z != y and 30 * p <= -100 * t <= 90 * p][:10]
            out += [(i, j, n + 1, m, p, t) for n, (t, m) in enumerate(ok)]
    return sorted(out)


@pytest.mark.parametrize(("seed", "n", "every"), [(1, 700, 20), (2, 900, 7)])
def test_against_brute_force(spark, monkeypatch, seed, n, every):
    monkeypatch.setattr(H, "ROWS", 250)
    monkeypatch.setattr(H, "ANCHORS", 16)
    rows = table(seed, n)
    df = spark.createDataFrame(rows, ROWS).repartition(3)
    got = H.hard_negatives(H.quantised(df), F.col("ident") % every == 0)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, every)


def test_rows_that_share_an_id(spark):
    rows = [(0, [1.0, 0.0], 1), (0, [1.0, 0.0], 1), (100, [0.5, 0.0], 2), (7, [0.9, 0.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = sorted(tuple(r) for r in H.hard_negatives(H.quantised(df), F.col("ident") == 0).collect())
    assert got == sorted([(0, 0, 1, 100, 65536, 32768), (0, 7, 1, 100, 58880, 32768)] * 2)


def test_empty(spark):
    assert H.hard_negatives(H.quantised(spark.createDataFrame([], ROWS)), F.col("ident") % 2 == 0).count() == 0


def test_bounds_spare_work_and_lose_nothing(monkeypatch):
    rng = np.random.default_rng(3)
    centre = 400 * rng.normal(size=(8, 16))
    x = np.concatenate([c + 4 * rng.normal(size=(60, 16)) for c in centre]).astype(np.int64)
    anchors = np.concatenate([c + 4 * rng.normal(size=(8, 16)) for c in centre]).astype(np.int64)
    tree = H.Tree(anchors)
    full = anchors @ x.T
    low, high = np.quantile(full, 0.97, axis=1), np.full(len(anchors), np.inf)
    asked = []
    for name in ("inner", "_pairs"):
        plain = getattr(H, name)
        monkeypatch.setattr(H, name, lambda a, b, plain=plain, name=name: (asked.append(len(a) * (len(b) if name == "inner" else 1)), plain(a, b))[1])
    a, r, s = tree.scored(x, low, high, lambda level: np.ones((len(level), len(x)), bool))
    want = {(i, j) for i, j in zip(*np.nonzero(full >= low[:, None]), strict=True)}
    assert {(int(i), int(j)) for i, j in zip(a, r, strict=True)} == want and (s == full[a, r]).all()
    assert sum(asked) < 0.5 * full.size


def test_scores_beyond_doubles():
    big = np.array([[1 << 25, 3], [5, 1 << 25]], np.int64)
    assert H.inner(big, big).tolist() == [[(1 << 50) + 9, 8 << 25], [8 << 25, (1 << 50) + 25]]
    with pytest.raises(OverflowError):
        H.inner(big * 8, big)

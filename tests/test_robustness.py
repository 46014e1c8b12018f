import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import edges_df
from meridian.operators import relational as R
from meridian.operators.graph import robustness as RB
from meridian.operators.scan import Ranges


def one_by_one(pairs, order):
    """giant and kappa after every removal by plain search."""
    alive, out, base = list(order), [], None
    while alive:
        left = set(alive)
        own = [(u, v) for u, v in pairs if u in left and v in left]
        parent = {x: x for x in left}

        def root(x, parent=parent):
            while parent[x] != x:
                x = parent[x]
            return x

        for u, v in own:
            parent[root(u)] = root(v)
        giant = max(np.unique([root(x) for x in left], return_counts=True)[1])
        base = base or giant
        k = {}
        for u, v in own:
            k[u] = k.get(u, 0) + 1
            k[v] = k.get(v, 0) + 1
        k = np.array(list(k.values()), float)
        out.append((giant / base, (k ** 2).mean() / k.mean() if len(k) else None))
        alive.pop(0)
    return out


@pytest.mark.parametrize("block", [2_000_000, 25])
def test_curve_equals_one_by_one_removal(spark, block, monkeypatch):
    rng = np.random.default_rng(6)
    pairs = {tuple(sorted(map(int, rng.integers(0, 120, 2)))) for _ in range(190)} | {(i, i) for i in range(120)}
    order = rng.permutation(120).tolist()
    monkeypatch.setattr(RB.giant_by_time, "__defaults__", (block,))
    ranks = spark.createDataFrame([(x, i) for i, x in enumerate(order)], "node long, rank long")
    got = RB.removal_curve(edges_df(spark, sorted(pairs)), ranks).orderBy("n_removed").collect()
    want = one_by_one(sorted(pairs), order)
    assert len(got) == 120
    for r, (share, kappa) in zip(got, want, strict=True):
        assert r.giant_share == pytest.approx(share) and r.kappa == (pytest.approx(kappa) if kappa else None)


def test_running_sums_and_neighbours_across_ranges(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(1000).select((F.col("id") * 37 % 1000).alias("k"), (F.col("id") % 5).alias("v"))
        rows = sorted((r.k, r.v) for r in df.collect())
        scan = Ranges(df, [F.col("k")])
        assert scan.rows.select("__part").distinct().count() > 3
        got = {r.k: (r.s, r.n) for r in scan.sums(s="v", n="1").collect()}
        total = np.cumsum([v for _, v in rows])
        assert got == {k: (int(t), i + 1) for i, ((k, _), t) in enumerate(zip(rows, total, strict=True))}
        nxt = {r.k: r.x for r in scan.following("v", "x").collect()}
        assert nxt == {k: (rows[i + 1][1] if i + 1 < 1000 else None) for i, (k, _) in enumerate(rows)}
        top = {r.k: r.x for r in Ranges(df, [F.desc("k")]).running_max("v", "x").collect()}
        assert all(top[k] == max(v for j, v in rows if j >= k) for k in range(0, 1000, 50))
        gap = R.largest_gap(df.select(F.col("k").alias("pos"), (F.col("k") * F.col("k")).alias("value"))).first()
        assert gap.pos == 998 and gap.gap == 999 ** 2 - 998 ** 2
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert Ranges(df.limit(0), [F.col("k")]).sums(s="v").count() == 0


def test_targeted_curve_searches_components_once(spark, monkeypatch):
    rng = np.random.default_rng(9)
    pairs = sorted({tuple(sorted(map(int, rng.integers(0, 60, 2)))) for _ in range(110)} | {(100, 100), (200, 201)})
    alive, want, base = {x for p in pairs for x in p}, [], None
    n = len(alive)
    batch = -(-n // 7)
    order = []
    for _ in range(8):
        own = [(u, v) for u, v in pairs if not {u, v} & set(order)]
        giant, kappa = (one_by_one(own, sorted({x for p in own for x in p}))[0] if own else (0, None))
        k = {}
        for x in (x for p in own for x in p):
            k[x] = k.get(x, 0) + 1
        parts = {x: {x} for p in own for x in p}
        for u, v in own:
            if parts[u] is not parts[v]:
                parts[u] |= parts[v]
                for x in parts[u]:
                    parts[x] = parts[u]
        most = max((len(p) for p in parts.values()), default=int(len(order) < n))
        base = base or most
        want.append((len(order) / n, most / base, kappa))
        if not own or len(order) >= n - 1:
            break
        order += sorted(k, key=lambda x: (-k[x], x))[:batch]
    calls = []
    real = RB.connected_components
    monkeypatch.setattr(RB, "connected_components", lambda e: calls.append(1) or real(e))
    got = sorted(tuple(r) for r in RB.targeted_removal_curve(edges_df(spark, pairs), steps=7).collect())
    assert [r[:2] for r in got] == [pytest.approx(w[:2]) for w in want]
    assert [r[2] for r in got] == [None if w[2] is None else pytest.approx(w[2]) for w in want]
    assert len(calls) < len(got)          # not one search a step


def test_nth_of_tied_rows_by_passes(spark):
    from meridian.operators import sampling as SA
    df = spark.range(3000).select((F.col("id") * 1_000_003 - 7_000_000_000).alias("id"), F.lit(5).alias("h"))
    got = sorted(r.id for r in SA.smallest_n(df, 1234, "h", ["id"]).collect())
    assert got == [i * 1_000_003 - 7_000_000_000 for i in range(1234)]
    assert SA._nth_tie(df, 1234, ["id"]) == (1233 * 1_000_003 - 7_000_000_000,)


def test_forest_of_tasks_and_of_rounds(spark, monkeypatch):
    rng = np.random.default_rng(4)
    rows = sorted({(*sorted(map(int, rng.integers(0, 90, 2))), int(rng.integers(0, 6))) for _ in range(600)})
    df = spark.createDataFrame(rows, "u long, v long, w long").repartition(5)
    parent, want = {}, set()

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for u, v, w in sorted(rows, key=lambda r: (-r[2], r[0], r[1])):
        if root(u) != root(v):
            parent[root(u)] = root(v)
            want.add((u, v, w))
    for block, held in ((None, 500_000), (3, 500_000), (3, 20)):
        monkeypatch.setattr(RB, "FOREST_ROWS", held)
        assert {tuple(r) for r in RB.spanning_forest(df, block).collect()} == want

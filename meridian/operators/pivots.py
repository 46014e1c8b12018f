"""Blocks of near vectors with triangle-inequality bounds, for exact searches.

Base rows go to the cell of their nearest pivot (a bounded draw of base rows); a cell is
cut into rings by the distance to its pivot, and an overfull ring by hash, so a block has
about ``BLOCK`` rows however the rows crowd.  Of every block the least and largest
distance to its own pivot and to some common reference pivots are known.  For a query q
and any pivot p, d(q, x) >= |d(q, p) - d(x, p)|, so a block whose bound exceeds what
the query looks for (its k-th distance so far, or a radius) cannot hold anything for it, and
the query is not sent there.  Blocks never meet blocks: base rows move once, queries go to
the blocks that their bounds leave.  Blocks that lie together form a group (``GROUPS`` of them, more only
beyond ``GROUP_ROWS`` rows each): a query is sent once to a group, with the list of the blocks it
visits there, so vectors are copied by groups and compared by blocks.  A group that many queries visit
takes them in shares.  In a task one matrix product sorts out the rows that are surely too
far; distances of the others are computed by differences.

Results are exact; only the work depends on the data: on clustered rows most blocks are
excluded, on rows without structure few are.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meridian.functions.draws import hash_int
from meridian.plans.iterate import cut

BLOCK = 2048
#: Pivots, those that all blocks keep bounds of, rings of a cell, and blocks, at most.
PIVOTS, REFERENCES, RINGS, BLOCKS = 256, 8, 256, 1 << 16
#: Groups of blocks, and rows of a group from which on there are more.
GROUPS, GROUP_ROWS = 32, 1 << 16
#: Queries that meet a group in one task.
SHARE = 1 << 15


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All Euclidean distances between rows, by differences, in slices of bounded size."""
    out = np.empty((len(a), len(b)))
    step = max(1, (1 << 22) // max(1, b.size))
    for lo in range(0, len(a), step):
        out[lo:lo + step] = np.sqrt(((a[lo:lo + step, None, :] - b[None, :, :]) ** 2).sum(axis=2))
    return out


def matrix(column) -> np.ndarray:
    """A column of vectors of one length, of Arrow or of pandas."""
    if isinstance(column, pa.Array):
        return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), -1)
    return np.stack(column.to_numpy()).astype(float)


class PivotBlocks:
    """``base``: nid, nf.  ``rows``: the same with their block; ``blocks``: how many there are."""

    def __init__(self, base: DataFrame, block: int | None = None):
        n = base.count()
        block = max(block or BLOCK, math.ceil(n / BLOCKS))
        self.pivots = np.zeros((0, 0))
        self.blocks = self.groups = 1
        if n <= block:
            self.rows = base.withColumn("block", F.lit(0))
            self.size = np.array([n])
            return
        count = min(PIVOTS, math.ceil(n / block))
        chosen = base.orderBy(hash_int("nid", 31), "nid").limit(count).collect()          # at most PIVOTS rows
        pivots = self.pivots = np.array([r.nf for r in chosen], float)
        refs = self.refs = min(REFERENCES, len(pivots))

        def assign(batches):
            for b in batches:
                d = distances(matrix(b.column("nf")), pivots)
                cell = d.argmin(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [b.column("nid"), b.column("nf"), pa.array(cell.astype(np.int32)), pa.array(d[np.arange(len(d)), cell]),
                     pa.array(list(d[:, :refs]), pa.list_(pa.float64()))], names=["nid", "nf", "cell", "own", "refs"])

        near = cut(base.select("nid", F.col("nf").cast("array<double>").alias("nf")).mapInArrow(
            assign, "nid long, nf array<double>, cell int, own double, refs array<double>"))
        rings = F.least(F.ceil(F.col("n") / block), F.lit(RINGS)).cast("int")
        shares = [F.lit(i / RINGS) for i in range(1, RINGS)]
        cells = near.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("own", F.array(*shares)).alias("marks"))
        # The ring bounds of a cell are every (RINGS / rings)-th mark; a ring that is still too full is parted by hash.
        cells = cells.withColumn("rings", rings).select(
            "cell", "rings", F.expr(f"transform(sequence(1, greatest(rings - 1, 1)), i -> get(marks, cast(i * {RINGS} / rings as int) - 1))").alias("marks"))
        ring = F.when(F.col("rings") == 1, 0).otherwise(F.size(F.filter("marks", lambda m: m < F.col("own"))))
        ringed = near.join(cells, "cell").select("nid", "nf", "own", "refs", "cell", ring.alias("ring"))
        parts = ringed.groupBy("cell", "ring").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("parts"))
        part = F.pmod(hash_int("nid", 32), F.col("parts")).cast("int").alias("part")
        key = ["cell", "ring", "part"]
        named = cut(ringed.join(parts, ["cell", "ring"]).select("nid", "nf", "own", "refs", "cell", "ring", part))
        bounds = [f(F.col("refs")[i]).alias(f"{s}{i}") for i in range(refs) for f, s in ((F.min, "lo"), (F.max, "hi"))]
        stats = named.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.min("own").alias("low"), F.max("own").alias("high"), *bounds).orderBy(*key)
        found = stats.collect()                                  # at most a few times BLOCKS rows
        self.blocks = len(found)
        self.groups = min(self.blocks, max(GROUPS, math.ceil(n / GROUP_ROWS)))
        self.size = np.array([r.n for r in found])
        self.cell = np.array([r.cell for r in found])
        self.low, self.high = (np.array([[r[c], *(r[f"{s}{i}"] for i in range(refs))] for r in found]) for c, s in (("low", "lo"), ("high", "hi")))
        number = base.sparkSession.createDataFrame([(r.cell, r.ring, r.part, i) for i, r in enumerate(found)], "cell int, ring int, part int, block int")
        self.rows = named.join(number, key).select("nid", "nf", "block")

    def bound(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each row of x and every block: a lower bound (a little below what it is) of the
        distance to the block's rows, and the distance to its pivot."""
        if len(self.pivots) == 0:
            return np.zeros((len(x), 1)), np.zeros((len(x), 1))
        d = distances(x, self.pivots)
        out = np.zeros((len(x), self.blocks))
        for i in range(self.refs + 1):
            own = d[:, self.cell] if i == 0 else d[:, i - 1:i]
            np.maximum(out, self.low[None, :, i] - own, out=out)
            np.maximum(out, own - self.high[None, :, i], out=out)
        return out * (1 - 1e-9) - 1e-9, d[:, self.cell]

    def _arrays(self) -> PivotBlocks:
        """The bounds alone, to send to tasks."""
        out = object.__new__(PivotBlocks)
        for k in ("pivots", "blocks", "groups", "size", "refs", "cell", "low", "high"):
            if hasattr(self, k):
                setattr(out, k, getattr(self, k))
        return out

    def route(self, queries: DataFrame, choose: Callable) -> DataFrame:
        """``queries`` (qid, qf, and others) once for each group that has blocks which
        ``choose(index, x, batch)`` marks (rows x blocks), with these blocks."""
        shared = queries.sparkSession.sparkContext.broadcast(self._arrays())          # at most BLOCKS bounds
        names = queries.columns

        def body(batches):
            index = shared.value
            of = np.arange(index.blocks) * index.groups // index.blocks
            for b in batches:
                step = max(1, min((1 << 21) // index.blocks, 1024))
                for lo in range(0, b.num_rows, step):
                    part = b.slice(lo, step)
                    row, block = np.nonzero(choose(index, matrix(part.column("qf")), part))
                    if len(row):
                        first = np.flatnonzero(np.concatenate(([True], (np.diff(row) != 0) | (np.diff(of[block]) != 0))))
                        at = pa.array(row[first])
                        lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(row)).astype(np.int32)), pa.array(block.astype(np.int32)))
                        yield pa.RecordBatch.from_arrays([*(part.column(c).take(at) for c in names), pa.array(of[block[first]].astype(np.int32)), lists],
                                                         names=[*names, "group", "blocks"])

        schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in queries.schema.fields)
        return queries.mapInArrow(body, f"{schema}, group int, blocks array<int>")

    def meet(self, routed: DataFrame, task: Callable, schema: str, rows: DataFrame | None = None) -> DataFrame:
        """``task(queries, a, rows, x, visits)`` for each group and share of the queries that visit it: a and x are
        the vectors, ``visits`` has for each block the positions of its queries and the slice of its rows (by nid).
        ``rows``: other rows that stand for the blocks' own (some of them, or with more columns)."""
        routed = cut(routed)
        shares = routed.groupBy("group").agg(F.ceil(F.count(F.lit(1)) / SHARE).cast("int").alias("shares"))
        q = routed.join(shares, "group").withColumn("share", F.pmod(hash_int("qid", 33), F.col("shares")).cast("int")).drop("shares")
        b = (self.rows if rows is None else rows).withColumn("group", F.expr(f"cast(cast(block as bigint) * {self.groups} div {self.blocks} as int)"))
        b = b.join(shares, "group").withColumn("share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1))).drop("shares")
        names = [x.split()[0] for x in schema.split(", ")]

        def each(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            if left.empty or right.empty:
                return pd.DataFrame({c: pd.Series([], dtype=object) for c in names})
            right = right.sort_values(["block", "nid"])
            visited = np.concatenate(left["blocks"].to_numpy())
            at = np.repeat(np.arange(len(left)), left["blocks"].map(len).to_numpy())
            order = np.argsort(visited, kind="stable")
            visited, at, block = visited[order], at[order], right["block"].to_numpy()

            def visits():
                for k in np.unique(block):
                    lo, hi = np.searchsorted(visited, [k, k + 1])
                    if lo < hi:
                        yield at[lo:hi], slice(*np.searchsorted(block, [k, k + 1]))

            both = list(visits())
            if not both:
                return pd.DataFrame({c: pd.Series([], dtype=object) for c in names})
            return task(left, matrix(left["qf"]), right, matrix(right["nf"]), both)

        return q.groupBy("group", "share").cogroup(b.groupBy("group", "share")).applyInPandas(each, schema)


def by_differences(a: np.ndarray, x: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Distances of the pairs a[i], x[j], as ``distances`` computes them."""
    out = np.empty(len(i))
    for lo in range(0, len(i), 16_384):
        s = slice(lo, lo + 16_384)
        out[s] = np.sqrt(((a[i[s]] - x[j[s]]) ** 2).sum(axis=1))
    return out


def closeness(a: np.ndarray, x: np.ndarray):
    """Slices of a: where they begin, 2 a.x - x.x (larger is nearer) for all rows of x by one product in single
    precision, a.a, more than the rounding error of their difference, the squared distance, and the length that all
    of this takes for 1, so that nothing overflows."""
    unit = max((float(np.max(np.abs(m), initial=0, where=np.isfinite(m))) for m in (a, x)), default=0) or 1.0
    x = x / unit
    with np.errstate(invalid="ignore", over="ignore"):
        xx = (x * x).sum(axis=1)
        right = np.concatenate([2 * x, -xx[:, None]], axis=1).T.astype(np.float32)
        most = xx.max(initial=0)
        step = max(1, (1 << 18) // max(1, len(x)))
        for lo in range(0, len(a), step):
            part = a[lo:lo + step] / unit
            aa = (part * part).sum(axis=1)
            near = np.concatenate([part, np.ones((len(part), 1))], axis=1).astype(np.float32) @ right
            yield lo, near, aa, 1.2e-7 * (x.shape[1] + 8) * (aa + 2 * most) + 1e-30, unit


def below(v: np.ndarray) -> np.ndarray:
    """Single precision numbers that are not above v."""
    with np.errstate(over="ignore", invalid="ignore"):
        return np.nextafter(v.astype(np.float32), np.float32(-np.inf))


def k_nearest(a: np.ndarray, x: np.ndarray, k: int, worst: np.ndarray):
    """(i, j, distance) of each row's k nearest rows of x that are within ``worst`` (a distance a
    row), ordered by row, distance, j."""
    found = []
    for lo, near, aa, error, unit in closeness(a, x):
        limit = worst[lo:lo + len(near)]
        with np.errstate(invalid="ignore", over="ignore"):
            least = np.where(np.isinf(limit), -np.inf, aa - (limit / unit) ** 2 * (1 + 1e-12) - 2 * error)
            loose = np.isinf(limit)
            if len(x) > k and loose.any():
                least[loose] = np.partition(near[loose], len(x) - k, axis=1)[:, len(x) - k] - 2 * error[loose]
            i, j = np.divmod(np.flatnonzero(~(near < below(least)[:, None])), len(x))          # NaN goes on
        d = by_differences(a[lo:lo + len(near)], x, i, j)
        order = np.lexsort((j, d, i))
        i, j, d = i[order], j[order], d[order]
        first = np.searchsorted(i, np.arange(len(near)))
        keep = (np.arange(len(i)) - first[i] < k) & ~(d > limit[i])
        found.append((i[keep] + lo, j[keep], d[keep]))
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def is_within(a: np.ndarray, x: np.ndarray, radius: float):
    """Slices of a: where they begin, and which rows of x are within ``radius`` (rows x rows)."""
    for lo, near, aa, error, unit in closeness(a, x):
        with np.errstate(invalid="ignore", over="ignore"):
            rr = (radius / unit) ** 2 if radius >= 0 else -np.inf
            error = 2 * error + 1e-12 * abs(rr)
            ok = ~(near < below(aa - rr - error)[:, None])             # surely all that are; NaN goes on
            sure = -below(rr - aa - error)
            if np.count_nonzero(ok) * 8 < ok.size:
                maybe = np.flatnonzero(ok)
                maybe = maybe[~(near.ravel()[maybe] >= sure[maybe // len(x)])]
            else:
                maybe = np.flatnonzero(ok & ~(near >= sure[:, None]))
        i, j = np.divmod(maybe, len(x))
        ok[i, j] = by_differences(a[lo:lo + len(near)], x, i, j) <= radius
        yield lo, ok


def nearest(queries: DataFrame, base: DataFrame, k: int, block: int | None = None) -> DataFrame:
    """qid, nid, distance: the k nearest base rows (and possibly more) of every query (qid, qf)."""
    index = PivotBlocks(base, block)
    queries = queries.select("qid", F.col("qf").cast("array<double>").alias("qf"))

    def home_lists(left, a, right, x, visits):
        nid, out = right["nid"].to_numpy(), []
        for q, s in visits:
            i, j, d = k_nearest(a[q], x[s], k, np.full(len(q), np.inf))
            cuts = np.searchsorted(i, np.arange(1, len(q)))
            out.append(pd.DataFrame({"qid": left["qid"].to_numpy()[q], "qf": left["qf"].to_numpy()[q],
                                     "nids": pd.Series(np.split(nid[s][j], cuts), dtype=object), "ds": pd.Series(np.split(d, cuts), dtype=object)}))
        return pd.concat(out)

    def nearer(left, a, right, x, visits):
        """What may still be among the k nearest; every block narrows what the next ones look for."""
        nid, worst, out = right["nid"].to_numpy(), left["worst"].to_numpy(float).copy(), []
        for q, s in visits:
            i, j, d = k_nearest(a[q], x[s], k, worst[q])
            full = np.flatnonzero(np.bincount(i, minlength=len(q)) >= k)
            worst[q[full]] = np.minimum(worst[q[full]], d[np.searchsorted(i, full) + k - 1])
            out.append((q[i], nid[s][j], d))
        i, j, d = (np.concatenate(c) for c in zip(*out, strict=True))
        order = np.lexsort((j, d, i))
        i, j, d = i[order], j[order], d[order]
        keep = np.arange(len(i)) - np.searchsorted(i, i) < k
        return pd.DataFrame({"qid": left["qid"].to_numpy()[i[keep]], "nid": j[keep], "distance": d[keep]})

    def home(index, x, batch):
        """The block of least bound that has k rows, if any does; of several the one with the nearest pivot."""
        bounds, pivot = index.bound(x)
        if (index.size >= k).any():
            bounds = np.where(index.size >= k, bounds, np.inf)
        out = np.zeros(bounds.shape, bool)
        out[np.arange(len(out)), np.where(bounds <= bounds.min(axis=1, keepdims=True), pivot, np.inf).argmin(axis=1)] = True
        return out

    first = index.meet(index.route(queries, home), home_lists, "qid long, qf array<double>, nids array<long>, ds array<double>")
    pairs = F.arrays_zip(F.col("nids").alias("nid"), F.col("ds").alias("distance"))
    if index.blocks == 1:
        return first.select("qid", F.inline(pairs))
    first = cut(first)

    def others(index, x, batch):
        worst = batch.column("worst").to_numpy(zero_copy_only=False)
        return ~(index.bound(x)[0] > worst[:, None]) & ~home(index, x, batch)

    worst = F.coalesce(F.get("ds", F.lit(k - 1)), F.lit(math.inf)).alias("worst")
    more = index.meet(index.route(first.select("qid", "qf", worst), others), nearer, "qid long, nid long, distance double")
    return first.select("qid", F.inline(pairs)).unionByName(more)


def within(queries: DataFrame, base: DataFrame, radius: float, block: int | None = None) -> DataFrame:
    """qid, nid, distance of every pair within ``radius``."""
    index = PivotBlocks(base, block)

    def pairs(left, a, right, x, visits):
        qid, nid, out = left["qid"].to_numpy(), right["nid"].to_numpy(), []
        for q, s in visits:
            asks = a[q]
            for lo, ok in is_within(asks, x[s], radius):
                i, j = np.divmod(np.flatnonzero(ok), ok.shape[1])
                out.append((qid[q[lo + i]], nid[s][j], by_differences(asks, x[s], lo + i, j)))
        return pd.DataFrame(dict(zip(("qid", "nid", "distance"), (np.concatenate(c) for c in zip(*out, strict=True)), strict=True)))

    return index.meet(_reach(index, queries, radius), pairs, "qid long, nid long, distance double")


def weight_within(index: PivotBlocks, queries: DataFrame, radius: float, weights: DataFrame | None = None) -> DataFrame:
    """qid, weight: the sum of ``weights`` (nid, weight > 0; by default 1 for each row) within
    ``radius`` of each query that has any.  Pairs are counted where they are found."""
    rows = index.rows.withColumn("weight", F.lit(1.0)) if weights is None else index.rows.join(weights, "nid")

    def sums(left, a, right, x, visits):
        weight, total = right["weight"].to_numpy(float), np.zeros(len(left))
        for q, s in visits:
            for lo, ok in is_within(a[q], x[s], radius):
                if np.count_nonzero(ok) * 8 < ok.size:
                    i, j = np.divmod(np.flatnonzero(ok), ok.shape[1])
                    total[q[lo:lo + len(ok)]] += np.bincount(i, weight[s][j], len(ok))
                else:
                    total[q[lo:lo + len(ok)]] += ok @ weight[s]
        return pd.DataFrame({"qid": left["qid"], "weight": total})

    found = index.meet(_reach(index, queries, radius), sums, "qid long, weight double", rows)
    return found.groupBy("qid").agg(F.sum("weight").alias("weight")).where("weight > 0")


def _reach(index: PivotBlocks, queries: DataFrame, radius: float) -> DataFrame:
    queries = queries.select("qid", F.col("qf").cast("array<double>").alias("qf"))
    return index.route(queries, lambda index, x, batch: index.bound(x)[0] <= radius)

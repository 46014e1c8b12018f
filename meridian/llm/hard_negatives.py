"""Hard negatives by bounds along a spanning tree of anchors.

A row's score at an anchor is their integer inner product.  An anchor's positives are
its best other rows of the same label; for each positive, its hard negatives are the
best rows of other labels whose score lies within the window
``lowest * positive <= 100 * score <= highest * positive`` (per cent).

*Bounds.*  Anchors come in groups of at most ``ANCHORS``, near ones together, and each
group has a spanning tree of short edges.  With s(p, x) in [lo, hi] at the parent p,
a child c has s(c, x) in [lo - |c - p| |x|, hi + |c - p| |x|].  The root is scored
exactly; down the tree only candidates whose interval reaches into the anchor's
window are scored again, which makes their interval exact, and all others pass their
interval on.  The window of an anchor is open below the worst of the best that it
holds already, so it closes as a task goes on.  Scores are exact: bounds only spare
work.

*Scale.*  Rows are dealt to blocks of ``ROWS`` rows by hash; every task meets one group
of anchors with one block of rows, and sends the best few of each anchor, which are
merged by anchor.  Neither anchors nor rows are ever in one place: groups and blocks
grow in number, not in size.  Two rounds: positives first, then, with each anchor's
windows known, the negatives.

A row without id, label or vector, or with a null, NaN or infinite component takes no
part; of vectors of different lengths (an empty one too) the missing components count
as 0.  Rows that share an id are rows of their own, and ties among them go by their
place in the input.  Scores must fit in 53 bits, else an error is raised.
An empty table gives no rows; other columns play no part.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from meridian.plans.iterate import cut

#: Anchors of a group, rows of a block, and rows that are held against a tree at a time.
ANCHORS, ROWS, SLICE = 512, 16_384, 2_048
#: Anchors that lead the groups, at most; beyond that, groups are split by hash.
LEADERS = 64
#: Integers that float64 products hold exactly.
EXACT = 1 << 53


def vectors(column: pa.Array) -> np.ndarray:
    """Rows of a list column as one matrix (missing components are 0)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    size = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(size), int(size.max(initial=0))), np.int64)
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


def same_width(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    width = max(a.shape[1], b.shape[1])
    return tuple(np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (a, b))


def length_bound(x: np.ndarray) -> np.ndarray:
    """Euclidean lengths of the rows, rounded up."""
    return np.ceil(np.sqrt((x.astype(float) ** 2).sum(axis=1)) * (1 + 1e-9) + 1e-9)


def inner(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact integer inner products of all rows of a with all rows of x."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(x).max(initial=0)) * a.shape[1]
    if most >= EXACT:
        raise OverflowError("scores may not fit in 53 bits")
    return (a.astype(float) @ x.T.astype(float)).astype(np.int64)


class Tree:
    """A spanning tree of a group of anchors (Prim's, from the anchor nearest the mean), by levels."""

    def __init__(self, x: np.ndarray):
        self.x = x
        f = x.astype(float)
        n = len(x)
        root = int(((f - f.mean(axis=0)) ** 2).sum(axis=1).argmin())
        parent = np.full(n, root)
        near = ((f - f[root]) ** 2).sum(axis=1)
        depth = np.zeros(n, np.int64)
        out = np.ones(n, bool)
        out[root] = False
        for _ in range(n - 1):
            i = int(np.where(out, near, np.inf).argmin())
            out[i] = False
            depth[i] = depth[parent[i]] + 1
            d = ((f - f[i]) ** 2).sum(axis=1)
            closer = out & (d < near)
            near[closer], parent[closer] = d[closer], i
        self.parent, self.edge = parent, length_bound(x - x[parent])
        self.levels = [np.flatnonzero(depth == k) for k in range(int(depth.max(initial=0)) + 1)]

    def scored(self, rows: np.ndarray, low: np.ndarray, high: np.ndarray, wanted) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(anchor, row, score) of every wanted pair whose score lies in its anchor's window
        [low, high].  ``wanted(anchors)``: which rows each of these anchors wants."""
        norm = length_bound(rows)
        n = len(self.x)
        lo, hi = np.empty((n, len(rows))), np.empty((n, len(rows)))
        found = []
        for k, level in enumerate(self.levels):
            if k:
                reach = self.edge[level][:, None] * norm[None, :]
                lo[level] = lo[self.parent[level]] - reach
                hi[level] = hi[self.parent[level]] + reach
                inside = (hi[level] >= low[level][:, None]) & (lo[level] <= high[level][:, None]) & wanted(level)
            else:
                inside = np.ones((len(level), len(rows)), bool)
            a, r = np.nonzero(inside)
            if len(a) * 4 > inside.size:
                full = inner(self.x[level], rows)
                s = full[a, r]
            else:
                s = np.concatenate([np.zeros(0, np.int64)] + [
                    _pairs(self.x[level[a[i:i + 65_536]]], rows[r[i:i + 65_536]]) for i in range(0, len(a), 65_536)])
            lo[level[a], r] = hi[level[a], r] = s
            own = (s >= low[level[a]]) & (s <= high[level[a]])
            if k == 0:
                own &= wanted(level)[a, r]
            found.append((level[a[own]], r[own], s[own]))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _pairs(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products row by row."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(x).max(initial=0)) * a.shape[1]
    if most >= EXACT:
        raise OverflowError("scores may not fit in 53 bits")
    return np.einsum("ij,ij->i", a.astype(float), x.astype(float)).astype(np.int64)


def best_of(group: np.ndarray, score: np.ndarray, ident: np.ndarray, row: np.ndarray, k: int) -> np.ndarray:
    """Places of the k first of each group: higher scores, then smaller ids, then smaller row numbers."""
    order = np.lexsort((row, ident, -score, group))
    g = group[order]
    head = np.flatnonzero(np.concatenate(([True], g[1:] != g[:-1]))) if len(g) else np.zeros(0, np.int64)
    rank = np.arange(len(g)) - np.repeat(head, np.diff(np.concatenate((head, [len(g)]))))
    return order[rank < k]


class Best:
    """The k best of each of n groups, so far."""

    def __init__(self, n: int, k: int):
        self.n, self.k = n, k
        self.group, self.score, self.ident, self.row = (np.zeros(0, np.int64) for _ in range(4))

    def add(self, group, score, ident, row) -> None:
        g, s, i, r = (np.concatenate(x) for x in zip((self.group, self.score, self.ident, self.row),
                                                     (group, score, ident, row), strict=True))
        keep = best_of(g, s, i, r, self.k)
        self.group, self.score, self.ident, self.row = g[keep], s[keep], i[keep], r[keep]

    def floor(self) -> np.ndarray:
        """The score that a newcomer of each group must reach."""
        out = np.full(self.n, -np.inf)
        count = np.bincount(self.group, minlength=self.n)
        worst = np.full(self.n, np.inf)
        np.minimum.at(worst, self.group, self.score)
        out[count >= self.k] = worst[count >= self.k]
        return out


class _Side:
    """One side of a task as arrays."""

    def __init__(self, t: pa.Table):
        t = t.combine_chunks()
        self.x = vectors(t.column("q"))
        self.ident, self.row = t.column("ident").to_numpy(), t.column("row").to_numpy()
        self.label = t.column("label").to_numpy()

    def slices(self):
        for lo in range(0, len(self.ident), SLICE):
            yield slice(lo, lo + SLICE)


OUT = pa.schema([("anchor", pa.int64()), ("anchor_id", pa.int64()), ("place", pa.int32()), ("score", pa.int64()),
                 ("ident", pa.int64()), ("row", pa.int64())])
OUT_DDL = "anchor long, anchor_id long, place int, score long, ident long, row long"


def _found(side: _Side, best: Best, places: int) -> pa.Table:
    a, place = best.group // places, best.group % places
    return pa.Table.from_arrays([pa.array(x, f.type) for x, f in zip(
        (side.row[a], side.ident[a], place, best.score, best.ident, best.row), OUT, strict=True)], schema=OUT)


def _positives(k: int):
    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        if anchors.num_rows == 0 or rows.num_rows == 0:
            return OUT.empty_table()
        a, r = _Side(anchors), _Side(rows)
        a.x, r.x = same_width(a.x, r.x)
        tree, best = Tree(a.x), Best(len(a.ident), k)
        top = np.full(len(a.ident), np.inf)
        for part in r.slices():
            label, row = r.label[part], r.row[part]
            pairs = tree.scored(r.x[part], best.floor(), top, lambda level: (
                (a.label[level][:, None] == label) & (a.row[level][:, None] != row)))  # noqa: B023
            best.add(pairs[0], pairs[2], r.ident[part][pairs[1]], row[pairs[1]])
        return _found(a, best, 1)
    return run


def window(positive: np.ndarray, lowest: int, highest: int) -> tuple[np.ndarray, np.ndarray]:
    """The least and the largest whole score within lowest and highest per cent of a positive's."""
    return -((-lowest * positive) // 100), highest * positive // 100


def _negatives(k: int, lowest: int, highest: int):
    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        if anchors.num_rows == 0 or rows.num_rows == 0:
            return OUT.empty_table()
        a, r = _Side(anchors), _Side(rows)
        a.x, r.x = same_width(a.x, r.x)
        scores = anchors.column("positives").to_pylist()
        places = max(map(len, scores))
        n = len(a.ident)
        low, high = np.full((n, places), np.inf), np.full((n, places), -np.inf)
        for i, s in enumerate(scores):
            low[i, :len(s)], high[i, :len(s)] = window(np.array(s, np.int64), lowest, highest)
        tree, best = Tree(a.x), Best(n * places, k)
        for part in r.slices():
            label = r.label[part]
            least = np.maximum(low, best.floor().reshape(n, places))
            hit, row, s = tree.scored(r.x[part], least.min(axis=1), high.max(axis=1), lambda level: a.label[level][:, None] != label)  # noqa: B023
            for j in range(places):
                own = (s >= least[hit, j]) & (s <= high[hit, j])
                best.add(hit[own] * places + j, s[own], r.ident[part][row[own]], r.row[part][row[own]])
        return _found(a, best, places)
    return run


def _nearest_leader(leaders: np.ndarray):
    def body(batches):
        for b in batches:
            x = vectors(b.column("q"))
            own, lead = (z.astype(float) for z in same_width(x, leaders))
            group = ((lead ** 2).sum(axis=1) - 2 * own @ lead.T).argmin(axis=1)
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(group.astype(np.int32))], names=["row", "leader"])
    return body


def _merge(found: DataFrame, k: int) -> DataFrame:
    order = W.partitionBy("anchor", "place").orderBy(F.desc("score"), "ident", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(rows: DataFrame, anchor: Column, positives: int = 5, negatives: int = 10, lowest: int = 30,
                   highest: int = 90) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows``: ident long, label, q array<long> (see ``quantised``); ``anchor``: a condition on ident."""
    # Written once, with a number for each row, so that rows that share an id stay apart.
    rows = cut(rows.where(F.col("ident").isNotNull() & F.col("label").isNotNull() & F.col("q").isNotNull())
               .select("ident", F.col("label").cast("long").alias("label"), "q", F.monotonically_increasing_id().alias("row")))
    total = rows.count()
    blocks = max(1, math.ceil(total / ROWS))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int"))

    # Groups of near anchors: led by a bounded draw of anchors, split where they are large.
    chosen = rows.where(anchor)
    count = chosen.count()
    lead = min(LEADERS, max(1, count // ANCHORS))
    leaders = [r.q for r in chosen.orderBy("row").limit(lead).select("q").collect()]      # at most LEADERS
    if not leaders:
        return rows.limit(0).select(*[F.lit(None).cast(t).alias(c) for c, t in (
            ("anchor_id", "long"), ("positive_id", "long"), ("rank", "int"), ("negative_id", "long"),
            ("positive_score", "long"), ("negative_score", "long"))])
    led = cut(chosen.select("row", "q").mapInArrow(_nearest_leader(vectors(pa.array(leaders, pa.list_(pa.int64())))),
                                                   "row long, leader int"))
    sizes = led.groupBy("leader").count().collect()                                       # at most LEADERS rows
    first, groups = {}, 0
    for s in sorted(sizes):
        parts = math.ceil(s["count"] / ANCHORS)
        first[s["leader"]] = (groups, parts)
        groups += parts
    table = F.create_map(*[F.lit(x) for k, v in first.items() for x in (k, F.struct(*[F.lit(z) for z in v]))])
    place = F.element_at(table, F.col("leader"))
    group = place["col1"] + F.pmod(F.xxhash64("row", F.lit(1)), place["col2"]).cast("int")
    anchors = cut(led.select("row", group.alias("group")).join(chosen.drop("block"), "row"))

    task = ["group", "block"]
    held = rows.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))

    def against(side: DataFrame) -> DataFrame:
        return side.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).groupBy(*task).cogroup(held.groupBy(*task))

    found = against(anchors).applyInArrow(_positives(positives), OUT_DDL)
    near = cut(_merge(found, positives).select("anchor", (F.col("rank") - 1).alias("place"), F.col("ident").alias("positive_id"),
                                               F.col("score").alias("positive_score")))
    lists = near.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("place", "positive_score"))).alias("p")).select(
        F.col("anchor").alias("row"), F.transform("p", lambda x: x["positive_score"]).alias("positives"))
    found = against(anchors.join(lists, "row")).applyInArrow(_negatives(negatives, lowest, highest), OUT_DDL)
    best = _merge(found, negatives).withColumnRenamed("score", "negative_score").withColumnRenamed("ident", "negative_id")
    return best.join(near, ["anchor", "place"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def quantised(df: DataFrame, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding", scale: int = 256) -> DataFrame:
    """ident, label, q: whole components floor(scale * x); rows that take no part are left out."""
    x = F.col(f"`{vector_col}`")
    odd = F.exists(x, lambda v: v.isNull() | F.isnan(v.cast("double")) | (F.abs(v.cast("double")) == float("inf")))
    return (df.select(F.col(f"`{id_col}`").cast("long").alias("ident"), F.col(f"`{label_col}`").alias("label"), x.alias("x"), odd.alias("odd"))
            .where(F.col("ident").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull() & ~F.col("odd"))
            .select("ident", "label", F.transform("x", lambda v: F.floor(v.cast("double") * scale)).alias("q")))

"""Stored tiles of a symmetric kernel matrix, and programs of many products with it.

``KernelTiles`` computes each tile of W (points x points) once, for one half of the
matrix, and, if several tasks need them, writes it to the shared folder in strips of ``STRIP`` rows; a product W D (D: one
or many columns) then reads numbers instead of computing kernels again.  A matrix that all
tasks together cannot hold is not written (it grows with the square of the points): what is
stored then is the vectors of each pair of blocks, and a product computes its tiles again.

A *program* is a generator that yields D and is sent W D, any number of times, and
returns rows.  ``run`` executes it in one of three ways with the same result:

* in one task, if it can hold the half matrix (``HELD_BYTES``, some 11,000 points): the task is sent
  the vectors and computes the tiles itself, nothing is written; it computes and multiplies with
  as many threads as its executor has cores, since no other task of the stage needs them;
* as one barrier stage: each task holds its share of the tiles in memory and runs
  the program, and a round's partial products are exchanged by ``allGather``, which
  takes about a second, so tiles are not read again every round;
* as one job per product, for matrices that do not fit the memory of all tasks or
  sessions that cannot hold a barrier (dynamic allocation).  Tiles are streamed from
  the table or computed in slices, the program runs on the driver.

A lost executor makes Spark run the stage again from the stored tiles or vectors.

An iteration whose steps come to lie in few directions need not multiply again in those it knows:
``Span`` keeps directions with their products.

Vectors are n numbers a column where the matrix has n^2 / 2: a program's state
(``MOST_POINTS`` points at most, checked) is small beside any one task's tiles.
"""

from __future__ import annotations

import base64
import math
from collections.abc import Callable, Generator
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import BarrierTaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meridian.functions.draws import hash_int
from meridian.plans.iterate import cut

TILE = 1024
#: Rows of a stored strip of a tile: a Parquet writer buffers a hundred rows before it looks at their size.
STRIP = 128
#: Points of a block, and rows and columns computed at a time, where tiles are not stored.
PAIR_BLOCK, SLICE = 8192, 512
#: Bytes of tiles that one task of a barrier stage may hold.
HELD_BYTES = 512 << 20
#: Points whose vectors a program may hold.
MOST_POINTS = 1 << 20
#: Numbers of the products that a ``Span`` may hold.
SPAN_NUMBERS = 1 << 25


def squared_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All squared Euclidean distances between rows, by one product; where that cancels
    (near points), by differences."""
    aa, bb = (a * a).sum(axis=1), (b * b).sum(axis=1)
    size = aa[:, None] + bb[None, :]
    d = size - 2 * (a @ b.T)
    i, j = np.nonzero(d < 1e-4 * size)
    for lo in range(0, len(i), 65_536):
        s = slice(lo, lo + 65_536)
        d[i[s], j[s]] = ((a[i[s]] - b[j[s]]) ** 2).sum(axis=1)
    return d


def kernel(a: np.ndarray, b: np.ndarray, sigma: float, squared: bool) -> np.ndarray:
    """exp(-0.5 d / sigma^2), d the Euclidean distance (or its square)."""
    d = squared_distances(a, b)
    return np.exp((-0.5 / (sigma * sigma)) * (d if squared else np.sqrt(d)))


class KernelTiles:
    """``points``: id, features; ``group``: a column of small integers from 0 on (``groups`` of
    them) whose members stand together, by default one group.

    ``ids``: all ids in the order of rows and columns; ``first``: where each block begins;
    ``group_first``: where each group begins; ``stored``: whether tiles are written, by default if the
    tasks of one stage can hold them."""

    def __init__(self, points: DataFrame, sigma: float = 1.0, squared: bool = False, group: Column | None = None,
                 groups: int = 1, tile: int = TILE, stored: bool | None = None):
        self.spark = points.sparkSession
        self.sigma, self.squared = sigma, squared
        n = points.count()
        if n > MOST_POINTS:
            raise ValueError(f"{n} points: a dense kernel has at most {MOST_POINTS}")
        slots = self.spark.sparkContext.defaultParallelism
        self.stored = 4 * n * n <= max(1, slots) * HELD_BYTES if stored is None else stored
        if not self.stored and tile == TILE:
            tile = PAIR_BLOCK
        parts = max(1, math.ceil(n / groups / tile))
        own = F.lit(0) if group is None else group
        block = (own * parts + F.pmod(hash_int("id", 43), F.lit(parts))).cast("int")
        p = cut(points.select("id", "features", block.alias("block")))
        blocks = parts * groups
        members = {r.block: sorted(r.ids) for r in p.groupBy("block").agg(F.collect_list("id").alias("ids")).collect()}
        sizes = [len(members.get(b, ())) for b in range(blocks)]
        self.ids = np.array([i for b in range(blocks) for i in members.get(b, ())], np.int64)
        self.first = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
        self.group_first = self.first[::parts]
        self.group = np.repeat(np.arange(groups), np.diff(self.group_first))

        self.points, self.blocks = p, blocks

    @cached_property
    def tiles(self) -> DataFrame:
        """The half matrix in strips, or the vectors of each pair of blocks if it is not stored."""
        p, blocks, sigma, squared = self.points, self.blocks, self.sigma, self.squared

        def half(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            if left.empty or right.empty:
                return pd.DataFrame({"r": [], "c": [], "at": [], "w": []})
            a, b = (vectors(x) for x in (left, right))
            w = tile_of(a, b, sigma, squared, left["r"].iloc[0] == left["c"].iloc[0])
            at = list(range(0, len(w), STRIP))
            return pd.DataFrame({"r": left["r"].iloc[0], "c": left["c"].iloc[0], "at": at, "w": [w[i:i + STRIP].tobytes() for i in at]})

        def pair(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            if left.empty or right.empty:
                return pd.DataFrame({"r": [], "c": [], "a": [], "b": []})
            a, b = (vectors(x).tobytes() for x in (left, right))
            return pd.DataFrame({"r": left["r"].iloc[:1].to_numpy(), "c": left["c"].iloc[:1].to_numpy(), "a": [a], "b": [b]})

        rows = p.select("id", "features", F.col("block").alias("r"), F.explode(F.sequence(F.col("block"), F.lit(blocks - 1))).alias("c"))
        cols = p.select("id", "features", F.col("block").alias("c"), F.explode(F.sequence(F.lit(0), F.col("block"))).alias("r"))
        both = rows.groupBy("r", "c").cogroup(cols.groupBy("r", "c"))
        if self.stored:
            return cut(both.applyInPandas(half, "r int, c int, at int, w binary"))
        return cut(both.applyInPandas(pair, "r int, c int, a binary, b binary").repartition(4 * self.spark.sparkContext.defaultParallelism))

    def bytes(self) -> int:
        return 4 * len(self.ids) ** 2

    def product(self, d: np.ndarray) -> np.ndarray:
        """W d by one job."""
        first, shared = self.first, self.spark.sparkContext.broadcast(np.ascontiguousarray(d, float))

        stored, sigma, squared = self.stored, self.sigma, self.squared

        def body(batches):
            columns, out = shared.value.shape[1], {}
            for b in batches:
                for i in range(b.num_rows):
                    r, c = b.column(0)[i].as_py(), b.column(1)[i].as_py()
                    for k in {r, c}:
                        out.setdefault(k, np.zeros((first[k + 1] - first[k], columns)))
                    of = {k: shared.value[first[k]:first[k + 1]] for k in {r, c}}
                    if stored:
                        parts = [(b.column(2)[i].as_py(), 0, np.frombuffer(b.column(3)[i].as_buffer(), float).reshape(-1, len(out[c])))]
                    else:
                        x, y = (np.frombuffer(b.column(j)[i].as_buffer(), float).reshape(len(out[k]), -1) for j, k in ((2, r), (3, c)))
                        parts = slices(x, y, sigma, squared, r == c)
                    for at, to, w in parts:
                        rows, cols = slice(at, at + w.shape[0]), slice(to, to + w.shape[1])
                        out[r][rows] += w @ of[c][cols]
                        if r != c or (not stored and at != to):
                            out[c][cols] += w.T @ of[r][rows]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(list(out), pa.int32()), pa.array([x.tobytes() for x in out.values()], pa.binary())],
                                                 names=["block", "sums"])

        def add(pdf: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame({"block": pdf["block"].iloc[:1], "sums": [sum(np.frombuffer(x, float) for x in pdf["sums"]).tobytes()]})

        found = self.tiles.mapInArrow(body, "block int, sums binary").groupBy("block").applyInPandas(add, "block int, sums binary").collect()
        out = np.zeros(d.shape)
        for r in found:
            out[first[r.block]:first[r.block + 1]] = np.frombuffer(r.sums, float).reshape(-1, d.shape[1])
        shared.destroy()
        return out

    def run(self, program: Callable[[], Generator], schema: str, tasks: int | None = None) -> DataFrame:
        """The rows (tuples) that ``program`` returns.  ``tasks``: how many hold the tiles, 0 for
        one job per product; by default as above."""
        if not self.stored:
            tasks = 0
        elif tasks is None:
            slots = self.spark.sparkContext.defaultParallelism
            dynamic = self.spark.conf.get("spark.dynamicAllocation.enabled", "false") == "true"
            tasks = 1 if self.bytes() <= HELD_BYTES else slots if not dynamic and self.bytes() <= slots * HELD_BYTES else 0
        if tasks == 0:
            running = program()
            try:
                d = next(running)
                while True:
                    d = running.send(self.product(d))
            except StopIteration as end:
                return self.spark.createDataFrame(end.value, schema)
        kinds = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "boolean": pa.bool_()}
        target = pa.schema([(x.split()[0], kinds[x.split()[1]]) for x in schema.split(", ")])
        first, threads, sigma, squared = self.first, 1 if tasks > 1 else executor_cores(self.spark), self.sigma, self.squared

        def read(batches) -> list:
            tiles = {}                                           # whole again: few and long products
            for b in batches:
                for r, c, at, w in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3), strict=True):
                    if (r, c) not in tiles:
                        tiles[r, c] = np.empty((first[r + 1] - first[r], first[c + 1] - first[c]))
                    part = np.frombuffer(w.as_buffer(), float).reshape(-1, first[c + 1] - first[c])
                    tiles[r, c][at:at + len(part)] = part
            return [(r, c, tiles[r, c]) for r, c in sorted(tiles)]

        def compute(batches, pool) -> list:
            got = [b.to_pandas() for b in batches if b.num_rows]
            of = {k: vectors(x) for k, x in pd.concat(got).groupby("block")} if got else {}
            pairs = [(r, c) for r in sorted(of) for c in sorted(of) if r <= c]
            return [(*k, w) for k, w in zip(pairs, (pool.map if pool else map)(lambda k: tile_of(of[k[0]], of[k[1]], sigma, squared, k[0] == k[1]), pairs), strict=True)]

        def body(batches):
            pool = ThreadPoolExecutor(threads) if threads > 1 else None
            held = read(batches) if tasks > 1 else compute(batches, pool)
            gate, running = BarrierTaskContext.get() if tasks > 1 else None, program()
            dealt = [held[i::threads] for i in range(threads)]
            try:
                d = next(running)
                while True:
                    used = [np.flatnonzero((d[first[k]:first[k + 1]] != 0).any(axis=0)) for k in range(len(first) - 1)]
                    d = np.ascontiguousarray(d, float)
                    sums = pool.map(lambda part: tiles_product(part, d, first, used), dealt) if pool else [tiles_product(held, d, first, used)]  # noqa: B023
                    out = sum(sums)
                    if gate:
                        parts = gate.allGather(base64.b64encode(out.tobytes()).decode())
                        out = sum(np.frombuffer(base64.b64decode(x), float) for x in parts).reshape(d.shape)
                    d = running.send(out)
            except StopIteration as end:
                rows = end.value if gate is None or gate.partitionId() == 0 else []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), target, strict=True)],
                                                     schema=target)

        dealt = self.tiles.repartition(tasks, F.xxhash64("r", "c")) if tasks > 1 else self.points.select("id", "features", "block").repartition(1)
        return cut(dealt.mapInArrow(body, schema, barrier=tasks > 1))


def vectors(rows: pd.DataFrame) -> np.ndarray:
    """The features of a block's rows, in the order of their ids."""
    return np.stack(rows.sort_values("id")["features"].to_numpy()).astype(float)


def tile_of(a: np.ndarray, b: np.ndarray, sigma: float, squared: bool, same: bool) -> np.ndarray:
    """The kernel of two blocks; a block's with itself is symmetric to the last bit."""
    w = kernel(a, b, sigma, squared)
    if same:
        np.fill_diagonal(w, 1.0)
        w = np.triu(w) + np.triu(w, 1).T
    return w


def executor_cores(spark) -> int:
    """Cores of one executor, as the session states them."""
    sc = spark.sparkContext
    if sc.master.startswith("local["):
        return max(1, sc.defaultParallelism)
    if sc.master.startswith("local-cluster["):                   # [executors, cores, MB]; spark.executor.cores is not set there
        return max(1, int(sc.master.split(",")[1]))
    return max(1, int(sc.getConf().get("spark.executor.cores", "1")))


def slices(x: np.ndarray, y: np.ndarray, sigma: float, squared: bool, same: bool):
    """(row, column, kernel) of a pair of blocks, ``SLICE`` points a side; of a block with itself
    one half, the diagonal slices symmetric to the last bit."""
    for at in range(0, len(x), SLICE):
        for to in range(at if same else 0, len(y), SLICE):
            yield at, to, tile_of(x[at:at + SLICE], y[to:to + SLICE], sigma, squared, same and at == to)


def tiles_product(tiles: list, d: np.ndarray, first: np.ndarray, used: list[np.ndarray]) -> np.ndarray:
    """What tiles (r, c, numbers) add to the product; columns of d that are zero in a block (``used``:
    those that are not) are left out."""
    out = np.zeros(d.shape)
    for r, c, tile in tiles:
        rows, cols = slice(first[r], first[r + 1]), slice(first[c], first[c + 1])
        for to, by, block, m in ((rows, cols, c, tile),) if r == c else ((rows, cols, c, tile), (cols, rows, r, tile.T)):
            use = used[block]
            if len(use) == d.shape[1]:
                out[to] += m @ d[by]
            elif len(use):
                out[to, use] += m @ d[by][:, use]
    return out


class Span:
    """Products W d of the steps d of an iteration, from directions whose products are known.

    Each column has, for each group of coordinates (``own``: their slices), an orthonormal basis with the products of
    its members.  What of a step lies in the span is combined from them.  The rest waits, with the rests of the
    steps before, as long as its product is below what the caller allows; beyond, it is multiplied and becomes
    a new direction (with it, in the same product, other rests above ``EARLY`` of that).  How much W lengthens a rest is
    taken from the last new direction (``GAIN`` times as much, at first W's norm): rests become noise, which W
    hardly lengthens.  A caller that allows 0 gets the exact sum of all products."""

    GAIN, EARLY = 4.0, 0.01

    def __init__(self, n: int, columns: int, own: list[slice], norm: float):
        """``norm``: a bound of the norm of W."""
        self.own, self.n, self.norm = own, n, norm
        self.waiting = np.zeros((columns, n))
        self.most = max(8, SPAN_NUMBERS // max(1, n * len(own) * columns))
        self.known = [[(np.empty((0, o.stop - o.start)), np.empty((0, n))) for o in own] for _ in range(columns)]
        self.count, self.size = np.zeros((columns, len(own)), int), np.zeros((columns, len(own)))
        self.gain = np.full((columns, len(own)), norm)

    def product(self, d: np.ndarray, allowed: np.ndarray) -> Generator:
        """W d (``d``: a row for each column), up to ``allowed`` (a number a column) in the norm of all products so far."""
        out = np.zeros(d.shape)
        for k, b in zip(*np.nonzero(np.stack([d[:, o].any(axis=1) for o in self.own], axis=1)), strict=True):
            rest, held = self.waiting[k, self.own[b]] + d[k, self.own[b]], min(self.count[k, b], self.most)
            if held:
                q, z = (x[:held] for x in self.known[k][b])
                part = q @ rest
                rest = rest - part @ q
                more = q @ rest                                  # twice is enough
                rest = rest - more @ q
                out[k] += (part + more) @ z
            self.waiting[k, self.own[b]] = rest
            self.size[k, b] = np.linalg.norm(rest) * self.gain[k, b] * math.sqrt(len(self.own))
        if (self.size > allowed[:, None]).any():
            new = list(zip(*np.nonzero(self.size > self.EARLY * allowed[:, None]), strict=True))
            x = np.zeros((self.n, len(new)))
            for i, (k, b) in enumerate(new):
                x[self.own[b], i] = self.waiting[k, self.own[b]]
                self.waiting[k, self.own[b]] = self.size[k, b] = 0.0
            length = np.linalg.norm(x, axis=0)
            w = yield x / length
            for i, (k, b) in enumerate(new):
                out[k] += length[i] * w[:, i]
                self._keep(k, b, x[self.own[b], i] / length[i], w[:, i])
        return out

    def _keep(self, k: int, b: int, v: np.ndarray, w: np.ndarray) -> None:
        """A new direction, in the place of the oldest one if there are ``most``."""
        at = self.count[k, b] % self.most
        if at == len(self.known[k][b][0]):
            size = min(self.most, max(8, 2 * at))
            self.known[k][b] = tuple(np.concatenate((x, np.empty((size - at, x.shape[1])))) for x in self.known[k][b])
        for x, y in zip(self.known[k][b], (v, w), strict=True):
            x[at] = y
        self.count[k, b] += 1
        self.gain[k, b] = min(self.norm, self.GAIN * float(np.linalg.norm(w)))


def largest_eigenvalue(diagonal: np.ndarray, tol: float = 1e-9, most: int = 300) -> Generator:
    """Program: the largest eigenvalue of diag(diagonal) - W by Lanczos steps with full
    orthogonalisation, until its residual is at most ``tol`` of it; an error beyond ``most`` steps."""
    n = len(diagonal)
    if n == 0:
        return 0.0
    q = np.random.default_rng(61).random(n) + 0.5
    basis, alpha, beta = [q / np.linalg.norm(q)], [], []
    for _ in range(min(most, n)):
        w = diagonal * basis[-1] - (yield basis[-1][:, None])[:, 0]
        alpha.append(float(w @ basis[-1]))
        for _ in range(2):
            m = np.stack(basis)
            w = w - m.T @ (m @ w)
        beta.append(float(np.linalg.norm(w)))
        values, vectors = np.linalg.eigh(np.diag(alpha) + np.diag(beta[:-1], 1) + np.diag(beta[:-1], -1))
        if beta[-1] * abs(vectors[-1, -1]) <= tol * abs(values[-1]) or len(alpha) == n:
            return float(values[-1])
        basis.append(w / beta[-1])
    raise RuntimeError(f"no convergence to {tol} within {most} steps")

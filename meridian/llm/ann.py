"""Nearest neighbours by learned partitions.

1. A bounded sample of the vectors (``SAMPLE`` rows, by hash of the id) gives a
   k-nearest-neighbour graph, which recursive spectral bisection cuts into
   ``parts`` parts of equal size with few edges between them.
2. A small classifier (one hidden layer) learns from the sample in which parts a
   vector's neighbours lie.  Every row is indexed in its most probable part.
3. A query goes to its most probable parts; how many is the least number with
   which sampled queries find ``recall`` of their true neighbours in the sample.
4. Each part is searched in blocks of rows and blocks of queries, with exact inner
   products in double precision on the original vectors, and the best are merged.

Only the index is learned from a sample: all rows are indexed.  One very common
vector fills one part, which is cut into blocks by a hash of the row.  Vectors
that are null, zero, or hold null or non-finite components take no part, nor do
those of another length than most.  Ties go to the smaller id.  A null id is
neither query nor candidate; a repeated row is a candidate as often as it occurs
(not for a query of its own id).  Few rows are searched whole; none give none.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from meridian.plans.iterate import cut

SAMPLE = 4096
GRAPH_DEGREE = 16
PARTS = 16
HIDDEN = 96
ROWS_PER_BLOCK = 8192
QUERIES_PER_BLOCK = 4096


def neighbour_graph(x: np.ndarray, degree: int) -> tuple[np.ndarray, np.ndarray]:
    """Symmetric 0/1 adjacency of the k nearest by inner product, and the neighbour lists."""
    n, k = len(x), min(degree, len(x) - 1)
    near = np.empty((n, k), np.int64)
    for lo in range(0, n, 512):
        s = x[lo:lo + 512] @ x.T
        s[np.arange(len(s)), np.arange(lo, lo + len(s))] = -np.inf
        near[lo:lo + 512] = np.argpartition(-s, k - 1, axis=1)[:, :k]
    a = np.zeros((n, n), np.float32)
    a[np.arange(n)[:, None], near] = 1
    a[near, np.arange(n)[:, None]] = 1
    return a, near


def bisect(a: np.ndarray, rng: np.random.Generator, rounds: int = 60) -> np.ndarray:
    """Halves of equal size along the second eigenvector of the normalised adjacency,
    then swaps across the cut while they remove edges."""
    n = len(a)
    d = np.sqrt(a.sum(axis=1) + 1)
    top = d / np.linalg.norm(d)
    v = rng.standard_normal(n)
    for _ in range(rounds):
        v = v - top * (top @ v)
        v = (a @ (v / d) + v / d) / d + v
        v /= np.linalg.norm(v)
    side = np.zeros(n, bool)
    side[np.argsort(v / d, kind="stable")[n // 2:]] = True
    for _ in range(20):
        gain = np.where(side, -1, 1) * (a @ side - a @ ~side)
        i = np.where(~side)[0][np.argsort(-gain[~side], kind="stable")]
        j = np.where(side)[0][np.argsort(-gain[side], kind="stable")]
        m = min(len(i), len(j), max(1, n // 50))
        good = gain[i[:m]] + gain[j[:m]] > 2
        if not good.any():
            break
        before = a[side][:, ~side].sum()
        old = side.copy()
        side[i[:m][good]], side[j[:m][good]] = True, False
        if a[side][:, ~side].sum() >= before:
            side = old
            break
    return side


def balanced_parts(a: np.ndarray, parts: int, seed: int = 5) -> np.ndarray:
    """Part of each node: recursive halves (``parts`` is a power of two)."""
    rng = np.random.default_rng(seed)
    out = np.zeros(len(a), np.int64)
    groups = [np.arange(len(a))]
    while len(groups) < parts:
        groups = [g[s] for g in groups for side in [bisect(a[np.ix_(g, g)], rng)] for s in (~side, side)]
    for p, g in enumerate(groups):
        out[g] = p
    return out


@dataclass
class Router:
    """One hidden layer and a softmax over the parts."""
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray
    scale: float
    probes: int

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.maximum(x * self.scale @ self.w1 + self.b1, 0) @ self.w2 + self.b2


def train_router(x: np.ndarray, target: np.ndarray, epochs: int = 40, seed: int = 7) -> Router:
    """Cross-entropy against the share of a row's neighbours in each part (Adam, batches of 128)."""
    rng = np.random.default_rng(seed)
    n, dim = x.shape
    scale = 1.0 / max(1e-12, float(np.sqrt((x ** 2).mean())))
    w = [rng.standard_normal((dim, HIDDEN)) * np.sqrt(2 / dim), np.zeros(HIDDEN),
         rng.standard_normal((HIDDEN, target.shape[1])) * np.sqrt(1 / HIDDEN), np.zeros(target.shape[1])]
    first, second = [np.zeros_like(v) for v in w], [np.zeros_like(v) for v in w]
    step = 0
    for epoch in range(epochs):
        rate = 0.003 * (1 - epoch / epochs) + 1e-5
        order = rng.permutation(n)
        for lo in range(0, n, 128):
            b = order[lo:lo + 128]
            xb = x[b] * scale
            h = np.maximum(xb @ w[0] + w[1], 0)
            z = h @ w[2] + w[3]
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            dz = (p - target[b]) / len(b)
            dh = dz @ w[2].T * (h > 0)
            step += 1
            for i, g in enumerate((xb.T @ dh + 1e-4 * w[0], dh.sum(axis=0), h.T @ dz + 1e-4 * w[2], dz.sum(axis=0))):
                first[i] += 0.1 * (g - first[i])
                second[i] += 0.001 * (g * g - second[i])
                w[i] -= rate * (first[i] / (1 - 0.9 ** step)) / (np.sqrt(second[i] / (1 - 0.999 ** step)) + 1e-8)
    return Router(*w, scale, 1)


def learn(x: np.ndarray, parts: int, recall: float, k: int) -> Router:
    """Partition, classifier and number of probes from the sample (rows of ``x``)."""
    parts = max(1, min(parts, 1 << max(0, (len(x) // 64).bit_length() - 1)))
    parts = 1 << (parts.bit_length() - 1)
    if parts == 1:
        return Router(np.zeros((x.shape[1], 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1), 1.0, 1)
    a, near = neighbour_graph(x, GRAPH_DEGREE)
    of = balanced_parts(a, parts)
    one = np.eye(parts)[of]
    target = (one[near].sum(axis=1) + 4 * one) / (near.shape[1] + 4)
    router = train_router(x, target)
    # Probes: every fourth row asks the others for its nearest, in the parts where they are indexed.
    z = router.logits(x)
    home = z.argmax(axis=1)
    asked = np.arange(0, len(x), 4)
    s = x[asked] @ x.T
    s[np.arange(len(asked)), asked] = -np.inf
    true = np.argpartition(-s, min(k, len(x) - 1) - 1, axis=1)[:, :k]
    rank = np.argsort(np.argsort(-z[asked], axis=1), axis=1)
    found = rank[np.arange(len(asked))[:, None], home[true]]
    router.probes = next((m for m in range(1, parts) if (found < m).mean() >= recall), parts)
    return router


def _best(k: int):
    def run(key, rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(rows) and len(queries):
            rows = rows.sort_values("vec_id", kind="stable")
            ids, x = rows["vec_id"].to_numpy(), np.stack(rows["v"].to_numpy()).astype(float)
            q_ids, q = queries["vec_id"].to_numpy(), np.stack(queries["v"].to_numpy()).astype(float)
            for lo in range(0, len(q), 256):
                s = q[lo:lo + 256] @ x.T
                s[q_ids[lo:lo + 256, None] == ids] = -np.inf
                m = min(k, s.shape[1])
                least = np.partition(s, s.shape[1] - m, axis=1)[:, s.shape[1] - m]
                for i in range(len(s)):
                    c = np.flatnonzero((s[i] >= least[i] - 1e-9 * max(1.0, abs(least[i]))) & (s[i] > -np.inf))
                    exact = (x[c] * q[lo + i]).sum(axis=1)      # one order of summation, so that equal rows tie
                    c, exact = (z[np.lexsort((ids[c], -exact))[:k]] for z in (c, exact))
                    out.append(pd.DataFrame({"query_id": q_ids[lo + i], "vec_id": ids[c], "score": exact}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
    return run


def nearest(df: DataFrame, queries, k: int = 20, parts: int = PARTS, recall: float = 0.97,
            id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score.  ``queries``: a condition on ``vec_id``."""
    v = F.col("v")
    rows = cut(df.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vec_col}`").cast("array<double>").alias("v"))
               .where(F.col("vec_id").isNotNull() & v.isNotNull() & (F.size(v) > 0)
                      & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
                      & F.exists(v, lambda c: c != 0)))
    width = rows.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").first()
    empty = "query_id long, rank int, vec_id long, score double"
    if width is None:
        return df.sparkSession.createDataFrame([], empty)
    rows = rows.where(F.size("v") == width.d)
    # A bounded sample: SAMPLE vectors.
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("v").collect()
    router = learn(np.array([r.v for r in sample]), parts, recall, k)
    shared = df.sparkSession.sparkContext.broadcast(router)

    def route(batches):
        r = shared.value
        for b in batches:
            if b.num_rows == 0:
                continue
            x = b.column(1).flatten().to_numpy().reshape(b.num_rows, -1)
            order = np.argsort(-r.logits(x), axis=1, kind="stable")[:, :r.probes].astype(np.int32)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(list(order), pa.list_(pa.int32()))],
                                             names=["vec_id", "v", "probes"])

    placed = cut(rows.select("vec_id", "v").mapInArrow(route, "vec_id long, v array<double>, probes array<int>"))
    asked = placed.where(queries)
    # Blocks by the counts of each part (one row a part).
    sizes = (placed.groupBy(F.get("probes", F.lit(0)).alias("part")).agg(F.count(F.lit(1)).alias("rows"))
             .join(asked.select(F.explode("probes").alias("part")).groupBy("part").agg(F.count(F.lit(1)).alias("asked")), "part"))
    sizes = sizes.select("part", F.ceil(F.col("rows") / ROWS_PER_BLOCK).cast("int").alias("rb"),
                         F.ceil(F.col("asked") / QUERIES_PER_BLOCK).cast("int").alias("qb")).collect()
    if not sizes:
        return df.sparkSession.createDataFrame([], empty)
    row_blocks = F.create_map(*[F.lit(z) for r in sizes for z in (r.part, r.rb)])
    query_blocks = F.create_map(*[F.lit(z) for r in sizes for z in (r.part, r.qb)])

    def dealt(frame, own, own_blocks, other, other_blocks):
        """Each row to its block, once for each block of the other side."""
        b = F.pmod(F.xxhash64("vec_id", F.lit(11)), F.element_at(own_blocks, F.col("part"))).cast("int")
        return (frame.where(F.element_at(own_blocks, F.col("part")).isNotNull()).withColumn(own, b)
                .withColumn(other, F.explode(F.sequence(F.lit(0), F.element_at(other_blocks, F.col("part")) - 1)))
                .select("part", "rb", "qb", "vec_id", "v"))

    left = dealt(placed.select("vec_id", "v", F.get("probes", F.lit(0)).alias("part")), "rb", row_blocks, "qb", query_blocks)
    right = dealt(asked.select("vec_id", "v", F.explode("probes").alias("part")), "qb", query_blocks, "rb", row_blocks)
    found = (left.groupBy("part", "rb", "qb").cogroup(right.groupBy("part", "rb", "qb"))
             .applyInPandas(_best(k), "query_id long, vec_id long, score double"))
    best = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")

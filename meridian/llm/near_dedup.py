"""Near-duplicate groups: MinHash with banding, signature check, exact links, star components.

1. A document's set is its distinct word shingles (64-bit hashes); documents with
   equal sets form a class, and only classes go on.
2. Each class gets the minima of many universal hashes, in bands.  Classes that
   share a band's minima share a bucket; a bucket's classes are joined to its
   smallest by a star (not by pairs), and connected components of these stars are
   the cells.  Two classes that must be linked are in one cell (see ``bands``).
3. A cell's whole sets are dealt to tasks in blocks of bounded size.  Inside a
   task signatures rule pairs out, and full sets confirm links.  Classes that are
   already connected there are not compared, and a task returns a spanning forest
   of its links, so its output is linear in its classes however dense the group.
4. Components of the confirmed links, by large-star and small-star.

Nulls: a null text is empty.  Empty sets are linked with nothing.  A null id is
ignored in a component's smallest id.  Repeated rows are one class.  The row of the
smallest id (null last, then the first in the input) is the one that is kept.  An
empty table gives no rows; other columns ride along in ``row``.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meridian.llm.common import BlockTable, give_back, mix64, text_of, tidy, with_block_facts
from meridian.llm.components import connected_components
from meridian.llm.words import gram_hashes, row_words, text_slices
from meridian.plans.iterate import cut, cut_at, delete

ROWS_PER_BLOCK = 1024
#: Chance that a pair exactly at the threshold shares no bucket, and most hashes used.
MISS = 5e-7
MOST_HASHES = 640
#: Shingles in one block of a cell; a task holds two blocks.
SHINGLES_PER_BLOCK = 750_000


def bands(threshold: float) -> tuple[int, int]:
    """Rows per band and bands: the longest band that keeps the miss chance at the
    threshold below ``MISS`` with at most ``MOST_HASHES`` hashes."""
    best = (1, math.ceil(math.log(MISS) / math.log(1 - threshold)))
    for r in range(2, 40):
        b = math.ceil(math.log(MISS) / math.log(1 - threshold ** r))
        if r * b <= MOST_HASHES:
            best = (r, b)
    return best


def universal_hashes(k: int) -> tuple[np.ndarray, np.ndarray]:
    """Multipliers (odd) and increments of k universal hashes on 32 bits."""
    x = mix64(np.arange(1, 2 * k + 1, dtype=np.uint64))
    return (x[:k] >> np.uint64(32)).astype(np.uint32) | np.uint32(1), (x[k:] >> np.uint64(32)).astype(np.uint32)


def minima(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The minimum of every hash over the set."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.full(len(a), 0xFFFFFFFF, np.uint32)
    for lo in range(0, len(x), 256):
        h = np.multiply.outer(a, x[lo:lo + 256])
        h += b[:, None]
        np.minimum(out, h.min(axis=1), out=out)
    return out


def shingle_set(words: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct shingles; a shorter text is one shingle, no words give none."""
    if len(words) == 0:
        return np.zeros(0, np.uint64)
    if len(words) < n:
        return gram_hashes(words, len(words)) ^ np.uint64(len(words))
    return np.unique(gram_hashes(words, n))


def _sets(column: pa.Array, n: int):
    for _, part in text_slices(column):
        words, first = row_words(part)
        for i in range(len(first) - 1):
            yield shingle_set(words[first[i]:first[i + 1]], n)


def _features(n: int, r: int, b: int):
    mul, inc = universal_hashes(r * b)
    place = np.arange(1, r + 1, dtype=np.uint64)[None, :] * np.uint64(0x9E3779B97F4A7C15)
    band_no = np.arange(1, b + 1, dtype=np.uint64)

    def body(batches):
        for batch in batches:
            size, h1, h2, keys = [], [], [], []
            for s in _sets(batch.column(2), n):
                size.append(len(s))
                h1.append(int(np.add.reduce(s).astype(np.int64)))
                h2.append(int(np.add.reduce(mix64(s)).astype(np.int64)))
                if len(s):
                    m = minima(s, mul, inc).reshape(b, r).astype(np.uint64)
                    keys.append(mix64(np.add.reduce(mix64(m + place), axis=1) + band_no).view(np.int64))
                else:
                    keys.append(np.zeros(0, np.int64))
            flat = np.concatenate(keys) if keys else np.zeros(0, np.int64)
            offsets = np.concatenate(([0], np.cumsum([len(k) for k in keys]))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(3), pa.array(size, pa.int64()), pa.array(h1, pa.int64()),
                 pa.array(h2, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))],
                names=["block", "pos", "doc_id", "n", "h1", "h2", "bands"])
    return tidy(body)


def _deal(n: int):
    """Sets of the classes of cells, to each task that needs them."""
    def body(batches):
        for batch in batches:
            cls, cell, blocks, own = (batch.column(i).to_pylist() for i in range(4))
            rows = []
            for c, e, nb, i, s in zip(cls, cell, blocks, own, _sets(batch.column(4), n), strict=True):
                blob = s.tobytes()
                rows += [(e, min(i, j), max(i, j), i, c, blob) for j in range(nb)]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (
                        pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.binary()), strict=True)],
                    names=["cell", "lo", "hi", "own", "cls", "shingles"])
    return tidy(body)


def forest(sets: list[np.ndarray], side: np.ndarray, threshold: float, mul: np.ndarray, inc: np.ndarray
           ) -> list[tuple[int, int]]:
    """Links that connect what the links between these sets connect; with two sides,
    only links between the sides count."""
    m = len(sets)
    size = np.array([len(s) for s in sets])
    crossing = len(set(side.tolist())) > 1
    cells, local = np.unique(np.concatenate(sets), return_inverse=True)
    first = np.concatenate(([0], np.cumsum(size)))
    mark = np.zeros(len(cells), bool)
    sig = None
    if m > 8:                                   # for a few sets the exact count is cheaper
        sig = np.stack([minima(s, mul, inc) for s in sets]).astype(np.uint8)
        least = threshold - 6 * math.sqrt(threshold * (1 - threshold) / len(mul))
    label = np.arange(m)
    out = []
    for a in range(m):
        if crossing and side[a] != side.min():
            continue
        ok = (label != label[a]) & (np.minimum(size, size[a]) >= threshold * np.maximum(size, size[a]) - 1e-9)
        ok &= (side != side[a]) if crossing else (np.arange(m) > a)
        cand = np.flatnonzero(ok)
        if sig is not None and len(cand):
            cand = cand[(sig[cand] == sig[a]).mean(axis=1) >= least]
        if len(cand) == 0:
            continue
        mark[local[first[a]:first[a + 1]]] = True
        length = size[cand]
        begin = np.concatenate(([0], np.cumsum(length)[:-1]))
        at = np.arange(int(length.sum())) + np.repeat(first[cand] - begin, length)
        common = np.add.reduceat(mark[local[at]].astype(np.int64), begin)
        mark[local[first[a]:first[a + 1]]] = False
        near = cand[100 * common >= round(100 * threshold) * (size[a] + length - common)]
        for b in near.tolist():
            if label[b] != label[a]:
                out.append((a, b))
                label[label == label[b]] = label[a]
    return out


def _verify(threshold: float, k: int):
    mul, inc = universal_hashes(k)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        a, b = [], []
        for (_, lo, hi), g in pdf.groupby(["cell", "lo", "hi"], sort=False):
            if len(g) < 2:
                continue
            sets = [np.frombuffer(x, np.uint64) for x in g["shingles"]]
            cls = g["cls"].to_numpy()
            side = g["own"].to_numpy() if lo != hi else np.zeros(len(g), np.int64)
            if lo != hi and len(set(side.tolist())) < 2:
                continue
            for i, j in forest(sets, side, threshold, mul, inc):
                a.append(cls[i])
                b.append(cls[j])
        give_back()
        return pd.DataFrame({"a": np.array(a, np.int64), "b": np.array(b, np.int64)})
    return run


def near_dedup(df: DataFrame, words: int = 5, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text",
               ) -> DataFrame:
    """One row per row of ``df``: ``row``, ``n_shingles``, ``component_id``, ``kept``."""
    r, b = bands(threshold)
    spark = df.sparkSession
    text = text_of(F.col(f"row.`{text_col}`").cast("string")).alias("text")
    store = BlockTable(df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")), ROWS_PER_BLOCK, F.octet_length(text))
    t = store.df()
    ident = F.col(f"row.`{id_col}`").cast("long").alias("doc_id")

    found, wide = cut_at(t.select("block", "pos", text, ident).mapInArrow(
        _features(words, r, b), "block long, pos long, doc_id long, n long, h1 long, h2 long, bands array<long>"))
    facts = cut(found.drop("bands"))

    # Classes of equal sets; the first row's number names the class.
    first = F.min(F.col("block") * ROWS_PER_BLOCK + F.col("pos") % ROWS_PER_BLOCK).alias("cls")
    banded, wider = cut_at(found.where("n > 0").groupBy("n", "h1", "h2").agg(
        first, F.min(F.struct("block", "pos")).alias("at"), F.first("bands").alias("bands")))
    delete(spark, wide)
    classes = cut(banded.drop("bands"))
    entries = banded.select(F.explode("bands").alias("key"), "cls")
    heads = entries.groupBy("key").agg(F.min("cls").alias("head"), F.count(F.lit(1)).alias("m")).where("m > 1")
    stars = entries.join(heads, "key").where("cls <> head").select(F.col("cls").alias("a"), F.col("head").alias("b"))
    cells = connected_components(stars).select(F.col("node").alias("cls"), F.col("root").alias("cell"))

    delete(spark, wider)                        # the stars are written: bands are not read again
    members = cut(classes.select("cls", "n", "at.block", "at.pos").join(cells, "cls"))
    sizes = members.groupBy("cell").agg(F.sum("n").alias("total")).withColumn(
        "blocks", F.ceil(F.col("total") / SHINGLES_PER_BLOCK).cast("int"))
    members = members.join(sizes.select("cell", "blocks"), "cell").withColumn(
        "own", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
    volume = members.agg(F.sum(F.col("n") * F.col("blocks"))).first()[0] or 0
    tasks = max(1, math.ceil(volume / SHINGLES_PER_BLOCK))

    sets = with_block_facts(t.select("block", "pos", text), members.select("block", "pos", "cls", "cell", "blocks", "own"),
                            "fact").select("fact.cls", "fact.cell", "fact.blocks", "fact.own", "text")
    dealt = sets.mapInArrow(_deal(words), "cell long, lo int, hi int, own int, cls long, shingles binary")
    # Small cells share a task; each pair of blocks of a large one is a task of its own.
    task = F.pmod(F.xxhash64("cell", "lo", "hi"), F.lit(tasks * 4))
    links = cut(dealt.groupBy(task.alias("task")).applyInPandas(_verify(threshold, r * b), "a long, b long"))
    linked = connected_components(links)

    # From classes back to rows: a class without links is a component of its own.
    of_class = classes.select("n", "h1", "h2", "cls").join(linked.withColumnRenamed("node", "cls"), "cls", "left").select(
        "n", "h1", "h2", F.coalesce("root", "cls").alias("root"))
    named = cut(facts.select("block", "pos", "doc_id", "n", "h1", "h2").join(of_class, ["n", "h1", "h2"], "left"))
    last = F.coalesce("doc_id", F.lit((1 << 63) - 1))
    least = named.where("root is not null").groupBy("root").agg(
        F.min("doc_id").alias("least"), F.min(F.struct(last, "block", "pos")).alias("stays"))
    alone = F.col("root").isNull()
    decided = named.join(least, "root", "left").select(
        "block", "pos", "n", F.when(alone, F.col("doc_id")).otherwise(F.col("least")).alias("component_id"),
        (alone | ((F.col("stays.block") == F.col("block")) & (F.col("stays.pos") == F.col("pos")))).alias("kept"))
    return with_block_facts(t.select("block", "pos", "row"), decided, "f").select(
        "row", F.col("f.n").alias("n_shingles"), F.col("f.component_id").alias("component_id"),
        F.col("f.kept").alias("kept"))

"""Mixture-controlled packing by deficit round-robin over source queues.

Every source is a queue of its documents' ids (each document ends with a marker).
Source i has a target weight; a virtual clock runs over all queues, and at time v
source i has given ``min(total_i, weight_i * v)`` ids.  Equal steps of the clock
are the partitions; what a source owes at their edges (the part of an id that the
floor cuts off) is carried over as its deficit, so no partition needs the one
before it.  Inside a partition deficit round-robin fills window after window:
each source's deficit grows by its share of the window, it gives the whole ids of
its deficit, and what is still free goes to the largest deficits.

Windows hold ``length`` ids.  The ids left at a partition's end fill windows
whose sizes are powers of two, so nothing is padded.

Ids stay in a block table; only lengths and cuts are shuffled.  A null or empty
text gives the marker alone, a null source is a queue of its own, repeated rows
are packed as often as they occur, an empty table gives no rows.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from meridian.llm.bpe import Encoded
from meridian.llm.common import BLOCK_BYTES, BLOCKS_PER_PARTITION, BlockTable, cut_blocks, give_back, tidy
from meridian.llm.tokens import Vocabulary, read_vocabulary, vocabulary
from meridian.plans.iterate import cut

WINDOWS_PER_PARTITION = 256
ROWS_PER_BLOCK = 4096
#: Sequence numbers a partition may use (its windows, and those of its end).
IDS_PER_PARTITION = 1 << 20


def _encoder(v: Vocabulary) -> tiktoken.Encoding:
    """The same ids as the vocabulary file's own library gives, where ids follow merge ranks."""
    if not v.by_id():
        raise ValueError("ids that do not follow the merge ranks")
    return tiktoken.Encoding("file", pat_str=v.split.pattern, mergeable_ranks={v.as_bytes[t]: i for t, i in v.ids.items()},
                             special_tokens=v.added)


def _ids(text: str, enc: tiktoken.Encoding, v: Vocabulary) -> np.ndarray:
    """Ids of a text; one that the fast encoder rejects (a million white-space characters
    in a row exhaust its pattern's stack) is encoded by the pair index."""
    try:
        found = enc.encode(text, allowed_special="all")
    except ValueError:
        found = Encoded([text], v).ids(0)
    return np.array(found, "<u4")


def token_table(df: DataFrame, path: str, end_id: int, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """doc_id, source, n, ids (little-endian unsigned 32-bit ids, the end marker included), and
    the place: pos, and block (of at most ``ROWS_PER_BLOCK`` rows and, beyond one row, ``BLOCK_BYTES``)."""
    shared = df.sparkSession.sparkContext.broadcast(read_vocabulary(path))

    def body(batches):
        v = vocabulary(shared.value)
        enc = _encoder(v)
        tail = np.array([end_id], "<u4").tobytes()
        state, pos = [TaskContext.get().partitionId() * BLOCKS_PER_PARTITION, 0, 0], 0
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                ids = [_ids(t, enc, v).tobytes() + tail for t in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([len(x) // 4 for x in ids], pa.int64()),
                     pa.array(ids, pa.binary()), pa.array(range(pos, pos + len(ids)), pa.int64()),
                     pa.array(cut_blocks([len(x) for x in ids], state, BLOCK_BYTES, ROWS_PER_BLOCK), pa.int64())],
                    names=["doc_id", "source", "n", "ids", "pos", "block"])
                pos += len(ids)

    return df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                     F.coalesce(F.concat(F.lit("="), F.col(f"`{source_col}`").cast("string")), F.lit("")).alias("source"),
                     F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text")
                     ).mapInArrow(tidy(body), "doc_id long, source string, n long, ids binary, pos long, block long")


def window_sizes(total: int, length: int) -> np.ndarray:
    """Full windows, then powers of two for what is left."""
    rest = total % length
    tail = [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]
    return np.array([length] * (total // length) + tail, np.int64)


def deficit_round_robin(queued: np.ndarray, share: np.ndarray, owed: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """How many ids each queue gives to each window (windows x queues)."""
    left, deficit = queued.astype(np.int64).copy(), owed.astype(float).copy()
    out = np.zeros((len(sizes), len(left)), np.int64)
    for w, size in enumerate(sizes.tolist()):
        live = left > 0
        part = np.where(live, share, 0.0)
        if part.sum() <= 0:
            part = live.astype(float)
        deficit += part * (size / part.sum())
        give = np.clip(np.floor(deficit), 0, left).astype(np.int64)
        free = size - int(give.sum())
        for i in np.argsort(-(deficit - give), kind="stable").tolist() if free > 0 else ():
            more = min(free, int(left[i] - give[i]), max(1, int(deficit[i] - give[i])))
            give[i] += more
            free -= more
            if free == 0:
                break
        if free > 0:                                  # every queue but few is short: take what there is
            for i in np.argsort(-(left - give), kind="stable").tolist():
                more = min(free, int(left[i] - give[i]))
                give[i] += more
                free -= more
                if free == 0:
                    break
        for i in np.argsort(deficit - give, kind="stable").tolist() if free < 0 else ():
            less = min(-free, int(give[i]))
            give[i] -= less
            free += less
            if free == 0:
                break
        deficit -= give
        left -= give
        deficit[left == 0] = 0.0
        out[w] = give
    return out


def _pack(length: int):
    def run(key, pdf: pd.DataFrame) -> pd.DataFrame:
        b = int(key[0])
        pdf = pdf.sort_values(["source", "at"], kind="stable")
        names, of = np.unique(pdf["source"].to_numpy(str), return_inverse=True)
        size = pdf["length"].to_numpy(np.int64)
        queued = np.bincount(of, size, len(names)).astype(np.int64)
        one = pdf.drop_duplicates("source")
        sizes = window_sizes(int(queued.sum()), length)
        take = deficit_round_robin(queued, one["weight"].to_numpy(float), one["owed"].to_numpy(float), sizes)
        first = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1])))
        rows = []
        for s in range(len(names)):
            lo, hi = first[s], first[s + 1] if s + 1 < len(names) else len(of)
            docs = np.cumsum(size[lo:hi])
            windows = np.cumsum(take[:, s])
            edges = np.unique(np.concatenate((docs, windows)))
            edges = edges[edges > 0]
            begin = np.concatenate(([0], edges[:-1]))
            d = np.searchsorted(docs, begin, side="right")
            rows.append(np.stack([np.searchsorted(windows, begin, side="right"), np.full(len(begin), s),
                                  lo + d, begin - (docs[d] - size[lo + d]), edges - begin]))
        w, s, row, start, n = np.concatenate(rows, axis=1)
        order = np.lexsort((start, row, s, w))
        w, row, start, n = w[order], row[order], start[order], n[order]
        before = np.cumsum(n) - n
        offset = before - (np.cumsum(sizes) - sizes)[w]
        pick = pdf.iloc[row]
        return pd.DataFrame({"block": pick["block"].to_numpy(), "pos": pick["pos"].to_numpy(),
                             "start": pick["start"].to_numpy() + start, "length": n,
                             "sequence_id": b * IDS_PER_PARTITION + w, "offset": offset, "sequence_length": sizes[w]})
    return run


def _digest(key, docs: pd.DataFrame, pieces: pd.DataFrame) -> pd.DataFrame:
    ids = dict(zip(docs["pos"], docs["ids"], strict=True))
    crc = [zlib.crc32(ids[p][4 * s:4 * (s + n)])
           for p, s, n in zip(pieces["pos"], pieces["start"], pieces["length"], strict=True)]
    source = [x[1:] if x else None for x in docs["source"]]
    give_back()
    out = pieces.assign(ids_crc32=crc).merge(docs[["pos", "doc_id", "n"]].assign(source=source), on="pos")
    return out.rename(columns={"n": "doc_tokens"})[
        ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "sequence_length", "source"]]


def pack(df: DataFrame, path: str, length: int = 2048, end_id: int = 1, targets: dict[str, float] | None = None,
         id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per piece.  ``targets``: weight of each source (all others 0, given out
    last); by default each source's share of all ids, so all end together."""
    spark = df.sparkSession
    store = BlockTable(token_table(df, path, end_id, id_col, text_col, source_col), compression="zstd")
    t = store.df()
    rows = t.select("block", "pos", "source", "n")

    # Where each document begins in its source's queue: sums by (source, block), then inside a block.
    sums = rows.groupBy("source", "block").agg(F.sum("n").alias("n"))
    run = W.partitionBy("source").orderBy("block")
    sums = cut(sums.select("source", "block", (F.sum("n").over(run) - F.col("n")).alias("base"), "n"))
    totals = sums.groupBy("source").agg(F.sum("n").alias("total"))
    weight = F.col("total").cast("double")
    if targets is not None:
        names = F.create_map(*[F.lit(x) for k, v in targets.items() for x in ("=" + k, float(v))])
        weight = F.coalesce(F.get(F.array(F.element_at(names, F.col("source"))), F.lit(0)), F.lit(0.0))
    totals = totals.withColumn("weight", weight)
    # A source without weight is given out over the whole run of the clock.
    stats = totals.agg(F.sum("total").alias("total"), F.max(
        F.when(F.col("weight") > 0, F.col("total") / F.col("weight"))).alias("clock")).first()
    clock = stats.clock or 1.0
    parts = max(1, -(-int(stats.total or 0) // (length * WINDOWS_PER_PARTITION)))
    totals = totals.withColumn("weight", F.when(F.col("weight") > 0, F.col("weight")).otherwise(F.col("total") / clock))

    inside = W.partitionBy("block", "source").orderBy("pos")
    at = (rows.withColumn("in", F.sum("n").over(inside) - F.col("n"))
          .join(sums.select("block", "source", "base"), ["block", "source"])
          .join(totals, "source").withColumn("at", F.col("base") + F.col("in")))

    def edge(b: Column) -> Column:
        """Ids that the source has given when partition b begins."""
        given = F.floor(F.col("weight") * (clock * 1.0) * b / float(parts)).cast("long")
        return F.when(b <= 0, F.lit(0).cast("long")).when(b >= parts, F.col("total")).otherwise(
            F.least(given, F.col("total")))

    def near(x: Column) -> Column:
        return F.floor(x * float(parts) / (F.col("weight") * clock)).cast("long")

    spans = F.sequence(F.greatest(near(F.col("at")) - 1, F.lit(0).cast("long")),
                       F.least(near(F.col("at") + F.col("n")) + 1, F.lit(parts - 1).cast("long")))
    b = F.col("part")
    segments = (at.withColumn("part", F.explode(spans))
                .withColumn("lo", F.greatest(F.col("at"), edge(b)))
                .withColumn("hi", F.least(F.col("at") + F.col("n"), edge(b + 1)))
                .where(F.col("hi") > F.col("lo"))
                .select("part", "source", "block", "pos", F.col("lo").alias("at"),
                        (F.col("lo") - F.col("at")).alias("start"), (F.col("hi") - F.col("lo")).alias("length"),
                        "weight", (F.col("weight") * clock * b / float(parts) - edge(b)).alias("owed")))
    pieces = segments.groupBy("part").applyInPandas(
        _pack(length), "block long, pos long, start long, length long, sequence_id long, offset long, sequence_length long")
    return (t.select("block", "pos", "doc_id", "source", "n", "ids").groupBy("block")
            .cogroup(pieces.groupBy("block"))
            .applyInPandas(_digest, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
                                    "sequence_id long, offset long, sequence_length long, source string"))

"""Exact deduplication by a Golomb-coded fingerprint exchange.

1. Every block (input partition) sorts the distinct 48-bit fingerprints of its
   texts and sends each owner, which holds one range of the fingerprint space,
   its part as Golomb-Rice coded differences.
2. An owner decodes what all blocks sent, and answers each block with a bitmap:
   bit i is set if the i-th fingerprint of that message was also sent by another
   block.  A fingerprint that repeats inside a block is sent once and needs no
   answer, so a group that holds a third of all rows costs an owner one entry
   per block.
3. Rows whose fingerprint is marked are suspects.  Only they are shuffled: texts
   are grouped by their bytes (with map-side combining, so copies collapse before
   the shuffle), which verifies them and finds the row that stays.

Rows never move: a block asks once for each digest of its suspects, and the answers
come back to it.  Nulls count as empty texts, a text of any length is read whole; a null id is
larger than any other; of rows that tie in length and id the first in (block,
position) stays, so exactly one row of each group is kept, also among repeated
rows.  An empty table gives no rows.  All other columns ride in ``row``.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meridian.llm.common import BlockTable, shuffle_partitions, strip_spaces, text_of, with_block_facts
from meridian.plans.iterate import cut

FP_BITS = 48


def rice_parameter(n: int, span: int) -> int:
    """Low bits per difference: log2 of the mean difference."""
    return max(0, int(span // max(1, n)).bit_length() - 1)


def rice_encode(values: np.ndarray, k: int) -> bytes:
    """Sorted distinct integers as Golomb-Rice coded differences (the first from 0).

    The unary quotients and the k-bit remainders are two streams, so that both
    are read back without a step per value; four bytes tell where the second begins."""
    d = np.diff(values.astype(np.int64), prepend=np.int64(0))
    stops = np.cumsum((d >> k) + 1) - 1
    unary = np.ones(int(stops[-1]) + 1 if len(d) else 0, np.uint8)
    unary[stops] = 0
    low = ((d[:, None] >> np.arange(k)) & 1).astype(np.uint8)
    head = np.packbits(unary).tobytes()
    return len(head).to_bytes(4, "little") + head + np.packbits(low.ravel()).tobytes()


def rice_decode(blob: bytes, n: int, k: int) -> np.ndarray:
    at = 4 + int.from_bytes(blob[:4], "little")
    unary = np.unpackbits(np.frombuffer(blob[4:at], np.uint8))
    stops = np.flatnonzero(unary == 0)[:n]
    d = (np.diff(stops, prepend=-1) - 1) << k
    if k:
        low = np.unpackbits(np.frombuffer(blob[at:], np.uint8), count=n * k).reshape(n, k)
        d = d + low.astype(np.int64) @ (np.int64(1) << np.arange(k))
    return np.cumsum(d)


def _range_of(owner: int, owners: int) -> int:
    """The first fingerprint that belongs to ``owner``."""
    return -((-owner << FP_BITS) // owners)


def _bounds(owners: int) -> np.ndarray:
    return np.array([_range_of(o, owners) for o in range(owners + 1)], np.int64)


#: What a block sends to an owner.
MESSAGE = "owner int, block long, n int, k int, payload binary"


def messages(block: int, fps: np.ndarray, bounds: np.ndarray) -> pd.DataFrame:
    """One message to each owner that holds some of these sorted distinct fingerprints."""
    cuts = np.searchsorted(fps, bounds)
    out = []
    for o in np.flatnonzero(np.diff(cuts)):
        part = fps[cuts[o]:cuts[o + 1]] - bounds[o]
        k = rice_parameter(len(part), int(bounds[o + 1] - bounds[o]))
        out.append((int(o), block, len(part), k, rice_encode(part, k)))
    return pd.DataFrame(out, columns=["owner", "block", "n", "k", "payload"])


def foreign(fps: np.ndarray, owner, bitmap, bounds: np.ndarray) -> np.ndarray:
    """Which of a block's sorted distinct fingerprints other blocks sent too, by the owners' answers."""
    out = np.zeros(len(fps), bool)
    cuts = np.searchsorted(fps, bounds)
    for o, bits in zip(owner, bitmap, strict=True):
        lo, hi = cuts[o], cuts[o + 1]
        out[lo:hi] = np.unpackbits(np.frombuffer(bits, np.uint8), count=hi - lo).astype(bool)
    return out


def _encode_block(owners: int):
    bounds = _bounds(owners)

    def run(key, pdf: pd.DataFrame) -> pd.DataFrame:
        return messages(int(key[0]), np.unique(pdf["fp"].to_numpy(np.int64)), bounds)
    return run


def _answer(pdf: pd.DataFrame) -> pd.DataFrame:
    """What an owner does: which fingerprints came from two blocks or more."""
    parts = [rice_decode(p, n, k) for p, n, k in zip(pdf["payload"], pdf["n"], pdf["k"], strict=True)]
    u, back, count = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
    marks = np.split(count[back] > 1, np.cumsum([len(p) for p in parts])[:-1])
    return pd.DataFrame({"owner": pdf["owner"], "block": pdf["block"],
                         "bitmap": [np.packbits(m).tobytes() for m in marks]})


def answers(sent: DataFrame) -> DataFrame:
    return sent.groupBy("owner").applyInPandas(_answer, "owner int, block long, bitmap binary")


#: The marks of a block without suspects.
NO_MARKS = pd.DataFrame({"block": pd.Series([], dtype="int64"), "words": pd.Series([], dtype="object")})


def _mark_block(owners: int):
    bounds = _bounds(owners)

    def run(key, rows: pd.DataFrame, answer: pd.DataFrame) -> pd.DataFrame:
        if rows.empty:
            return NO_MARKS
        fp, pos = rows["fp"].to_numpy(np.int64), rows["pos"].to_numpy(np.int64)
        u, back, count = np.unique(fp, return_inverse=True, return_counts=True)
        dup = (count > 1) | foreign(u, answer["owner"], answer["bitmap"], bounds)
        hit = pos[dup[back]]
        if len(hit) == 0:
            return NO_MARKS
        bits = np.zeros((int(hit.max()) // 64 + 1) * 64, np.uint8)
        bits[hit] = 1
        words = np.packbits(bits, bitorder="little").view(np.int64)
        return pd.DataFrame({"block": [int(key[0])], "words": [words]})
    return run


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``df``: ``row`` (a struct of all its columns), ``keep_id``,
    ``group_size``, ``kept``, ``text_sha256``."""
    spark = df.sparkSession
    owners = shuffle_partitions(spark)
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))
    text = text_of(F.col(f"row.`{text_col}`").cast("string"))
    ident = F.col(f"row.`{id_col}`").cast("long")
    rows = rows.withColumn("sha", F.sha2(strip_spaces(text), 256))
    rows = rows.withColumn("fp", F.conv(F.substring("sha", 1, FP_BITS // 4), 16, 10).cast("long"))
    store = BlockTable(rows)
    t = store.df()

    sent = t.select("block", "fp").groupBy("block").applyInPandas(
        _encode_block(owners), MESSAGE)
    marks = (t.select("block", "pos", "fp").groupBy("block")
             .cogroup(answers(sent).groupBy("block"))
             .applyInPandas(_mark_block(owners), "block long, words array<long>"))
    marks = cut(marks)

    def marked(wanted: int, *cols) -> DataFrame:
        word = F.get(F.col("words"), F.expr("cast(pos div 64 as int)"))
        bit = F.expr("shiftright(__w, cast(pos % 64 as int))").bitwiseAND(F.lit(1))
        return (t.join(marks.hint("shuffle_hash"), "block", "left").withColumn("__w", F.coalesce(word, F.lit(0)))
                .where(bit == wanted).select(*cols))

    suspects = marked(1, "sha", strip_spaces(text).alias("norm"), F.length(text).alias("len"),
                      (-ident).alias("minus_id"), "block", "pos")
    best = F.max(F.struct("len", "minus_id", (-F.col("block")).alias("b"), (-F.col("pos")).alias("p")))
    classes = suspects.groupBy("sha", "norm").agg(F.count(F.lit(1)).alias("n"), best.alias("best"))
    classes = classes.groupBy("sha").agg(
        F.count(F.lit(1)).alias("texts"), F.first("n").alias("n"), F.first("best").alias("best"))
    classes = classes.select(
        "sha", F.when(F.col("texts") == 1, F.col("n")).otherwise(
            F.raise_error(F.lit("two texts share a SHA-256 digest")).cast("long")).alias("n"), "best")
    alone = marked(0, "row", ident.alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
                   F.lit(True).alias("kept"), F.col("sha").alias("text_sha256"))
    # A block asks once for each of its digests, so a group of any size costs it one row.
    found = cut(marked(1, "block", "sha").distinct().join(classes, "sha").select("block", "sha", "n", "best"))
    grouped = with_block_facts(t.select("block", "pos", "row", "sha"), found, "f", key="sha").select(
        "row", (-F.col("f.best.minus_id")).alias("keep_id"), F.col("f.n").alias("group_size"),
        ((F.col("block") == -F.col("f.best.b")) & (F.col("pos") == -F.col("f.best.p"))).alias("kept"),
        F.col("sha").alias("text_sha256"))
    return alone.unionByName(grouped)

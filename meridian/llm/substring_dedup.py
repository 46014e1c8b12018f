"""Removal of repeated passages with prefix-partitioned (sparse) suffix trees.

A word goes if a window of ``length`` words that covers it also starts earlier
(smaller id, or earlier in the same document).

* Suffixes.  Two equal windows contain the same ``PREFIX``-word grams, so both
  choose the same one by smallest hash (the rightmost, if several): their anchor.  Every
  window hangs on its anchor, and consecutive windows of one anchor travel as one
  record, the text from the first window's first word to the last one's last.
* Which prefixes repeat is found first, by the compact fingerprint exchange of
  ``exact_dedup``: an anchor whose prefix occurs nowhere else has no subtree.
* Prefix partitions.  Records are dealt out by the prefix that all their windows
  share, at first the anchor's ``PREFIX`` words.  Where the records of one prefix take
  more than ``GROUP_BYTES``, the prefix is made longer: the windows are parted by
  the place of the anchor in them, once, again and so on, and each part shares more words
  (``prefix_classes``), in the end the whole window.  A block first builds its own
  subtrees, in memory, and passes on only the first occurrence of each window, so even a
  whole window that is everywhere brings one record per block.
* A subtree is the suffix array of its windows' suffixes (to the end of their
  record) with the lengths of the common prefixes of neighbours.  Runs of neighbours that
  share ``length`` words or more are its deep internal nodes, the maximal repeats; of
  the leaves below such a node the first occurrence stays.

Hashes only choose anchors and bring records together; suffixes are compared by
their words (exact numbers of a dictionary that each task makes of its words).

Words keep their case.  A null text has no words, a null id sorts last, rows with
equal ids are ordered by their place in the input, an empty table gives no rows.
Texts shorter than ``length`` words lose nothing; a text of any length is read whole, in
a block of its own if it is longer than ``common.BLOCK_BYTES``.  Other columns, whatever
their names, ride in ``row``.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meridian.llm.common import BlockTable, give_back, mix64, shuffle_partitions, text_of, tidy
from meridian.llm.exact_dedup import FP_BITS, MESSAGE, _bounds, answers, foreign, messages
from meridian.llm.words import gram_hashes, spans, text_bytes, without_spaces, word_hashes
from meridian.plans.iterate import cut

PREFIX = 8
ROWS_PER_BLOCK = 4096
#: Bytes of records that one prefix may bring to a task, and that one task takes on the average.
GROUP_BYTES, TASK_BYTES = 16 << 20, 24 << 20
#: Windows whose suffixes are sorted at a time.
SLICE = 100_000
LAST = np.int64((1 << 63) - 1)
#: Windows to strike (a first window and a mask of it and those behind it).
MARK = "block long, pos long, lo int, mask long"
MARK_SCHEMA = pa.schema([("block", pa.int64()), ("pos", pa.int64()), ("lo", pa.int32()), ("mask", pa.int64())])
#: Windows of one anchor: ``at`` is the anchor's place behind the first word, ``words`` their text.
RECORD = MARK + ", key long, doc long, at int, words binary"
RECORD_SCHEMA = pa.schema([*MARK_SCHEMA, ("key", pa.int64()), ("doc", pa.int64()), ("at", pa.int32()), ("words", pa.binary())])


def choose_anchors(grams: np.ndarray, width: int) -> np.ndarray:
    """For each run of ``width`` grams the place of the smallest, the rightmost of equals."""
    if len(grams) < width:
        return np.zeros(0, np.int64)
    view = np.lib.stride_tricks.sliding_window_view(grams[::-1], width)
    best = np.empty(len(grams) - width + 1, np.int64)
    for lo in range(0, len(view), 100_000):
        best[lo:lo + 100_000] = view[lo:lo + 100_000].argmin(axis=1) + np.arange(lo, min(lo + 100_000, len(view)))
    return (len(grams) - 1 - best)[::-1]


def prefix_classes(length: int) -> list[list[tuple[int, int]]]:
    """By level, the spans of the anchor's place in a window whose windows share a prefix.

    Windows with the anchor ``a`` to ``b`` words behind their begin all contain the
    ``length - (b - a)`` words from ``a`` words before the anchor on."""
    levels = [[(0, length - PREFIX)]]
    while any(a < b for a, b in levels[-1]):
        levels.append([part for a, b in levels[-1]
                       for part in ([(a, (a + b) // 2), ((a + b) // 2 + 1, b)] if a < b else [(a, b)])])
    return levels


def word_numbers(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Exact numbers of words, from 1: equal words, and only they, have equal numbers."""
    offsets = np.concatenate(([0], np.cumsum(ends - begins))).astype(np.int64)
    words = pa.Array.from_buffers(pa.large_binary(), len(begins), [None, pa.py_buffer(offsets), pa.py_buffer(without_spaces(data))])
    return pc.dictionary_encode(words).indices.to_numpy().astype(np.uint32) + np.uint32(1)


def suffix_array(numbers: np.ndarray, start: np.ndarray, stop: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes that begin at ``start``, read up to ``stop`` and at most
    ``depth`` words, and the words that each shares with the one before it."""
    at = start[:, None] + np.arange(depth)
    rows = np.where(at < stop[:, None], numbers[np.minimum(at, len(numbers) - 1)], 0).astype(">u4")
    order = np.argsort(rows.view(f"S{4 * depth}").ravel(), kind="stable")
    rows = rows[order]
    differ = rows[1:] != rows[:-1]
    lcp = np.where(differ.any(axis=1), differ.argmax(axis=1), depth)
    lcp = np.minimum(lcp, (rows[1:] != 0).sum(axis=1))                  # what lies behind the end is not shared
    return order, np.concatenate(([0], lcp)) if len(start) else np.zeros(0, np.int64)


def later_windows(numbers: np.ndarray, start: np.ndarray, stop: np.ndarray, rank: np.ndarray, length: int) -> np.ndarray:
    """Which windows have an equal one of smaller rank: of the leaves below each internal
    node at ``length`` words or deeper, all but the first."""
    out = np.zeros(len(start), bool)
    if len(start) < 2:
        return out
    codes = gram_hashes(mix64(numbers.astype(np.uint64)), length)
    _, back, count = np.unique(codes[start], return_inverse=True, return_counts=True)
    own = np.flatnonzero(count[back] > 1)                                # only these can share ``length`` words
    own = own[np.argsort(back[own], kind="stable")]
    for lo, hi in _in_groups(back[own], SLICE):
        w = own[lo:hi]
        order, lcp = suffix_array(numbers, start[w], stop[w], 2 * length)
        head = np.flatnonzero(lcp < length)                              # a node's first leaf
        by = rank[w][order]
        first = np.minimum.reduceat(by, head)
        out[w[order]] = by != np.repeat(first, np.diff(np.concatenate((head, [len(by)]))))
    return out


def _in_groups(g: np.ndarray, limit: int):
    """Index ranges of sorted ``g`` that keep equal values together, of about ``limit``."""
    cuts = np.flatnonzero(np.concatenate((g[1:] != g[:-1], [True]))) + 1 if len(g) else []
    lo = 0
    while lo < len(g):
        hi = int(cuts[min(len(cuts) - 1, np.searchsorted(cuts, lo + limit))])
        yield lo, hi
        lo = hi


def rank_of(*keys: np.ndarray) -> np.ndarray:
    """Place in the order by these keys, the most significant first."""
    out = np.empty(len(keys[0]), np.int64)
    out[np.lexsort(keys[::-1])] = np.arange(len(out))
    return out


class Block:
    """Words of a block's texts, its windows, and the anchor of each window."""

    def __init__(self, texts: pa.Array, length: int):
        self.data, first = text_bytes(texts)
        self.begins, self.ends, self.first = spans(self.data, first)
        grams = gram_hashes(word_hashes(self.data, self.begins, self.ends, lower=False), PREFIX)
        anchor = choose_anchors(grams, length - PREFIX + 1)              # of every run of words, across rows too
        count = np.maximum(np.diff(self.first) - length + 1, 0)
        begin = np.cumsum(count) - count
        self.row = np.repeat(np.arange(len(count)), count)
        self.start = np.arange(int(count.sum())) + np.repeat(self.first[:-1] - begin, count)
        self.anchor = anchor[self.start]
        self.g = grams[self.anchor]

    def prefixes(self) -> np.ndarray:
        return (self.g >> np.uint64(64 - FP_BITS)).astype(np.int64)

    def text(self, first: int, stop: int) -> bytes:
        """Words first to stop - 1, each followed by white space."""
        found = self.data[self.begins[first]:self.ends[stop - 1]].tobytes()
        # White space of any length lies between words; long stretches are not sent.
        return (found if len(found) < 16 * (stop - first) else b" ".join(found.split())) + b" "


def _send(owners: int, length: int):
    bounds = _bounds(owners)
    schema = pa.schema([("owner", pa.int32()), ("block", pa.int64()), ("n", pa.int32()), ("k", pa.int32()), ("payload", pa.binary())])

    def run(t: pa.Table) -> pa.Table:
        fps = np.unique(Block(t.column("text"), length).prefixes())
        out = pa.Table.from_pandas(messages(t.column("block")[0].as_py(), fps, bounds), schema=schema, preserve_index=False)
        give_back()
        return out
    return run


def _table(schema: pa.Schema, *columns) -> pa.Table:
    return pa.Table.from_arrays([pa.array(x, f.type) for x, f in zip(columns, schema, strict=True)], schema=schema)


def _local(owners: int, length: int):
    """A block's own subtrees: marks for its later windows (a record without words), and
    records of first windows whose prefix is elsewhere too."""
    bounds = _bounds(owners)

    def run(t: pa.Table, answer: pa.Table) -> pa.Table:
        b = Block(t.column("text"), length) if t.num_rows else None
        if b is None or len(b.start) == 0:
            return RECORD_SCHEMA.empty_table()
        block = t.column("block")[0].as_py()
        pos, doc = t.column("pos").to_numpy(), t.column("doc").to_numpy()
        u, back = np.unique(b.prefixes(), return_inverse=True)
        away = foreign(u, answer.column("owner").to_pylist(), answer.column("bitmap").to_pylist(), bounds)[back]
        own = np.concatenate(([True], b.anchor[1:] != b.anchor[:-1]))       # anchors ascend with the windows
        at_home = np.bincount(back[own], minlength=len(u))[back] > 1
        use = np.flatnonzero(away | at_home)
        later = np.zeros(len(b.start), bool)
        home = np.flatnonzero(at_home)
        if len(home):
            numbers = word_numbers(b.data, b.begins, b.ends)
            w = b.row[home]
            later[home] = later_windows(numbers, b.start[home], b.first[w + 1], rank_of(doc[w], pos[w], b.start[home]), length)
        if len(use) == 0:
            return RECORD_SCHEMA.empty_table()
        # One record per anchor: its windows are consecutive.
        head = np.flatnonzero(np.concatenate(([True], b.anchor[use][1:] != b.anchor[use][:-1])))
        size = np.diff(np.concatenate((head, [len(use)])))
        bit = np.int64(1) << (np.arange(len(use)) - np.repeat(head, size))
        struck = np.add.reduceat(np.where(later[use], bit, 0), head)
        firsts = np.add.reduceat(np.where(later[use] | ~away[use], 0, bit), head)
        w = use[head]
        row, lo = b.row[w], b.start[w] - b.first[b.row[w]]
        m, k = struck != 0, firsts != 0
        words = [b.text(s, s + n + length - 1) for s, n in zip(b.start[w][k].tolist(), size[k].tolist(), strict=True)]
        cat = np.concatenate
        none = [None] * int(m.sum())
        out = _table(RECORD_SCHEMA, np.full(len(none) + len(words), block), cat((pos[row[m]], pos[row[k]])), cat((lo[m], lo[k])),
                     cat((struck[m], firsts[k])), cat((b.g[w][m], b.g[w][k])).view(np.int64), cat((doc[row[m]], doc[row[k]])),
                     cat((lo[m] * 0, (b.anchor[w] - b.start[w])[k])), none + words)
        give_back()
        return out
    return run


class Records:
    """Words of a batch of records."""

    def __init__(self, blobs: list[bytes]):
        first = np.concatenate(([0], np.cumsum([len(x) for x in blobs]))).astype(np.int64)
        self.data = np.frombuffer(b"".join(blobs), np.uint8)
        self.begins, self.ends, self.first = spans(self.data, first)


def _lengthen(length: int, level: int):
    """Records parted by the place of the anchor in their windows, under longer prefixes."""
    classes = prefix_classes(length)[level]

    def body(batches):
        for b in batches:
            c = {n: b.column(n).to_numpy() for n in ("block", "pos", "lo", "mask", "doc", "at")}
            r = Records(b.column("words").to_pylist())
            codes = word_hashes(r.data, r.begins, r.ends, lower=False)
            first = r.first[:-1]
            for i, (a, z) in enumerate(classes):
                share = length - (z - a)
                # The window k words behind the first has the anchor at - k words behind its begin.
                k = c["at"][:, None] - np.arange(a, z + 1)
                mask = np.where((k >= 0) & (k < 63), np.int64(1) << np.clip(k, 0, 62).astype(np.int64), 0).sum(axis=1) & c["mask"]
                own = np.flatnonzero(mask)
                if len(own) == 0:
                    continue
                grams = gram_hashes(codes, share)
                key = mix64(grams[first[own] + c["at"][own] - a] + np.uint64(64 * level + i)).view(np.int64)
                yield pa.RecordBatch.from_arrays([*(pa.array(x, f.type) for x, f in zip(
                    (c["block"][own], c["pos"][own], c["lo"][own], mask[own], key, c["doc"][own], c["at"][own]), RECORD_SCHEMA, strict=False)),
                    b.column("words").take(pa.array(own))], schema=RECORD_SCHEMA)
    return tidy(body)


def _merge(length: int):
    """Subtrees over the records of a task's prefixes: marks of their later windows."""
    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by("key").combine_chunks()
        c = {n: t.column(n).to_numpy() for n in ("key", "block", "pos", "doc", "lo", "mask")}
        blobs = t.column("words")
        later = np.zeros(t.num_rows, np.int64)
        for lo, hi in _in_groups(c["key"], SLICE // 8):
            if hi - lo < 2:
                continue
            r = Records(blobs[lo:hi].to_pylist())
            rec, k = np.nonzero((c["mask"][lo:hi, None] >> np.arange(length)) & 1)
            x = rec + lo
            rank = rank_of(c["doc"][x], c["block"][x], c["pos"][x], c["lo"][x] + k)
            hit = later_windows(word_numbers(r.data, r.begins, r.ends), r.first[rec] + k, r.first[rec + 1], rank, length)
            np.bitwise_or.at(later, x[hit], np.int64(1) << k[hit].astype(np.int64))
        f = later != 0
        out = _table(MARK_SCHEMA, c["block"][f], c["pos"][f], c["lo"][f], later[f])
        give_back()
        return out
    return run


def _rewrite(length: int, as_is: bool):
    def run(t: pa.Table, marks: pa.Table) -> pa.Table:
        by_row: dict[int, list] = {}
        for p, lo, mask in zip(*(marks.column(n).to_pylist() for n in ("pos", "lo", "mask")), strict=True):
            by_row.setdefault(p, []).append((lo, mask))
        total, removed, kept = [], [], []
        for p, text in zip(t.column("pos").to_pylist(), t.column("text"), strict=True):
            text = text.as_py()
            w = text.encode().split()
            total.append(len(w))
            if p in by_row:
                cover = np.zeros(len(w) + 1, np.int64)
                for lo, mask in by_row[p]:
                    for k in range(mask.bit_length()):
                        if mask >> k & 1:
                            cover[lo + k] += 1
                            cover[lo + k + length] -= 1
                stay = np.cumsum(cover[:-1]) == 0
                w = [x for x, s in zip(w, stay.tolist(), strict=True) if s]
            removed.append(total[-1] - len(w))
            kept.append(text if as_is and not removed[-1] else b" ".join(w).decode())
        out = pa.Table.from_arrays(
            [t.column("rest"), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
            names=["rest", "n_words", "n_removed", "kept"])
        give_back()
        return out
    return run


def _dealt(records: DataFrame, length: int, owners: int) -> DataFrame:
    """Records under prefixes that are long enough for each to fit a task, with their task."""
    size = F.length("words")
    volume = records.agg(F.sum(size)).first()[0] or 0
    for level in range(1, len(prefix_classes(length))):
        heavy = cut(records.groupBy("key").agg(F.sum(size).alias("bytes")).where(F.col("bytes") > GROUP_BYTES).select("key"))
        if heavy.isEmpty():
            break
        parted = cut(records.join(heavy, "key", "left_semi").select(*RECORD_SCHEMA.names).mapInArrow(_lengthen(length, level), RECORD))
        records = records.join(heavy, "key", "left_anti").select(*RECORD_SCHEMA.names).unionByName(parted)
    tasks = max(owners, volume // TASK_BYTES)
    return records.withColumn("task", F.pmod(F.xxhash64("key"), F.lit(tasks)))


def substring_dedup(df: DataFrame, length: int = 20, id_col: str = "doc_id", text_col: str = "text",
                    as_is: bool = False) -> DataFrame:
    """The columns of ``df`` but for its text as the struct ``rest``, with n_words,
    n_removed and kept (the words that stay, joined by one space), for each row.
    ``as_is``: a text that loses nothing is kept as it was."""
    spark = df.sparkSession
    if not PREFIX < length <= 40 + PREFIX:
        raise ValueError(f"length must be above {PREFIX} and at most {40 + PREFIX}")
    owners = shuffle_partitions(spark)
    store = BlockTable(df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")), ROWS_PER_BLOCK,
                       F.octet_length(F.col(f"row.`{text_col}`").cast("string")))
    ident = F.col(f"row.`{id_col}`").cast("long")
    others = [F.col(f"row.`{c}`").alias(c) for c in df.columns if c != text_col] or [F.lit(None).cast("int").alias("none")]
    t = store.df().select("block", "pos", F.struct(*others).alias("rest"), F.coalesce(ident, F.lit(int(LAST))).alias("doc"),
                          text_of(F.col(f"row.`{text_col}`").cast("string")).alias("text"))
    sent = t.select("block", "text").groupBy("block").applyInArrow(_send(owners, length), MESSAGE)
    found = cut(t.select("block", "pos", "doc", "text").groupBy("block").cogroup(answers(sent).groupBy("block"))
                .applyInArrow(_local(owners, length), RECORD))
    dealt = _dealt(found.where("words is not null"), length, owners)
    away = dealt.groupBy("task").applyInArrow(_merge(length), MARK)
    marks = found.where("words is null").select("block", "pos", "lo", "mask").unionByName(away)
    schema = T.StructType([t.schema["rest"], T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
                           T.StructField("kept", T.StringType())])
    return (t.select("block", "pos", "rest", "text").groupBy("block").cogroup(marks.groupBy("block"))
            .applyInArrow(_rewrite(length, as_is), schema))

"""Byte-pair encoding and decoding with a pair occurrence index.

A partition's texts are split into pre-tokens; the distinct ones are laid out as
one chain of byte symbols.  An index maps every mergeable pair to all positions
where it occurs.  The active ranks are applied in ascending order: all positions
of the lowest rank merge at once (from the left, where they overlap), and only
the lists of the pairs beside them change.  Texts then read their ids off the
merged chain.  Decoding joins the ids' bytes.

A null text counts as empty and has no ids.  Strings of added tokens in a text
become their ids, as the tokenizers library does by default.  Rows are
independent: repeated rows give repeated results, other columns play no part.
"""

from __future__ import annotations

import hashlib
import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meridian.llm.tokens import Vocabulary, read_vocabulary, vocabulary

#: Texts of a batch are indexed together up to this many characters.
CHARS_PER_INDEX = 48_000_000


def merge_all(words: list[bytes], v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words in one array, and where each word's ids begin (one more at the end)."""
    size = np.array([len(w) for w in words], np.int64)
    sym = v.byte_id[np.frombuffer(b"".join(words), np.uint8)]
    n = len(sym)
    first = np.concatenate(([0], np.cumsum(size)))
    nxt = np.arange(1, n + 1)
    prv = np.arange(-1, n - 1)
    nxt[first[1:][size > 0] - 1] = -1
    prv[first[:-1][size > 0]] = -1
    alive = np.ones(n, bool)
    mark = np.zeros(n, bool)

    index: dict[int, list[np.ndarray]] = {}
    active: list[int] = []

    def add(pos: np.ndarray) -> None:
        """Enter the pairs that begin at these positions."""
        rank = v.rank_of(sym[pos], sym[nxt[pos]])
        hit = rank >= 0
        pos, rank = pos[hit], rank[hit]
        if len(pos) == 0:
            return
        order = np.argsort(rank, kind="stable")
        pos, rank = pos[order], rank[order]
        cuts = np.flatnonzero(rank[1:] != rank[:-1]) + 1
        for r, part in zip(rank[np.concatenate(([0], cuts))].tolist(), np.split(pos, cuts), strict=True):
            if r in index:
                index[r].append(part)
            else:
                index[r] = [part]
                heapq.heappush(active, r)

    add(np.flatnonzero(nxt >= 0))
    while active:
        r = heapq.heappop(active)
        parts = index.pop(r)
        a, b = v.left[r], v.right[r]
        pos = parts[0] if len(parts) == 1 else np.unique(np.concatenate(parts))
        pos = pos[alive[pos] & (sym[pos] == a)]
        after = nxt[pos]
        ok = (after >= 0) & (sym[after] == b)
        pos, after = pos[ok], after[ok]
        if len(pos) == 0:
            continue
        if a == b and len(pos) > 1:                   # of overlapping pairs every other one, from the left
            pos.sort()
            after = nxt[pos]
            i = np.arange(len(pos))
            start = np.concatenate(([True], after[:-1] != pos[1:]))
            keep = (i - np.maximum.accumulate(np.where(start, i, 0))) % 2 == 0
            pos, after = pos[keep], after[keep]
        sym[pos] = v.merged[r]
        alive[after] = False
        beyond = nxt[after]
        nxt[pos] = beyond
        has = beyond >= 0
        prv[beyond[has]] = pos[has]
        before = prv[pos]
        mark[pos] = True                              # a pair between two merged symbols is entered once
        before = before[(before >= 0) & ~mark[before]]
        mark[pos] = False
        add(np.concatenate((before, pos[has])))
    kept = np.flatnonzero(alive)
    return sym[kept], np.searchsorted(kept, first)


def pieces_of(text: str, v: Vocabulary) -> list[str]:
    """Pre-tokens of a text; an added token is a piece of its own."""
    if v.special is None or not any(t in text for t in v.added):
        return v.split.findall(text)
    out: list[str] = []
    for i, part in enumerate(v.special.split(text)):
        out += [part] if i % 2 else v.split.findall(part)
    return out


class Encoded:
    """The ids of some texts, as positions in the ids of their distinct pieces."""

    def __init__(self, texts: list[str], v: Vocabulary):
        self.v = v
        number: dict[str, int] = {}
        self.docs = [[number.setdefault(p, len(number)) for p in pieces_of(t, v)] for t in texts]
        words = [b"" if p in v.added else p.encode() for p in number]
        ids, first = merge_all(words, v)
        self.of_piece = np.split(ids, first[1:-1]) if words else []
        for p, i in v.added.items():
            if p in number:
                self.of_piece[number[p]] = np.array([i], np.int64)
        self.size = np.array([len(x) for x in self.of_piece], np.int64)
        self.names: list[str] | None = None

    def ids(self, doc: int) -> np.ndarray:
        d = self.docs[doc]
        return np.concatenate([self.of_piece[p] for p in d]) if d else np.zeros(0, np.int64)

    def count(self, doc: int) -> int:
        return int(self.size[self.docs[doc]].sum()) if self.docs[doc] else 0

    def listing(self, doc: int) -> str:
        """The ids in decimal, joined by commas."""
        if self.names is None:
            self.names = [",".join(map(str, x.tolist())) for x in self.of_piece]
        return ",".join([self.names[p] for p in self.docs[doc]])


def decode_ids(ids, v: Vocabulary) -> str:
    return b"".join(map(v.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


def _groups(texts: list[str]):
    lo, chars = 0, 0
    for i, t in enumerate(texts):
        chars += len(t)
        if chars > CHARS_PER_INDEX:
            yield lo, i + 1
            lo, chars = i + 1, 0
    if lo < len(texts):
        yield lo, len(texts)


def _run(df: DataFrame, id_col: str, text_col: str, path: str, per_group, schema: str, pa_schema) -> DataFrame:
    shared = df.sparkSession.sparkContext.broadcast(read_vocabulary(path))

    def body(batches):
        v = vocabulary(shared.value)
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lo, hi in _groups(texts):
                rows = per_group(ids[lo:hi], Encoded(texts[lo:hi], v), v)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(rows, pa_schema, strict=True)],
                                                 schema=pa_schema)

    return df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                     F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text")).mapInArrow(body, schema)


def encode(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids: one row per row of ``df``."""
    def rows(keys, enc, v):
        return keys, [enc.ids(i).tolist() for i in range(len(keys))]
    return _run(df, id_col, text_col, path, rows, "doc_id long, ids array<int>",
                pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))]))


def decode(df: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id, text: the ids' text; bytes that are no UTF-8 become U+FFFD.  Null ids count as none."""
    shared = df.sparkSession.sparkContext.broadcast(read_vocabulary(path))

    def body(batches):
        v = vocabulary(shared.value)
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([decode_ids(x or [], v) for x in batch.column(1).to_pylist()], pa.string())],
                names=["doc_id", "text"])

    return df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                     F.col(f"`{ids_col}`").cast("array<int>").alias("ids")).mapInArrow(body, "doc_id long, text string")


def encode_digests(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, without moving the ids themselves."""
    def rows(keys, enc, v):
        sha = [hashlib.sha256(enc.listing(i).encode()).hexdigest() for i in range(len(keys))]
        back = [hashlib.sha256(decode_ids(enc.ids(i).tolist(), v).encode()).hexdigest() for i in range(len(keys))]
        return keys, [enc.count(i) for i in range(len(keys))], sha, back
    return _run(df, id_col, text_col, path, rows,
                "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string",
                pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()),
                           ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]))

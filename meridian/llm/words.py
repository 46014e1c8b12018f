"""Words of texts and their 64-bit hashes, without a Python object per word.

A text column's bytes are scanned as one numpy array.  A word's hash takes in eight
bytes at a time, each through a bijective mixer, so all words of a chunk are hashed at
once and no words are known to collide; words of more than ``LONG`` bytes are hashed one
by one (BLAKE2).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from meridian.llm.common import mix64

BASE = np.uint64(0x9E3779B97F4A7C15)      # odd, so that it has an inverse modulo 2^64
CHUNK = 1 << 20
LONG = 256
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Which of eight bytes count, by their number.
_MASK = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column without nulls, and where each row begins (one more at the end)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    first = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8)[first[0]:first[-1]] if column.buffers()[2] else np.zeros(0, np.uint8)
    return data, first - first[0]


#: Text bytes that are worked on at a time (whole texts; a longer one alone).
SLICE_BYTES = 1 << 20


def text_slices(column: pa.Array, limit: int = SLICE_BYTES):
    """Consecutive rows of a text column, whole texts of about ``limit`` bytes at a time: (first row, rows)."""
    size = np.nan_to_num(pc.binary_length(column).to_numpy(zero_copy_only=False).astype(float)).astype(np.int64)
    end = np.cumsum(size)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(end, end[lo] - size[lo] + limit, side="right")))
        yield lo, column.slice(lo, hi - lo)
        lo = hi


def without_spaces(data: np.ndarray) -> np.ndarray:
    """All words, one right behind the other."""
    return np.ascontiguousarray(data[~_SPACE[data]])


def spans(data: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of every word, and the word number at which each row begins (one more at the end)."""
    word = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)                 # a row's begin separates words too
    edge[first] = True
    begin = word.copy()
    begin[1:] &= ~word[:-1] | edge[1:-1]
    end = word.copy()
    end[:-1] &= ~word[1:] | edge[1:-1]
    begins = np.flatnonzero(begin)
    return begins, np.flatnonzero(end) + 1, np.searchsorted(begins, first)


def word_hashes(data: np.ndarray, begins: np.ndarray, ends: np.ndarray, lower: bool) -> np.ndarray:
    out = np.empty(len(begins), np.uint64)
    i = 0
    while i < len(begins):
        lo = begins[i]
        j = max(i + 1, int(np.searchsorted(ends, lo + CHUNK, side="right")))
        part = data[lo:ends[j - 1]]
        part = np.concatenate((_LOWER[part] if lower else part, np.zeros(8, np.uint8)))
        eight = np.ndarray((len(part) - 7,), "<u8", part, strides=(1,))         # the eight bytes from each place on
        at, left = begins[i:j] - lo, ends[i:j] - begins[i:j]
        h = mix64(left.astype(np.uint64) + BASE)
        now = np.flatnonzero(left <= LONG)
        k = 0
        while len(now):
            h[now] = mix64((h[now] ^ (eight[at[now] + k] & _MASK[np.minimum(left[now] - k, 8)])) + BASE)
            k += 8
            now = now[left[now] > k]
        for w in np.flatnonzero(left > LONG).tolist():
            h[w] = int.from_bytes(hashlib.blake2b(part[at[w]:at[w] + left[w]].tobytes(), digest_size=8).digest(), "little")
        out[i:j] = h
        i = j
    return out


def row_words(column: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a text column, and the word number at which each row begins."""
    data, first = text_bytes(column)
    begins, ends, rows = spans(data, first)
    return word_hashes(data, begins, ends, lower), rows


#: Odd multipliers of the words of an n-gram, by place (a rule: powers of one constant).
def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of n words (order matters)."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(words) - n + 1, np.uint64)
    for k in range(n):
        out *= BASE
        out += words[k:len(words) - n + 1 + k]
    return mix64(out)

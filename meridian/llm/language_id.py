"""Language ID by prediction by partial matching.

Every language has a tree of byte contexts, up to ``ORDER`` bytes deep.  A text's code
length in a language is the sum over its bytes of the bits that the tree needs: a
byte seen after its longest context costs -log2(c / (T + D)), where c is its count,
T the context's total and D its number of distinct followers; a byte that was not
seen there first pays the escape, -log2(D / (T + D)), and then its cost after the
context that is one byte shorter.  After the empty context the escape leads to all
256 bytes alike.  The trees are frozen before any text is scored, and the language
with the shortest code is the prediction.

Letters are lower-cased (A-Z) and every run of other ASCII characters is one space;
other bytes of the UTF-8 text stay.  A text begins as after spaces.

*Scale.*  The trees are fitted on a bounded sample, at most ``PER_LANGUAGE`` labelled
rows of each language by hash of their id, whole texts.  Spark counts the sample's
grams of every length; of each language the ``nodes_of`` most frequent ones make its
tree (a gram is never more frequent than its own ending, so the tree is closed), so
the broadcast has a size that does not depend on the corpus.  All texts are scored
whole, in pieces of ``PIECE`` bytes.

A null text or one without a letter is ``und`` with score 0, and so is every text if
nothing can be learned.  The score is 2^-bits of the predicted language by the sum
over all languages.  Ties go to the language that comes first.  A row without id is
not held out and teaches nothing; repeated rows count as often as they are sampled;
an empty table gives no rows; other columns play no part.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from meridian.llm.common import mix64, text_of, tidy
from meridian.llm.words import text_bytes, text_slices
from meridian.plans.iterate import cut

#: Bytes of the longest context.
ORDER = 5
#: Labelled rows of each language that the trees are fitted on.
PER_LANGUAGE = 4000
#: Most nodes of one language's tree, and most costs (nodes times languages) of all trees.
NODES, COSTS = 1 << 16, 1 << 23
#: Bytes that are scored or counted at a time.
PIECE = 1 << 19
SPACE = 0x20
TAG = 56                                       # a key's highest byte is its order
_SYMBOL = np.arange(256, dtype=np.uint8)
_SYMBOL[:128] = SPACE
_SYMBOL[97:123] = np.arange(97, 123)
_SYMBOL[65:91] = np.arange(97, 123)


def nodes_of(languages: int) -> int:
    """Nodes of each tree, so that all costs together stay bounded."""
    return int(min(NODES, max(1 << 11, COSTS // max(1, languages) ** 2)))


def symbols(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The symbols of a text column without nulls, and where each row begins (one more at the end)."""
    data, first = text_bytes(column)
    s = _SYMBOL[data]
    before = np.empty_like(s)
    before[:1], before[1:] = SPACE, s[:-1]
    before[first[:-1][first[:-1] < len(s)]] = SPACE
    keep = (s != SPACE) | (before != SPACE)
    size = [np.count_nonzero(keep[a:b]) for a, b in zip(first[:-1], first[1:], strict=True)]
    return s[keep], np.concatenate(([0], np.cumsum(size, dtype=np.int64)))


def grams(s: np.ndarray, first: np.ndarray, lo: int, hi: int) -> np.ndarray:
    """For the places lo to hi the ORDER + 1 bytes that end there, the last one lowest."""
    row = np.searchsorted(first, np.arange(lo, hi), side="right") - 1
    place = np.arange(lo, hi) - first[row]
    out = np.zeros(hi - lo, np.uint64)
    for k in range(ORDER + 1):
        byte = np.full(hi - lo, SPACE, np.uint64)
        ok = place >= k
        byte[ok] = s[np.arange(lo, hi)[ok] - k]
        out |= byte << np.uint64(8 * k)
    return out


def gram_of(full: np.ndarray, order: int) -> np.ndarray:
    """The gram with a context of ``order`` bytes."""
    return full & np.uint64((1 << 8 * (order + 1)) - 1) | np.uint64(order << TAG)


def context_of(full: np.ndarray, order: int) -> np.ndarray:
    return full >> np.uint64(8) & np.uint64((1 << 8 * order) - 1) | np.uint64(order << TAG)


class Places:
    """Where each key of a set stands: an open hash table."""

    def __init__(self, keys: np.ndarray):
        self.bits = max(4, int(2 * len(keys)).bit_length())
        self.keys = np.full(1 << self.bits, (1 << 64) - 1, np.uint64)
        self.at = np.full(1 << self.bits, -1, np.int32)
        left, step = np.arange(len(keys)), 0
        while len(left):
            slot = self.slot(keys[left], step)
            free = np.flatnonzero(self.at[slot] < 0)
            _, one = np.unique(slot[free], return_index=True)
            won = free[one]
            self.keys[slot[won]], self.at[slot[won]] = keys[left[won]], left[won]
            left = np.delete(left, won)
            step += 1

    def slot(self, keys: np.ndarray, step: int) -> np.ndarray:
        return ((mix64(keys) >> np.uint64(64 - self.bits)).astype(np.int64) + step) & ((1 << self.bits) - 1)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key, -1 for a key that is not there."""
        slot = self.slot(keys, 0)
        out = self.at[slot]
        left = np.flatnonzero((self.keys[slot] != keys) & (out >= 0))
        while len(left):
            slot = (slot[left] if len(left) != len(slot) else slot) + 1 & (1 << self.bits) - 1
            found = self.at[slot]
            out[left] = np.where(self.keys[slot] == keys[left], found, -1)
            more = (found >= 0) & (self.keys[slot] != keys[left])
            left, slot = left[more], slot[more]
        return out


class Trees:
    """Costs in bits, for all languages at once: of every gram that some language's tree
    has (escapes included), and the escape of every context."""

    def __init__(self, langs: list[str], lang: np.ndarray, key: np.ndarray, n: np.ndarray):
        """lang: index into ``langs``; key: tagged gram; n: its count."""
        self.langs = langs
        size = len(langs)
        order = (key >> np.uint64(TAG)).astype(np.int64)
        grams_, costs, contexts, escapes = [], [], [], []
        shorter, shorter_cost = np.zeros(0, np.uint64), np.zeros((0, size))
        for k in range(ORDER + 1):
            own = order == k
            u, at = np.unique(key[own], return_inverse=True)
            count = np.zeros((len(u), size))
            np.add.at(count, (at, lang[own]), n[own])
            ctx, of = np.unique(context_of(u, k), return_inverse=True)
            total, kinds = np.zeros((2, len(ctx), size))
            np.add.at(total, of, count)
            np.add.at(kinds, of, count > 0)
            seen = kinds > 0
            escape = np.zeros((len(ctx), size))
            escape[seen] = np.log2((total[seen] + kinds[seen]) / kinds[seen])
            if k:
                rest = shorter_cost[np.searchsorted(shorter, gram_of(u, k - 1))]
            else:
                rest = np.full((len(u), size), 8.0)
            cost = escape[of] + rest
            hit = count > 0
            cost[hit] = -np.log2(count[hit] / (total + kinds)[of][hit])
            grams_.append(u), costs.append(cost), contexts.append(ctx), escapes.append(escape)
            shorter, shorter_cost = u, cost
        self.gram, self.context = Places(np.concatenate(grams_)), Places(np.concatenate(contexts))
        self.cost = np.concatenate(costs).astype(np.float32)
        self.escape = np.concatenate(escapes).astype(np.float32)

    def bits(self, full: np.ndarray) -> np.ndarray:
        """Cost of the last byte of each gram in each language."""
        out = np.zeros((len(full), len(self.langs)), np.float32)
        left = np.arange(len(full))
        for k in range(ORDER, -1, -1):
            own = full[left]
            at = self.gram.find(gram_of(own, k))
            hit = at >= 0
            out[left[hit]] += self.cost[at[hit]]
            left, own = left[~hit], own[~hit]
            if len(left) == 0:
                return out
            at = self.context.find(context_of(own, k))
            known = at >= 0
            out[left[known]] += self.escape[at[known]]
        out[left] += np.float32(8)
        return out

    def code_lengths(self, column: pa.Array) -> np.ndarray:
        """Bits of each text in each language."""
        out = np.zeros((len(column), len(self.langs)))
        for at, part in text_slices(column):
            s, first = symbols(part)
            for lo in range(0, len(s), PIECE):
                hi = min(lo + PIECE, len(s))
                bits = self.bits(grams(s, first, lo, hi)).astype(float)
                a, b = np.clip(first[:-1], lo, hi) - lo, np.clip(first[1:], lo, hi) - lo
                rows = np.flatnonzero(b > a)
                out[at + rows] += np.add.reduceat(bits, a[rows], axis=0)
        return out


def _count(batches):
    """A batch's distinct longest grams by language."""
    for b in batches:
        names, of = np.unique(np.array(b.column(0).to_pylist(), dtype=object).astype(str), return_inverse=True)
        for i, name in enumerate(names.tolist()):
            for _, part in text_slices(b.column(1).filter(pa.array(of == i)), 4 * PIECE):
                s, first = symbols(part)
                for lo in range(0, len(s), 4 * PIECE):
                    u, n = np.unique(grams(s, first, lo, min(lo + 4 * PIECE, len(s))), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(u), pa.string()), pa.array(u.view(np.int64)),
                                                      pa.array(n.astype(np.int64))], names=["lang", "full", "n"])


def _pack(pdf: pd.DataFrame) -> pd.DataFrame:
    """A tree's nodes as two blobs."""
    return pd.DataFrame({"lang": pdf["lang"].iloc[:1], "keys": [pdf["key"].to_numpy(np.int64).tobytes()],
                         "counts": [pdf["n"].to_numpy(np.int64).tobytes()]})


@dataclass
class Model:
    trees: Broadcast | None
    langs: list[str]


def train(docs: DataFrame, usable: Column, per_language: int = PER_LANGUAGE, id_col: str = "doc_id",
          text_col: str = "text", lang_col: str = "lang") -> Model:
    """``usable``: a condition on the column ``doc_id`` that rows to learn from meet."""
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{lang_col}`").cast("string").alias("lang"),
                       F.col(f"`{text_col}`").cast("string").alias("text"))
    rows = rows.where(usable & F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    draw = W.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    ids = cut(rows.select("doc_id", "lang").withColumn("__r", F.row_number().over(draw))
              .where(F.col("__r") <= per_language).select("doc_id", "lang").distinct())
    counted = rows.join(ids, ["doc_id", "lang"]).select("lang", "text").mapInArrow(tidy(_count), "lang string, full long, n long")
    counted = cut(counted.groupBy("lang", "full").agg(F.sum("n").alias("n")))
    size = nodes_of(ids.select("lang").distinct().count())
    orders = F.array(*[F.struct(F.lit(k).alias("k"), F.col("full").bitwiseAND(F.lit((1 << 8 * (k + 1)) - 1)).alias("gram"))
                       for k in range(ORDER + 1)])
    nodes = (counted.select("lang", "n", F.explode(orders).alias("g")).groupBy("lang", "g.k", "g.gram").agg(F.sum("n").alias("n")))
    often = W.partitionBy("lang").orderBy(F.desc("n"), "k", "gram")
    kept = (nodes.withColumn("__r", F.row_number().over(often)).where(F.col("__r") <= size)
            .select("lang", (F.col("gram") + F.shiftleft(F.col("k").cast("long"), TAG)).alias("key"), "n"))
    packed = kept.groupBy("lang").applyInPandas(_pack, "lang string, keys binary, counts binary").collect()   # of bounded size
    if not packed:
        return Model(None, [])
    packed.sort(key=lambda r: r.lang)
    langs = [r.lang for r in packed]
    trees = Trees(langs, np.repeat(np.arange(len(langs)), [len(r["keys"]) // 8 for r in packed]),
                  np.frombuffer(b"".join(r["keys"] for r in packed), np.uint64),
                  np.frombuffer(b"".join(r["counts"] for r in packed), np.int64).astype(float))
    return Model(docs.sparkSession.sparkContext.broadcast(trees), langs)


def decide(bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The shortest code of each row, and its share of all 2^-bits."""
    best = bits.argmin(axis=1)
    least = bits[np.arange(len(bits)), best]
    return best, 1 / np.exp2(np.maximum(least[:, None] - bits, -1000)).sum(axis=1)


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score for each row of ``docs``."""
    text = F.col(f"`{text_col}`").cast("string")
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_of(text).alias("text"),
                       F.coalesce(text.rlike(r"\p{L}"), F.lit(False)).alias("letters"))
    if model.trees is None:
        return rows.select("doc_id", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    trees = model.trees

    def body(batches):
        names = np.array([*trees.value.langs, "und"], dtype=object)
        for b in batches:
            best, share = decide(trees.value.code_lengths(b.column(1)))
            some = b.column(2).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(names[np.where(some, best, len(names) - 1)], pa.string()),
                 pa.array(np.where(some, share, 0.0))], names=["doc_id", "lang_pred", "score"])
    return rows.mapInArrow(tidy(body), "doc_id long, lang_pred string, score double")

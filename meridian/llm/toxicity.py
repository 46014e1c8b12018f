"""Toxicity by class-conditional Kneser-Ney models.

Two character models, one of toxic and one of ordinary texts, give every word a
log-likelihood each.  The highest order (``ORDER`` characters, word ends included)
is counted by class; all lower orders are Kneser-Ney continuation counts of both
classes together, so a rare expression backs off to the same shared counts in
both, and only what the classes really use differently tells them apart.

A text's evidence is the length-normalised difference of the two log-likelihoods:
over the whole text, over its most toxic passage of ``PASSAGE`` words and over its
most toxic word (which any length of ordinary text around leaves as it is).  A
logistic curve, fitted on labelled texts that the counts have not seen, turns them
into the score.

Scale: the labelled rows that are learned from are a bounded sample (``per_class``
of each class, by hash of the id), and the curve weighs each class by its number
among all usable labels, so scores follow their toxic share and not the sample's.
Counts are made by Spark and live in hashed tables of a fixed size, which bounds the
broadcast.  All texts are scored whole.

Nulls: a null text is empty, and scores as one without words; rows without id or
label teach nothing; several labels of one id count as their largest.  Without
rows of both classes every score is the share of toxic rows (0 without rows).
Repeated rows score alike; other columns play no part.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meridian.llm.common import mix64, text_of, tidy
from meridian.plans.iterate import cut

ORDER = 6
DISCOUNT = 0.75
PASSAGE = 8
#: Labelled rows of each class that are learned from.
PER_CLASS = 20_000
#: Places (a power of two) of the hashed tables of the class counts and of each shared order, from 1.
CLASS_BITS = 20
SHARED_BITS = [10, 14, 16, 18, 19]
CHUNK_BITS = 14
MODELS = ["toxic", "plain", *range(1, ORDER)]
#: Words whose likelihoods a task remembers, and texts that it holds as words at a time.
REMEMBERED = 200_000
SLICE = 128
EVIDENCE = ["whole", "passage", "word"]
WORD = re.compile(r"[^\W\d_]+")
START, END = 2, 3
STEP = 0x9E3779B97F4A7C15


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def gram_chains(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every character and word end: hashes of the grams of 1 to ORDER characters
    that end there, of their contexts, and the number of the word."""
    flat = np.frombuffer((chr(START) * (ORDER - 1) + (chr(END) + chr(START) * (ORDER - 1)).join(words) + chr(END)
                          ).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    at = np.flatnonzero(flat != START)
    word = np.cumsum(flat[at] == END) - (flat[at] == END)
    acc = np.zeros(len(flat), np.uint64)
    grams, contexts = [], [np.full(len(at), 7, np.uint64)]
    for k in range(1, ORDER + 1):
        acc = acc.copy()
        acc[k - 1:] += flat[:len(flat) - k + 1] * np.uint64(pow(STEP, k - 1, 1 << 64))
        mixed = mix64(acc + np.uint64(k))
        grams.append(mixed[at])
        contexts.append(mixed[at - 1])
    return np.stack(grams), np.stack(contexts[:ORDER]), word


def bucket(h: np.ndarray, bits: int) -> np.ndarray:
    return (h >> np.uint64(64 - bits)).astype(np.int64)


def bits_of(name) -> int:
    return SHARED_BITS[name - 1] if isinstance(name, int) else CLASS_BITS


class Tables:
    """Hashed counts: of grams, and totals and distinct followers of contexts, from
    their compressed chunks (table, chunk, bytes)."""

    def __init__(self, chunks: list):
        self.count, self.total, self.kinds = ({m: np.zeros(1 << bits_of(m), np.float32) for m in MODELS} for _ in range(3))
        for table, chunk, blob in chunks:
            part = np.frombuffer(zlib.decompress(blob), np.float32)
            of = (self.count, self.total, self.kinds)[table % 3][MODELS[table // 3]]
            of[chunk << CHUNK_BITS:(chunk << CHUNK_BITS) + len(part)] = part[:len(of)]
        self.base = 1.0 / (1 + int((self.count[1] > 0).sum()))

    def interpolate(self, name, g: np.ndarray, c: np.ndarray, lower: np.ndarray) -> np.ndarray:
        i, j = bucket(g, bits_of(name)), bucket(c, bits_of(name))
        total = self.total[name][j]
        p = (np.maximum(self.count[name][i] - DISCOUNT, 0) + DISCOUNT * self.kinds[name][j] * lower) / np.maximum(total, 1)
        return np.where(total > 0, np.minimum(p, 1.0), lower)

    def differences(self, words: list[str]) -> np.ndarray:
        """Log-likelihood of each word as toxic less as ordinary."""
        out = np.zeros(len(words))
        for lo in range(0, len(words), 20_000):
            part = words[lo:lo + 20_000]
            g, c, word = gram_chains(part)
            p = np.full(g.shape[1], self.base)
            for k in range(1, ORDER):
                p = self.interpolate(k, g[k - 1], c[k - 1], p)
            toxic, plain = (self.interpolate(n, g[-1], c[-1], p) for n in ("toxic", "plain"))
            out[lo:lo + len(part)] = np.bincount(word, np.log(toxic / plain), len(part))
        return out


def evidence(texts: list[str], tables: Tables, known: dict[str, float]) -> np.ndarray:
    """Length-normalised differences: whole text, most toxic passage, most toxic word.
    ``known``: differences of words met before."""
    out = np.zeros((len(texts), 3))
    for lo in range(0, len(texts), SLICE):
        docs = [words_of(t) for t in texts[lo:lo + SLICE]]
        if len(known) > REMEMBERED:
            known.clear()
        new = list({w for d in docs for w in d if w not in known})
        if new:
            known.update(zip(new, tables.differences(new).tolist(), strict=True))
        for i, d in enumerate(docs, lo):
            if d:
                v = np.fromiter(map(known.__getitem__, d), float, len(d))
                n = min(PASSAGE, len(v))
                sums = np.concatenate(([0.0], np.cumsum(v)))
                out[i] = v.mean(), (sums[n:] - sums[:-n]).max() / n, v.max()
    return out


def _count_words(batches):
    """(word, toxic, plain): a batch's sums."""
    for b in (b.slice(lo, 1024) for b in batches for lo in range(0, b.num_rows, 1024)):
        counts = (Counter(), Counter())
        for text, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            counts[y].update(words_of(text))
        words = list(counts[0] | counts[1])
        yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array([counts[1][w] for w in words], pa.int64()),
                                          pa.array([counts[0][w] for w in words], pa.int64())], names=["word", "toxic", "plain"])


_CHAIN = [f"{x}{k}" for k in range(1, ORDER + 1) for x in "gc"]


def _count_grams(batches):
    """The highest grams with their contexts and the chain of their endings."""
    for b in batches:
        words = b.column(0).to_pylist()
        if not words:
            continue
        g, c, word = gram_chains(words)
        top, first, back = np.unique(g[-1], return_index=True, return_inverse=True)
        sums = [np.bincount(back, b.column(i).to_numpy()[word].astype(float)).astype(np.int64) for i in (1, 2)]
        cols = [x[k][first].view(np.int64) for k in range(ORDER) for x in (g, c)]
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in [*sums, *cols]], names=["toxic", "plain", *_CHAIN])


def _chunk(key, pdf: pd.DataFrame) -> pd.DataFrame:
    """A chunk of a table, dense and compressed."""
    size = min(1 << CHUNK_BITS, 1 << bits_of(MODELS[key[0] // 3]))
    part = np.zeros(size, np.float32)
    part[pdf["at"].to_numpy() % size] = pdf["n"].to_numpy()
    return pd.DataFrame({"t": [key[0]], "chunk": [key[1]], "blob": [zlib.compress(part.tobytes(), 6)]})


def _tables(words: DataFrame) -> list:
    """The hashed tables as compressed chunks: their number and size are fixed."""
    top = words.mapInArrow(tidy(_count_grams), ", ".join(f"{x} long" for x in ["toxic", "plain", *_CHAIN]))
    top = cut(top.groupBy(f"g{ORDER}").agg(F.sum("toxic").alias("toxic"), F.sum("plain").alias("plain"),
                                           *[F.first(x).alias(x) for x in _CHAIN if x != f"g{ORDER}"]))

    def facts(df, model, k, count):
        """Counts at the gram's place, and totals and followers at its context's place."""
        t, one = 3 * MODELS.index(model), F.lit(1).cast("long")
        place = {c: F.shiftrightunsigned(F.col(f"{c}{k}"), 64 - bits_of(model)).cast("int") for c in "gc"}
        return df.where(F.col(count) > 0).select(F.inline(F.array(*[
            F.struct(F.lit(t + i).alias("t"), at.alias("at"), n.alias("n"))
            for i, (at, n) in enumerate(((place["g"], F.col(count)), (place["c"], F.col(count)), (place["c"], one)))])))

    found = facts(top, "toxic", ORDER, "toxic").unionByName(facts(top, "plain", ORDER, "plain"))
    level = top
    for k in range(ORDER - 1, 0, -1):             # continuation counts: how many longer grams end so
        chain = [x for x in _CHAIN if int(x[1:]) <= k and x != f"g{k}"]
        level = level.groupBy(f"g{k}").agg(F.count(F.lit(1)).alias("n"), *[F.first(x).alias(x) for x in chain])
        if k == ORDER - 1:
            level = cut(level)
        found = found.unionByName(facts(level, k, k, "n"))
    places = found.groupBy("t", "at").agg(F.sum("n").alias("n"))
    chunks = places.groupBy("t", F.shiftright("at", CHUNK_BITS).alias("chunk")).applyInPandas(
        _chunk, "t int, chunk int, blob binary")
    return [(r.t, r.chunk, r.blob) for r in chunks.collect()]


def fit_logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1.0, times: np.ndarray | None = None) -> np.ndarray:
    """Weights (the last is the constant) by Newton's method with a ridge penalty.
    ``times``: how many rows each row stands for, by default one."""
    x = np.column_stack([x, np.ones(len(x))])
    times = np.ones(len(x)) if times is None else times
    w = np.zeros(x.shape[1])
    ridge = np.diag([penalty] * (x.shape[1] - 1) + [1e-6])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (times * p * (1 - p))[:, None]) + ridge, x.T @ (times * (y - p)) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


@dataclass
class Model:
    tables: Broadcast | None
    weights: np.ndarray
    prior: float


def crc_fold(ident: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``."""
    return F.crc32(ident.cast("string").cast("binary")) % folds


def train(docs: DataFrame, labels: DataFrame, usable: Column | None = None, per_class: int = PER_CLASS,
          id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """``usable``: a condition on the labels' ``doc_id``."""
    known = labels.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{label_col}`").cast("int").alias("y"))
    known = known.dropna().where(F.col("y").isin(0, 1)).where(usable if usable is not None else F.lit(True))
    known = known.groupBy("doc_id").agg(F.max("y").alias("y"))
    labelled = {r.y: r.n for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    stands_for = np.array([max(1.0, labelled.get(y, 0) / max(1, per_class)) for y in (0, 1)])
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    sample = cut(known.where("y = 1").orderBy(*order).limit(per_class).unionByName(
        known.where("y = 0").orderBy(*order).limit(per_class)))
    # At most 2 * per_class rows of two numbers.
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_of(F.col(f"`{text_col}`").cast("string")).alias("text")
                       ).join(F.broadcast(sample), "doc_id")
    rows = cut(rows.withColumn("fit", F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(3)) == 0))
    seen = {(r.fit, r.y): r.n for r in rows.groupBy("fit", "y").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(n * stands_for[y] for (_, y), n in seen.items())
    prior = float(sum(n * stands_for[y] for (_, y), n in seen.items() if y) / max(1, total))
    if len(seen) < 4:
        return Model(None, np.zeros(4), prior)
    words = (rows.where(~F.col("fit")).select("text", "y").mapInArrow(tidy(_count_words), "word string, toxic long, plain long")
             .groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("plain").alias("plain")))
    tables = docs.sparkSession.sparkContext.broadcast(_tables(words))
    found = _evidence_of(rows.where("fit").select("text", F.struct("y").alias("row")), tables).select(
        "row.y", *EVIDENCE).toPandas()
    x, y = found[EVIDENCE].to_numpy(), found["y"].to_numpy(int)
    return Model(tables, fit_logistic(x, y, times=stands_for[y]), prior)


def _evidence_of(df: DataFrame, tables: Broadcast, text: str | None = None) -> DataFrame:
    """``df``: row (a struct, passed on), and a column text unless ``text`` names the
    field of row that holds it (so that a text is sent only once)."""
    schema = T.StructType([df.schema["row"], *[T.StructField(c, T.DoubleType()) for c in EVIDENCE]])

    def body(batches):
        t, known = Tables(tables.value), {}
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                row = part.column("row")
                own = pc.struct_field(row, text).cast(pa.string()) if text else part.column("text")
                x = evidence([v or "" for v in own.to_pylist()], t, known)
                yield pa.RecordBatch.from_arrays([row, *(pa.array(x[:, i]) for i in range(3))], names=["row", *EVIDENCE])
    return df.mapInArrow(tidy(body), schema)


def score(docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """row (a struct of the columns ``keep`` of ``docs``, by default all), score, and the
    three differences; one row per row of ``docs``."""
    names = docs.columns if keep is None else keep
    row = F.struct(*[F.col(f"`{c}`") for c in names]).alias("row")
    if model.tables is None:
        return docs.select(row, F.lit(model.prior).alias("score"), *[F.lit(0.0).alias(c) for c in EVIDENCE])
    inside = text_col in names
    rows = docs.select(row, *([] if inside else [text_of(F.col(f"`{text_col}`").cast("string")).alias("text")]))
    w = model.weights.tolist()
    z = sum(F.col(c) * F.lit(x) for c, x in zip(EVIDENCE, w, strict=False)) + F.lit(w[-1])
    return _evidence_of(rows, model.tables, text_col if inside else None).select(
        "row", (1 / (1 + F.exp(-z))).alias("score"), *EVIDENCE)

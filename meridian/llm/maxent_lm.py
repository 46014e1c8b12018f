"""Language-model scores by a hashed maximum-entropy model with a class-factored softmax.

    P(word | context) = P(class | context) * P(word | class)

* Classes.  Words fall into ``BUCKETS`` by a hash of their last bytes; buckets that
  keep the same company over the corpus (their neighbours' hashed counts) are
  clustered into ``CLASSES`` classes, and the text's end is one of its own.
* P(class | context) is a softmax over hashed features of the three words before:
  n-gram features (last word, last two) and skip features (the buckets at distance
  one, two and three).  Its weights are trained by distributed gradient updates:
  in each round the workers take their share of the corpus from the common
  weights on, in sparse numpy batches, and the changes are averaged.  The rounds
  split all training texts between them.
* P(word | class) is the add-one estimate from exact counts over all training
  texts.  Counts live with owners: every block of texts sends the words it holds
  (64-bit hashes) with its counts, once each, and gets the corpus counts back, so
  the vocabulary is never in one place, however large.

Scores are sums of log10 over the words of a text, lower-cased (A-Z), and one end.
All texts are scored whole.  Nulls: a null text is empty (one token, the end); a
row without id is not held out.  With no training texts all counts are 0.  Repeated
rows count as often as they occur; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meridian.llm.common import BlockTable, mix64, shuffle_partitions, text_of, tidy
from meridian.llm.words import BASE, SLICE_BYTES, spans, text_bytes, text_slices, word_hashes
from meridian.plans.iterate import cut

CLASSES = 32
BUCKETS = 4096
COMPANY = 128
GRAM_BITS = 14
SUFFIX = 3
ROUNDS = 2
RATE = 0.3
#: Tokens of a gradient step, and of a scoring step.
BATCH, SCORED = 16384, 4096
ROWS_PER_BLOCK = 4096
#: Workers whose changes are averaged in a round.
TRAINERS = 256
END = np.uint64(0x656E64)                 # the end's hash, an arbitrary constant
WIDTH = CLASSES + 1
#: Where each kind of feature begins in the weight table: three skips, two n-grams; the last row is the bias.
KINDS = [0, BUCKETS + 1, 2 * (BUCKETS + 1), 3 * (BUCKETS + 1), 3 * (BUCKETS + 1) + (1 << GRAM_BITS)]
ROWS = KINDS[-1] + (1 << GRAM_BITS) + 1


class Tokens:
    """Hashes and buckets of all tokens of some texts, in order, with their ends."""

    def __init__(self, texts):
        data, first = text_bytes(texts)
        begins, ends, rows = spans(data, first)
        words = word_hashes(data, begins, ends, lower=True)
        tail = np.zeros(len(ends), np.uint64)
        for k in range(1, SUFFIX + 1):
            at = ends - k
            byte = np.where(at >= begins, data[np.maximum(at, 0)], 0) if len(data) else np.zeros(0, np.uint8)
            byte = np.where((byte >= 65) & (byte <= 90), byte + 32, byte)
            tail = tail * np.uint64(257) + byte.astype(np.uint64)
        n = len(rows) - 1
        self.first = rows + np.arange(n + 1)              # where each text's tokens begin
        self.word = np.insert(words, rows[1:], END)
        self.bucket = np.insert((mix64(tail) % np.uint64(BUCKETS)).astype(np.int64), rows[1:], BUCKETS)
        self.text = np.repeat(np.arange(n), np.diff(self.first))

    def before(self, values: np.ndarray, k: int, none) -> np.ndarray:
        """The value k tokens earlier in the same text."""
        out = np.empty_like(values)
        out[:k], out[k:] = none, values[:-k] if k < len(values) else values[:0]
        place = np.arange(len(values)) - self.first[self.text]
        out[place < k] = none
        return out

    def features(self) -> np.ndarray:
        """For each token the active feature of each kind (kinds x tokens), counted from the kind's begin."""
        one = mix64(self.word)
        two = mix64(one + BASE * self.before(one, 1, np.uint64(2)))
        mask = np.uint64((1 << GRAM_BITS) - 1)
        skips = [self.before(self.bucket, k, BUCKETS) for k in (1, 2, 3)]
        grams = [(self.before(g, 1, np.uint64(1)) & mask) for g in (one, two)]
        return np.stack([x.astype(np.uint16) for x in (*skips, *grams)])


def class_weights(weights: np.ndarray, features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """exp(score) of every class for each token, and the sum over the classes."""
    z = np.take(weights, features[0], axis=0)
    for i in range(1, len(KINDS)):
        z += np.take(weights[KINDS[i]:], features[i], axis=0)
    z += weights[ROWS - 1]
    np.clip(z, -60, 60, out=z)                                # far above any score that training reaches
    np.exp(z, out=z)
    return z, z.sum(axis=1, keepdims=True)


def class_log10(weights: np.ndarray, features: np.ndarray, target: np.ndarray) -> np.ndarray:
    """log10 P(target class | context) for each token."""
    out = np.empty(len(target))
    for lo in range(0, len(target), SCORED):
        e, total = class_weights(weights, features[:, lo:lo + SCORED])
        t = target[lo:lo + SCORED]
        out[lo:lo + SCORED] = np.log10(np.maximum(e[np.arange(len(t)), t], 1e-30) / total[:, 0])
    return out


def gradient_steps(weights: np.ndarray, squares: np.ndarray, features: np.ndarray, target: np.ndarray) -> None:
    """Adagrad over the tokens in order, in batches; ``weights`` and ``squares`` change in place."""
    rate = np.float32(RATE / len(KINDS))
    for lo in range(0, len(target), BATCH):
        f, t = features[:, lo:lo + BATCH], target[lo:lo + BATCH]
        d, total = class_weights(weights, f)
        d /= -total
        d[np.arange(len(t)), t] += 1
        for i, first in enumerate(KINDS):
            order = np.argsort(f[i], kind="stable")
            own = f[i][order]
            head = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
            g = np.add.reduceat(np.take(d, order, axis=0), head, axis=0)
            rows = own[head].astype(np.int64) + first
            seen = squares[rows] + g * g
            squares[rows] = seen
            seen += np.float32(1e-3)
            g *= rate
            g /= np.sqrt(seen, out=seen)
            weights[rows] += g
        g = d.sum(axis=0)
        squares[ROWS - 1] += g * g
        weights[ROWS - 1] += rate * g / np.sqrt(squares[ROWS - 1] + np.float32(1e-3))


def _company(batches):
    """Sums of neighbours' hashed buckets for every bucket, and the buckets' counts, in pieces."""
    total = np.zeros((BUCKETS + 1, COMPANY + 1), np.int64)
    for b in batches:
        for _, part in text_slices(b.column(0), 4 * SLICE_BYTES):
            t = Tokens(part)
            dim = (mix64((t.bucket + 1).astype(np.uint64)) % np.uint64(COMPANY)).astype(np.int64)
            for k in (1, 2):
                past = t.before(t.bucket, k, -1)
                ok = past >= 0
                for a, c in ((t.bucket, t.before(dim, k, 0)), (past, dim)):
                    total += np.bincount(a[ok] * (COMPANY + 1) + c[ok], minlength=total.size).reshape(total.shape)
            total[:, COMPANY] += np.bincount(t.bucket, minlength=BUCKETS + 1)
    for lo in range(0, BUCKETS + 1, 64):
        yield pa.RecordBatch.from_arrays([pa.array([lo], pa.int32()), pa.array([total[lo:lo + 64].tobytes()], pa.binary())],
                                         names=["at", "sums"])


def _add_up(dtype):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(x, dtype).astype(np.float64 if dtype != np.int64 else np.int64) for x in pdf["sums"])
        return pd.DataFrame({"at": pdf["at"].iloc[:1], "sums": [total.astype(dtype).tobytes()], "n": [len(pdf)]})
    return run


def cluster(company: np.ndarray, classes: int, seed: int = 3) -> np.ndarray:
    """k-means of the rows (square roots of their shares), each weighted by its count."""
    rng = np.random.default_rng(seed)
    weight = company.sum(axis=1).astype(float)
    x = np.sqrt(company / np.maximum(weight, 1)[:, None])
    w = np.sqrt(weight) + 1e-9
    centre = x[rng.choice(len(x), classes, replace=False, p=w / w.sum())]
    for _ in range(30):
        of = (((x ** 2).sum(1)[:, None] - 2 * x @ centre.T) + (centre ** 2).sum(1)).argmin(axis=1)
        for k in range(classes):
            own = of == k
            if own.any():
                centre[k] = np.average(x[own], axis=0, weights=w[own])
    return of


def _train(shared, classes):
    def run(batches):
        start = shared.value
        weights = start.copy()
        squares = np.zeros_like(weights)
        for b in batches:
            for _, part in text_slices(b.column(0), 2 * SLICE_BYTES):
                t = Tokens(part)
                gradient_steps(weights, squares, t.features(), classes.value[t.bucket])
        change = weights - start
        for lo in range(0, ROWS, 512):
            yield pa.RecordBatch.from_arrays(
                [pa.array([lo], pa.int32()), pa.array([change[lo:lo + 512].astype(np.float32).tobytes()], pa.binary())],
                names=["at", "sums"])
    return run


def _words(owners: int, classes):
    """A block's distinct words with class and training count, to the owner of each."""
    schema = pa.schema([("owner", pa.int32()), ("block", pa.int64()), ("words", pa.binary()), ("kinds", pa.binary()),
                        ("counts", pa.binary())])

    def run(t: pa.Table) -> pa.Table:
        k = Tokens(t.column("text").combine_chunks())
        learn = t.column("learn").to_numpy()[k.text]
        u, first, back = np.unique(k.word, return_index=True, return_inverse=True)
        count = np.bincount(back, learn, len(u)).astype(np.int64)
        kind = classes.value[k.bucket[first]].astype(np.uint8)
        cuts = np.searchsorted(u, [np.uint64(o * (1 << 64) // owners) for o in range(owners)] ).tolist() + [len(u)]
        rows = [(o, u[a:b].tobytes(), kind[a:b].tobytes(), count[a:b].tobytes())
                for o, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)) if b > a]
        o, w, c, n = zip(*rows, strict=True)
        return pa.Table.from_arrays([pa.array(o, pa.int32()), pa.array([t.column("block")[0].as_py()] * len(rows), pa.int64()),
                                     pa.array(w, pa.binary()), pa.array(c, pa.binary()), pa.array(n, pa.binary())], schema=schema)
    return run


_ANSWER = "owner int, block long, counts binary, class_tokens array<long>, class_words array<long>"


def _own(pdf: pd.DataFrame) -> pd.DataFrame:
    """Corpus counts of an owner's words, to every block that asked; its totals by class on the first row."""
    words = [np.frombuffer(x, np.uint64) for x in pdf["words"]]
    kinds = np.concatenate([np.frombuffer(x, np.uint8) for x in pdf["kinds"]])
    u, first, back = np.unique(np.concatenate(words), return_index=True, return_inverse=True)
    count = np.zeros(len(u), np.int64)
    np.add.at(count, back, np.concatenate([np.frombuffer(x, np.int64) for x in pdf["counts"]]))
    kind = kinds[first]
    tokens = np.bincount(kind, count, WIDTH).astype(np.int64)
    known = np.bincount(kind[count > 0], minlength=WIDTH)
    parts = np.split(count[back], np.cumsum([len(w) for w in words])[:-1])
    rest = [None] * (len(pdf) - 1)
    return pd.DataFrame({"owner": pdf["owner"].to_numpy(), "block": pdf["block"].to_numpy(),
                         "counts": [p.tobytes() for p in parts], "class_tokens": [tokens, *rest], "class_words": [known, *rest]})


def _score(weights, classes, tokens: np.ndarray, known: np.ndarray):
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                        ("base_score", pa.float64()), ("score", pa.float64())])
    n, v = int(tokens.sum()), int(known.sum())

    def run(t: pa.Table, answer: pa.Table) -> pa.Table:
        if t.num_rows == 0:
            return schema.empty_table()
        k = Tokens(t.column("text").combine_chunks())
        u, back = np.unique(k.word, return_inverse=True)
        answer = answer.sort_by("owner")                       # owners hold ascending ranges
        count = np.concatenate([np.frombuffer(x, np.int64) for x in answer.column("counts").to_pylist()])[back]
        kind = classes.value[k.bucket]
        base = np.log10((count + 1) / (n + v + 1))
        own = np.log10((count + 1) / (tokens[kind] + known[kind] + 1))
        own += class_log10(weights.value, k.features(), kind)
        at = k.first[:-1]
        return pa.Table.from_arrays([
            t.column("doc_id").combine_chunks(), pa.array(~t.column("learn").to_numpy()), pa.array(np.diff(k.first)),
            pa.array(np.add.reduceat((count > 0).astype(np.int64), at)), pa.array(np.add.reduceat(base, at)),
            pa.array(np.add.reduceat(own, at))], schema=schema)
    return run


def lm_scores(df: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.  ``learn``:
    a condition on ``doc_id`` that training texts meet."""
    spark = df.sparkSession
    sc = spark.sparkContext
    store = BlockTable(df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                                 text_of(F.col(f"`{text_col}`").cast("string")).alias("text"))
                       .withColumn("learn", F.coalesce(learn, F.lit(True))), ROWS_PER_BLOCK, F.octet_length("text"))
    t = store.df()
    training = t.where("learn")

    parts = (training.select("text").mapInArrow(tidy(_company), "at int, sums binary")
             .groupBy("at").applyInPandas(_add_up(np.int64), "at int, sums binary, n int"))
    company = np.zeros((BUCKETS + 1, COMPANY + 1), np.int64)          # of a fixed size
    for r in parts.collect():
        x = np.frombuffer(r.sums, np.int64).reshape(-1, COMPANY + 1)
        company[r["at"]:r["at"] + len(x)] = x
    of = np.concatenate([cluster(company[:BUCKETS, :COMPANY], CLASSES), [CLASSES]]).astype(np.int64)
    classes = sc.broadcast(of)

    weights = np.zeros((ROWS, WIDTH), np.float32)
    sums = np.bincount(of, company[:, COMPANY], WIDTH) + 1.0
    weights[ROWS - 1] = np.log(sums / sums.sum())
    for r in range(ROUNDS):
        share = training.where(F.pmod(F.xxhash64("block", "pos"), F.lit(ROUNDS)) == r).select("text")
        changes = (share.coalesce(TRAINERS).mapInArrow(_train(sc.broadcast(weights), classes), "at int, sums binary")
                   .groupBy("at").applyInPandas(_add_up(np.float32), "at int, sums binary, n int"))
        weights = weights.copy()
        for c in changes.collect():                                   # the weight table, of a fixed size
            x = np.frombuffer(c.sums, np.float32).reshape(-1, WIDTH)
            weights[c["at"]:c["at"] + len(x)] += x / c.n

    owners = shuffle_partitions(spark)
    sent = t.select("block", "learn", "text").groupBy("block").applyInArrow(
        _words(owners, classes), "owner int, block long, words binary, kinds binary, counts binary")
    answers = cut(sent.groupBy("owner").applyInPandas(_own, _ANSWER))
    tokens, known = np.zeros(WIDTH, np.int64), np.zeros(WIDTH, np.int64)
    for r in answers.where("class_tokens is not null").select(F.posexplode(F.arrays_zip("class_tokens", "class_words")).alias("k", "x")
                                                              ).groupBy("k").agg(F.sum("x.class_tokens").alias("t"),
                                                                                 F.sum("x.class_words").alias("w")).collect():
        tokens[r.k], known[r.k] = r.t, r.w
    out = (t.select("block", "doc_id", "learn", "text").groupBy("block")
           .cogroup(answers.select("block", "owner", "counts").groupBy("block"))
           .applyInArrow(_score(sc.broadcast(weights), classes, tokens, known),
                         "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"))
    return out.withColumn("train_tokens", F.lit(int(tokens.sum())).cast("long"))

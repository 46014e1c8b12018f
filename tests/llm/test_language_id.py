"""Language ID against a brute-force context model, and its odd inputs."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from meridian.llm import language_id as L
from meridian.llm.toxicity import crc_fold

SYLLABLES = {"aa": "ka ni mo ru te so".split(), "bb": "sch ung ein lich ver zu".split(), "cc": "ção lhe nha ões qui ém".split()}


def sample(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n))


def corpus():
    rng = random.Random(4)
    rows = [(i, sample(rng, lang, rng.randint(3, 60)), lang) for i, lang in enumerate(["aa"] * 60 + ["bb"] * 25 + ["cc"] * 15)]
    rows += [(100, None, "aa"), (101, "", "aa"), (102, "12 34 !?", "bb"), (103, "KaNi, MoRu!", None), (104, sample(rng, "bb", 20_000), "bb"),
             (None, "ka ni", "zz"), (None, None, None), rows[3], rows[3], (105, "日本語", None), (106, "x", None)]
    return rows


def normalised(text):
    out = [0x20] * L.ORDER
    for b in text.encode():
        s = b if b >= 128 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 0x20
        if s != 0x20 or out[-1] != 0x20:
            out.append(s)
    return bytes(out)


class Brute:
    def __init__(self):
        self.follow = defaultdict(Counter)

    def learn(self, text):
        s = normalised(text)
        for i in range(L.ORDER, len(s)):
            for k in range(L.ORDER + 1):
                self.follow[s[i - k:i]][s[i]] += 1

    def bits(self, text):
        s, total = normalised(text), 0.0
        for i in range(L.ORDER, len(s)):
            for k in range(L.ORDER, -1, -1):
                c = self.follow.get(s[i - k:i])
                if not c:
                    continue
                if c[s[i]]:
                    total -= math.log2(c[s[i]] / (sum(c.values()) + len(c)))
                    break
                total += math.log2((sum(c.values()) + len(c)) / len(c))
            else:
                total += 8
        return total


def frame(spark, rows):
    return spark.createDataFrame([(i, t, g, "s", 1) for i, t, g in rows],
                                 "doc_id long, text string, lang string, source string, lang_pred int").repartition(3)


def test_against_brute_force(spark):
    rows = corpus()
    docs = frame(spark, rows)
    model = L.train(docs, crc_fold(F.col("doc_id"), 5) != 0)
    import zlib
    trees = defaultdict(Brute)
    for i, t, g in rows:
        if i is not None and g is not None and t is not None and zlib.crc32(str(i).encode()) % 5:
            trees[g].learn(t)
    langs = sorted(trees)
    assert model.langs == langs == ["aa", "bb", "cc"]
    texts = [t or "" for _, t, _ in rows]
    got = model.trees.value.code_lengths(pa.array(texts))
    want = np.array([[trees[g].bits(t) for g in langs] for t in texts])
    assert np.allclose(got, want, rtol=1e-5, atol=1e-3)
    found = sorted((tuple(r) for r in L.predict(docs, model).collect()), key=str)
    expect = []
    for (i, t, _), w in zip(rows, want, strict=True):
        some = any(c.isalpha() for c in t or "")
        p = np.exp2(w.min() - w)
        expect.append((i, langs[int(w.argmin())] if some else "und", float(1 / p.sum()) if some else 0.0))
    expect.sort(key=str)
    assert [x[:2] for x in found] == [x[:2] for x in expect]
    assert all(abs(a[2] - b[2]) < 1e-3 for a, b in zip(found, expect, strict=True))


def test_pieces_and_pruning(spark, monkeypatch):
    texts = pa.array([t or "" for _, t, _ in corpus()])
    docs = frame(spark, corpus())
    whole = L.train(docs, F.lit(True)).trees.value.code_lengths(texts)
    monkeypatch.setattr(L, "PIECE", 997)
    model = L.train(docs, F.lit(True))
    assert np.allclose(model.trees.value.code_lengths(texts), whole, rtol=1e-6, atol=1e-3)
    monkeypatch.setattr(L, "NODES", 300)
    small = L.train(docs, F.lit(True)).trees.value
    assert len(small.cost) <= 900
    assert (small.code_lengths(texts)[:100].argmin(axis=1) == [0] * 60 + [1] * 25 + [2] * 15).all()


def test_nothing_to_learn(spark, none):
    assert L.predict(none, L.train(none, F.lit(True))).count() == 0
    docs = frame(spark, [(1, "abc", None), (2, None, "aa"), (None, "abc", "bb"), (3, "", "cc")])
    got = L.predict(docs, L.train(docs, F.lit(True))).collect()
    assert sorted(((r.doc_id, r.lang_pred, r.score) for r in got), key=lambda r: (r[0] is None, r[0])) == [(1, "und", 0.0), (2, "und", 0.0), (3, "und", 0.0), (None, "und", 0.0)]


def test_many_languages_stay_bounded():
    assert all(L.nodes_of(n) * n * n <= max(L.COSTS, n * n * 2048) for n in (1, 4, 20, 90, 500))


def test_hash_places():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 60, 5000).astype(np.uint64))
    p = L.Places(keys)
    assert (p.find(keys) == np.arange(len(keys))).all()
    assert (p.find(keys + np.uint64(1 << 61)) == -1).all()

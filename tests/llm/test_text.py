import math
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from meridian.llm.bpe import Encoded, decode, decode_ids, encode, encode_digests
from meridian.llm.license_scan import license_scan
from meridian.llm.license_texts import MIT
from meridian.llm.maxent_lm import BUCKETS, CLASSES, COMPANY, ROWS, WIDTH, Tokens, class_log10, cluster, lm_scores
from meridian.llm.packing import deficit_round_robin, pack, window_sizes
from meridian.llm.sharding import shard_by_size
from meridian.llm.tokens import read_vocabulary, vocabulary
from meridian.llm.toxicity import crc_fold, fit_logistic, score, train, words_of
from meridian.llm.words import row_words

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
VOCABULARY = vocabulary(read_vocabulary(PATH))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=60) | st.text("ab c'\n\t　é1²<|endoftext>", max_size=80), max_size=5))
def test_bpe_like_the_library(texts):
    texts = [t for t in texts if not any(0xD800 <= ord(c) < 0xE000 for c in t)]
    enc = Encoded(texts, VOCABULARY)
    for i, t in enumerate(texts):
        want = LIBRARY.encode(t, add_special_tokens=False).ids
        assert enc.ids(i).tolist() == want
        assert enc.listing(i) == ",".join(map(str, want)) and enc.count(i) == len(want)
        assert decode_ids(want, VOCABULARY) == LIBRARY.decode(want, skip_special_tokens=False)


def test_bpe_special_and_repeats():
    texts = ["<|endoftext|>a<|endoftext|><|endoftext|>", "a" * 1001, "<|endoftext|", "ab" * 500, ""]
    enc = Encoded(texts, VOCABULARY)
    assert [enc.ids(i).tolist() for i in range(5)] == [LIBRARY.encode(t, add_special_tokens=False).ids for t in texts]


def test_bpe_round_trip(docs, rows, none):
    ids = encode(docs, PATH)
    got = sorted(((r.doc_id is None, r.doc_id), r.text) for r in decode(ids, PATH).collect())
    assert got == sorted(((i is None, i), t or "") for i, t, *_ in rows)
    assert encode_digests(docs, PATH).count() == len(rows)
    assert encode(none, PATH).count() == 0 and encode_digests(none, PATH).count() == 0


def test_words_are_hashed_by_value():
    texts = pa.array(["A b\tc", "", "  a  B ", "c", "x y é", "b" * 3_000_000 + " a"])
    w, first = row_words(texts)
    by = [w[a:b].tolist() for a, b in zip(first, first[1:], strict=False)]
    assert [len(x) for x in by] == [3, 0, 2, 1, 2, 2]
    assert by[0] == [by[2][0], by[2][1], by[3][0]] and by[5][1] == by[0][0] and len(set(sum(by, []))) == 6


def test_packing(docs, rows):
    got = pack(docs, PATH, length=256).collect()
    ids = {}
    for i, t, *_ in rows:
        ids.setdefault(i, np.array(LIBRARY.encode(t or "", add_special_tokens=False).ids + [1], "<u4"))
    assert sum(r.length for r in got) == sum(
        len(LIBRARY.encode(t or "", add_special_tokens=False).ids) + 1 for _, t, *_ in rows)
    by_sequence = {}
    for r in got:
        if r.doc_id is not None:                 # two documents without id have different texts
            own = ids[r.doc_id]
            assert r.doc_tokens == len(own) and zlib.crc32(own[r.start:r.start + r.length].tobytes()) == r.ids_crc32
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for pieces in by_sequence.values():
        pieces.sort(key=lambda r: r.offset)
        assert [r.offset for r in pieces] == np.cumsum([0] + [r.length for r in pieces])[:-1].tolist()
        total = sum(r.length for r in pieces)
        assert total == pieces[0].sequence_length and (total == 256 or total & (total - 1) == 0 and total < 256)
    pieces_of = {}
    for r in got:
        pieces_of.setdefault(r.doc_id, []).append((r.start, r.length))
    once = [i for i, n in Counter(i for i, *_ in rows).items() if n == 1]
    for i in once:
        at = 0
        for s, n in sorted(pieces_of[i]):
            assert s == at
            at += n
        assert at == len(ids[i])


def test_packing_long_runs_of_white_space(spark):
    texts = ["a" + " " * 1_200_000 + "b <|endoftext|> c", "\n" * 1_200_000, "a b", "\t " * 600_000 + "x"]
    ids = [np.array(LIBRARY.encode(t, add_special_tokens=False).ids + [1], "<u4") for t in texts]
    df = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], "doc_id long, text string, source string")
    got = pack(df, PATH).collect()
    for r in got:
        own = ids[r.doc_id]
        assert r.doc_tokens == len(own) and zlib.crc32(own[r.start:r.start + r.length].tobytes()) == r.ids_crc32
    assert sum(r.length for r in got) == sum(map(len, ids))


def test_packing_targets_and_empty(spark, none):
    df = spark.createDataFrame([(i, "word " * 200, "a" if i % 2 else "b") for i in range(40)], "doc_id long, text string, source string")
    got = pack(df, PATH, length=128, targets={"a": 3.0, "b": 1.0}).collect()
    first = {}
    for r in got:
        first.setdefault(r.sequence_id, Counter())[r.source] += r.length
    early = [first[k] for k in sorted(first)[:20]]
    assert all(abs(c["a"] - 96) <= 1 for c in early)             # three quarters, until a source ends
    assert pack(none, PATH).count() == 0


def test_window_sizes_and_round_robin():
    assert window_sizes(2048 * 3 + 300, 2048).tolist() == [2048, 2048, 2048, 256, 32, 8, 4]
    sizes = window_sizes(10_000, 512)
    take = deficit_round_robin(np.array([7000, 2990, 10]), np.array([7000.0, 2990.0, 10.0]), np.zeros(3), sizes)
    assert take.sum(axis=0).tolist() == [7000, 2990, 10] and take.sum(axis=1).tolist() == sizes.tolist()
    assert (take >= 0).all() and np.abs(take[:19] - sizes[:19, None] * [0.7, 0.299, 0.001]).max() <= 2


def test_sharding(docs, rows, none):
    got = shard_by_size(docs, 4).collect()
    want = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, *_ in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want
    for s in range(4):
        slots = sorted(r.slot for r in got if r.shard == s)
        assert slots == list(range(len(slots)))
    assert shard_by_size(none, 4).count() == 0


def test_sharding_near_equal_with_a_hot_text(spark):
    df = spark.range(6000).selectExpr("id as doc_id", "if(id % 3 = 0, 'hot text', repeat('x', cast(id % 97 as int))) as text")
    sizes = Counter()
    for r in shard_by_size(df, 5).collect():
        sizes[r.shard] += r.size
    assert max(sizes.values()) - min(sizes.values()) <= max(sizes.values()) / 32


def test_license_scan(spark, docs, rows, none):
    got = {r.doc_id: r for r in license_scan(docs).collect()}
    notice = next(i for i, t, *_ in rows if t == "Licensed under CC BY-NC 4.0.")
    assert got[notice].license == "CC-BY-NC-4.0" and got[notice].notices == ["CC-BY-NC-4.0"]
    changed = "Copyright (c) 2020 Someone\n\n" + MIT.replace("software", "SOFTWARE").replace(",", " ,\n").replace("\"", "'")
    more = spark.createDataFrame([(1, changed), (2, MIT + " x"), (3, "Released under the MIT licence!"), (4, None)], "doc_id long, text string")
    found = {r.doc_id: r for r in license_scan(more).collect()}
    assert [found[i].license for i in (1, 2, 3, 4)] == ["MIT", None, "MIT", None]
    assert license_scan(none).count() == 0


def _toxic_corpus(n=600):
    rng = random.Random(5)
    stems = ["vexo", "grum", "plint"]
    out = []
    for i in range(n):
        w = ["".join(rng.choice(["ba", "re", "ti", "no", "su", "la"]) for _ in range(rng.randint(1, 4))) for _ in range(rng.choice([20, 60, 400]))]
        toxic = i % 5 == 0
        for _ in range(max(1, len(w) // 40) if toxic else 0):
            w[rng.randrange(len(w))] = rng.choice(stems) + rng.choice(["ba", "re", "ti", "no", "su", "la"])
        out.append((i, " ".join(w), int(toxic)))
    return out


def test_toxicity(spark, docs, none):
    data = _toxic_corpus()
    df = spark.createDataFrame(data, "doc_id long, text string, toxic int")
    held = crc_fold_of = [i for i, *_ in data if zlib.crc32(str(i).encode()) % 4 == 2]
    model = train(df, df.select("doc_id", "toxic"), crc_fold(__import__("pyspark").sql.functions.col("doc_id"), 4) != 2)
    got = {r["row"]["doc_id"]: r["score"] for r in score(df, model).collect()}
    right = sum((got[i] >= 0.3) == bool(data[i][2]) for i in held)
    assert right / len(crc_fold_of) > 0.95
    odd = score(docs, model).collect()
    assert len(odd) == docs.count() and all(0 <= r["score"] <= 1 for r in odd)
    assert score(none, model).count() == 0
    empty = train(none, df.select("doc_id", "toxic"))
    assert {r["score"] for r in score(docs, empty).collect()} == {0.0}
    assert words_of("A1b, É_x") == ["a", "b", "é", "x"]


def test_toxicity_follows_the_share_of_all_labels(spark):
    rng = random.Random(7)
    data = []
    for i in range(1500):                        # a tenth toxic, and words that tell the classes apart only in part
        y = int(i % 10 == 0)
        w = ["".join(rng.choice(["ba", "re", "ti", "no", "su", "la"]) for _ in range(rng.randint(1, 4))) for _ in range(20)]
        if rng.random() < (0.6 if y else 0.2):
            w[rng.randrange(20)] = "vexo" + rng.choice(["ba", "re", "ti"])
        data.append((i, " ".join(w), y))
    df = spark.createDataFrame(data, "doc_id long, text string, toxic int")
    mean = {}
    for per_class in (150, 2000):                # the plain class is cut to a ninth, or nothing is
        model = train(df, df.select("doc_id", "toxic"), per_class=per_class)
        mean[per_class] = np.mean([r["score"] for r in score(df, model).collect()])
    assert abs(mean[2000] - 0.1) < 0.06 and abs(mean[150] - mean[2000]) < 0.08, mean
    one = df.where("toxic = 0").unionByName(df.where("doc_id = 10"))      # one toxic label cannot be split, the share is the score
    assert train(one, one.select("doc_id", "toxic"), per_class=10).prior == pytest.approx(1 / 1351)


def test_logistic_rows_that_stand_for_many():
    rng = np.random.default_rng(2)
    x, y, times = rng.standard_normal((60, 3)), rng.integers(0, 2, 60), rng.integers(1, 5, 60)
    assert np.allclose(fit_logistic(x, y, times=times), fit_logistic(np.repeat(x, times, axis=0), np.repeat(y, times)))


def test_lm_scores(spark, docs, rows, none):
    from pyspark.sql import functions as F
    got = lm_scores(docs, F.col("doc_id") % 7 != 2).collect()
    count = Counter()
    tokens = lambda t: (t or "").encode().lower().split() + [0]
    for i, t, *_ in rows:
        if i is None or i % 7 != 2:
            count.update(tokens(t))
    n, v = sum(count.values()), len(count)
    want = sorted(((i is None, i), len(tokens(t)), sum(count[w] > 0 for w in tokens(t)),
                   sum(math.log10((count[w] + 1) / (n + v + 1)) for w in tokens(t))) for i, t, *_ in rows)
    have = sorted(((r.doc_id is None, r.doc_id), r.n_tokens, r.n_known, r.base_score) for r in got)
    for a, b in zip(have, want, strict=True):
        assert a[:3] == b[:3] and a[3] == pytest.approx(b[3])
    assert {r.train_tokens for r in got} == {n} and all(r.score <= 0 for r in got)
    assert all(r.held_out == (r.doc_id is not None and r.doc_id % 7 == 2) for r in got)
    assert lm_scores(none, F.col("doc_id") % 7 != 2).count() == 0


def test_lm_classes_sum_to_one():
    t = Tokens(pa.array(["a b c", "", "d"]))
    assert t.first.tolist() == [0, 4, 5, 7]
    rng = np.random.default_rng(0)
    weights = rng.standard_normal((ROWS, WIDTH)).astype(np.float32)
    p = sum(10 ** class_log10(weights, t.features(), np.full(7, k)) for k in range(WIDTH))
    assert np.allclose(p, 1, atol=1e-4)


def test_lm_classes_keep_thirty_kinds_of_words_apart():
    company = np.zeros((BUCKETS, COMPANY), np.int64)
    company[np.arange(30) * 100, np.arange(30)] = 1000           # each of thirty endings keeps a company of its own
    assert len(set(cluster(company, CLASSES)[::100][:30].tolist())) == 30

import hashlib
import re
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from meridian.llm.components import connected_components
from meridian.llm.exact_dedup import exact_dedup, rice_decode, rice_encode, rice_parameter
from meridian.llm.near_dedup import bands, forest, near_dedup, universal_hashes
from meridian.llm.substring_dedup import choose_anchors, substring_dedup

SPACE = re.compile(r"[\x20\x09-\x0D]")


@settings(max_examples=60, deadline=None)
@given(st.sets(st.integers(0, 1 << 40), min_size=1, max_size=200))
def test_rice_round_trip(values):
    v = np.array(sorted(values), np.int64)
    k = rice_parameter(len(v), 1 << 40)
    assert rice_decode(rice_encode(v, k), len(v), k).tolist() == v.tolist()


def test_exact_dedup(docs, rows):
    got = exact_dedup(docs).select("row.doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()
    groups = defaultdict(list)
    for i, t, *_ in rows:
        groups[SPACE.sub("", t or "")].append((-len(t or ""), i is None, i))
    want = []
    for text, members in groups.items():
        first = min(members)
        for m in members:
            want.append((m[2], first[2], len(members), hashlib.sha256(text.encode()).hexdigest()))
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=key) == sorted(want, key=key)
    assert sum(r.kept for r in got) == len(groups)            # one row of each group, repeated rows too
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_blocks_without_copies(spark):
    """Blocks in which nothing is marked, has words, or repeats."""
    df = spark.createDataFrame([(i, f"text {i}" if i else None) for i in range(40)], "doc_id long, text string").repartition(8)
    assert exact_dedup(df).where("kept and group_size = 1").count() == 40
    assert near_dedup(df, 3, 0.85).where("kept").count() == 40
    assert substring_dedup(df, 20).where("n_removed = 0").count() == 40


def test_exact_dedup_empty(none):
    assert exact_dedup(none).count() == 0


def _sets(rows, n):
    out = []
    for i, t, *_ in rows:
        w = (t or "").encode().lower().split()
        out.append((i, {tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())))
    return out


def _components(sets, percent):
    label = list(range(len(sets)))
    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= percent * len(x | y) and label[a] != label[b]:
                old = label[a]
                label = [label[b] if z == old else z for z in label]
    return label


@pytest.mark.parametrize(("n", "percent"), [(3, 85), (5, 80)])
def test_near_dedup(docs, rows, n, percent):
    got = near_dedup(docs, n, percent / 100).select("row.doc_id", "n_shingles", "component_id", "kept").collect()
    sets = _sets(rows, n)
    label = _components(sets, percent)
    want = []
    for (i, s), z in zip(sets, label, strict=True):
        ids = [j for (j, _), y in zip(sets, label, strict=True) if y == z and j is not None]
        want.append((i, len(s), (min(ids) if ids else None) if s else i))
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=key) == sorted(want, key=key)
    linked = len({z for (_, s), z in zip(sets, label, strict=True) if s})
    assert sum(r.kept for r in got) == linked + sum(not s for _, s in sets)


def test_near_dedup_empty(none):
    assert near_dedup(none).count() == 0


def test_band_miss_chance():
    for t in (0.8, 0.85, 0.9):
        r, b = bands(t)
        assert (1 - t ** r) ** b < 1e-6 and r * b <= 640


def test_forest_spans_what_links_span():
    rng = np.random.default_rng(3)
    core = rng.integers(1, 1 << 62, 100).astype(np.uint64)
    sets = []
    for _ in range(120):
        keep = rng.random(100) < rng.uniform(0.8, 1)
        sets.append(np.unique(np.concatenate((core[keep], rng.integers(1, 1 << 62, int((~keep).sum())).astype(np.uint64)))))
    mul, inc = universal_hashes(400)

    def groups(links, m):
        label = list(range(m))
        for a, b in links:
            old, new = label[a], label[b]
            label = [new if z == old else z for z in label]
        return {frozenset(i for i in range(m) if label[i] == z) for z in label}

    def linked(a, b):
        c = len(np.intersect1d(a, b))
        return 100 * c >= 85 * (len(a) + len(b) - c)

    every = [(a, b) for a in range(120) for b in range(a) if linked(sets[a], sets[b])]
    assert groups(forest(sets, np.zeros(120, int), 0.85, mul, inc), 120) == groups(every, 120)
    side = np.arange(120) % 2
    across = [(a, b) for a, b in every if side[a] != side[b]]
    assert groups(forest(sets, side, 0.85, mul, inc), 120) == groups(across, 120)


def test_components_long_path(spark):
    rng = np.random.default_rng(1)
    ids = rng.permutation(300).tolist()
    links = spark.createDataFrame(list(zip(ids, ids[1:], strict=False)) + [(1000, 1001), (1001, 1000)], "a long, b long")
    got = {r.node: r.root for r in connected_components(links).collect()}
    assert all(got[i] == 0 for i in range(300)) and got[1000] == got[1001] == 1000


def test_anchor_depends_on_the_window_alone():
    rng = np.random.default_rng(5)
    g = rng.integers(0, 50, 500).astype(np.uint64)             # many ties
    found = choose_anchors(g, 13)
    for s in range(len(found)):
        w = g[s:s + 13]
        assert found[s] - s == max(i for i in range(13) if w[i] == w.min())


def _substring(rows, length):
    seen, out = set(), []
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0))
    for k in order:
        w = (rows[k][1] or "").encode().split()
        cover = [False] * len(w)
        for s in range(len(w) - length + 1):
            t = tuple(w[s:s + length])
            if t in seen:
                cover[s:s + length] = [True] * length
            seen.add(t)
        kept = b" ".join(x for x, c in zip(w, cover, strict=True) if not c)
        out.append((rows[k][0], len(w), sum(cover), kept.decode()))
    return out


def test_substring_dedup(docs, rows):
    got = substring_dedup(docs, 20).select("rest.doc_id", "n_words", "n_removed", "kept").collect()
    want = _substring(rows, 20)
    # Which of several rows with one id comes first is not fixed: compare them as they add up.
    key = lambda r: tuple((x is None, x) for x in r)
    single = [r for r in want if r[0] is not None and sum(w[0] == r[0] for w in want) == 1]
    assert sorted((tuple(r) for r in got if r.doc_id in {s[0] for s in single}), key=key) == sorted(single, key=key)
    assert sum(r.n_removed for r in got) == sum(w[2] for w in want)
    assert sum(w[2] for w in want) > 300


def test_substring_dedup_as_is_and_empty(docs, none):
    got = substring_dedup(docs, 20, as_is=True).select("rest.doc_id", "n_removed", "kept").collect()
    assert any(r.kept == " \n\t " for r in got)
    assert substring_dedup(none, 20).count() == 0


def test_windows_that_differ_in_one_word(spark):
    """Words that agree in the upper half of many 64-bit hashes are still different words."""
    text = lambda w: " ".join(w if i == 10 else f"k{i}" for i in range(25))
    df = spark.createDataFrame([(1, text("w113199")), (2, text("w248382")), (3, text("w113199"))], "doc_id long, text string")
    got = {r.doc_id: r.n_removed for r in substring_dedup(df.repartition(3), 20).select("rest.doc_id", "n_removed").collect()}
    assert got == {1: 0, 2: 0, 3: 25}


def mirror_words():
    """Two words of 2,048 letters that polynomial hashes modulo 2^64 cannot tell apart."""
    a = "ab"
    while len(a) < 2048:
        a += a.translate(str.maketrans("ab", "ba"))
    return a, a.translate(str.maketrans("ab", "ba"))


def test_words_that_polynomials_confuse(spark):
    from pyspark.sql import functions as F

    from meridian.llm.maxent_lm import lm_scores
    a, b = mirror_words()
    df = spark.createDataFrame([(1, a), (2, b), (3, a[:64]), (4, b[:64]), (5, a + " x y"), (6, b + " x y")], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in near_dedup(df, 3, 0.85).select("row.doc_id", "component_id").collect()}
    assert got == {i: i for i in range(1, 7)}
    one = spark.createDataFrame([(1, a), (2, b)], "doc_id long, text string")
    known = {r.doc_id: r.n_known for r in lm_scores(one, F.col("doc_id") == 1).collect()}
    assert known == {1: 2, 2: 1}                                # the word and the end; the end alone


def test_word_hashes_take_in_every_byte():
    import pyarrow as pa

    from meridian.llm.words import row_words
    words = ["a" * n for n in (1, 7, 8, 9, 16, 17, 255, 256, 257, 600)] + ["a" * n + "b" for n in (0, 6, 7, 8, 255, 256, 599)] + ["Ab", "aB"]
    one, _ = row_words(pa.array([" ".join(words)]), lower=False)
    each = np.concatenate([row_words(pa.array([f" \t{w}\n"]), lower=False)[0] for w in words])
    assert (one == each).all() and len(set(one.tolist())) == len(words)
    low, _ = row_words(pa.array(["Ab aB ab"]))
    assert len(set(low.tolist())) == 1


def test_blocks_are_cut_by_bytes(spark, monkeypatch):
    import meridian.llm.common as C
    state = [0, 0, 0]
    assert C.cut_blocks([5, 5, 50, 1, 1, 1], state, 10, 2) == [0, 0, 1, 2, 2, 3] and state == [3, 1, 1]
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(i, "x" * 50_000) for i in range(300)], "i long, t string").repartition(2)
    got = C.BlockTable(df, 1000, F.length("t")).df().groupBy("block").agg(F.sum(F.length("t")).alias("n"), F.max("pos")).collect()
    assert len(got) == 4 and max(r.n for r in got) <= C.BLOCK_BYTES


def test_heavy_prefixes_are_lengthened(spark, monkeypatch):
    """One phrase everywhere, with many continuations and many equal passages; groups of a few records."""
    import random

    import meridian.llm.substring_dedup as S
    rng = random.Random(2)
    phrase = " ".join(f"p{i}" for i in range(9))
    rows = []
    for i in range(160):
        left, right = (" ".join(f"{s}{rng.randrange(3)}" for _ in range(14)) for s in "lr")
        rows.append((i, f"{left} {phrase} {right}" if i % 2 else f"{phrase} {right} same tail of many words " * 2))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(12)
    want = sorted(_substring(rows, 20))
    depth = []
    plain = S._lengthen
    monkeypatch.setattr(S, "_lengthen", lambda length, level: (depth.append(level), plain(length, level))[1])
    for group_bytes in (16 << 20, 700):
        monkeypatch.setattr(S, "GROUP_BYTES", group_bytes)
        got = S.substring_dedup(df, 20).select("rest.doc_id", "n_words", "n_removed", "kept").collect()
        assert sorted(tuple(r) for r in got) == want
    assert max(depth) >= 2 and sum(w[2] for w in want) > 500


def test_prefix_classes_cover_every_place():
    from meridian.llm.substring_dedup import prefix_classes
    for length in (9, 20, 33):
        for level in prefix_classes(length):
            assert [j for a, b in level for j in range(a, b + 1)] == list(range(length - 7))


def test_suffix_array_and_deep_nodes():
    from meridian.llm.substring_dedup import later_windows, suffix_array
    rng = np.random.default_rng(7)
    numbers = rng.integers(1, 3, 400).astype(np.uint32)
    start, stop = np.arange(0, 380), np.full(380, 400)
    order, lcp = suffix_array(numbers, start, stop, 40)
    texts = [tuple(numbers[s:min(s + 40, 400)].tolist()) for s in start]
    assert [texts[i] for i in order] == sorted(texts)
    for k in range(1, 380):
        a, b = texts[order[k - 1]], texts[order[k]]
        assert lcp[k] == next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
    seen, want = set(), []
    for s in start:
        w = texts[s][:6]
        want.append(w in seen)
        seen.add(w)
    assert later_windows(numbers, start, stop, start, 6).tolist() == want

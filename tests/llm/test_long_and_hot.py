"""Texts longer than a block's budget, groups of copies, and a pipeline whose first stage drops rows."""

import random

from pyspark.sql import functions as F

from meridian.llm import common as C
from meridian.llm.maxent_lm import lm_scores
from meridian.llm.near_dedup import near_dedup
from meridian.llm.packing import pack
from meridian.llm.substring_dedup import substring_dedup
from meridian.plans.iterate import cut
from .conftest import words
from .test_dedup import _substring


def test_texts_longer_than_a_block(spark, monkeypatch):
    monkeypatch.setattr(C, "BLOCK_BYTES", 20_000)
    rng = random.Random(9)
    long = words(rng, 30_000, 30_000)                                      # some nine times the budget
    tail = " ".join(long.split()[15_000:])
    rows = [(1, long), (2, "short " + tail), (3, long + " end"), (4, tail[:4000]), (5, None), (6, "a b")] + [(10 + i, words(rng, 50)) for i in range(30)]
    df = cut(spark.createDataFrame(rows, "doc_id long, text string").repartition(2))
    blocks = C.BlockTable(df, 1000, F.octet_length("text")).df().groupBy("block").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("b"))
    assert all(r.n == 1 or r.b <= 20_000 for r in blocks.collect())
    got = sorted(tuple(r) for r in substring_dedup(df, 20).select("rest.doc_id", "n_words", "n_removed", "kept").collect())
    assert got == sorted(_substring(rows, 20))
    near = {r.doc_id: r.component_id for r in near_dedup(df, 3, 0.85).select("row.doc_id", "component_id").collect()}
    assert near[3] == 1 and near[2] == 2 and near[4] == 4
    scores = {r.doc_id: r for r in lm_scores(df, F.col("doc_id") != 2).collect()}
    assert scores[1].n_tokens == 30_001 and scores[1].n_known == 30_001 and scores[5].n_tokens == 1


def test_pipeline_drops_toxic_rows_and_hot_groups(spark, tmp_path):
    import corpus_pipeline as p
    rng = random.Random(3)
    rows, labels = [], []
    for i in range(900):
        toxic = i % 5 == 0
        w = words(rng, 40, 3000).split()
        if toxic:
            w[3], w[20] = "vexogrum", "plintvexo"
        rows.append((i, " ".join(w), "en", f"s{i % 3}", 1))
        labels.append((i, 1, int(toxic)))
    rows += [(1000 + i, rows[1][1] + " " * (i % 3), "en", "hot", 1) for i in range(500)]           # a third of all rows are copies
    near = rows[2][1].split()
    rows += [(2000 + i, " ".join([*near, f"n{i}"]), "en", "hot", 1) for i in range(120)]             # and near copies
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    df = cut(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(6))
    state, kept = df, {}
    for name, stage in p.STAGES:
        state = cut(stage(spark, state, str(tmp_path)))
        kept[name] = {r.doc_id for r in state.select("doc_id").distinct().collect()}
    gone = {i for i in range(0, 900, 5)} - kept["toxicity"]
    assert len(gone) > 150 and len(kept["toxicity"] & set(range(900))) >= 700
    assert not kept["exact_dedup"] & set(range(1000, 1500)) or 1 not in kept["exact_dedup"]
    assert len(kept["exact_dedup"] & {1, *range(1000, 1500)}) == 1
    assert kept["near_dedup"] & {2, *range(2000, 2120)} == {2}
    assert kept["packing"] == kept["substring_dedup"] == kept["near_dedup"]


def test_packing_of_one_hot_source(spark):
    from meridian.llm.queries import vocabulary_path
    rng = random.Random(1)
    df = spark.createDataFrame([(i, words(rng, 30), "hot" if i % 3 else f"s{i}") for i in range(300)], "doc_id long, text string, source string")
    got = pack(df.repartition(5), vocabulary_path()).collect()
    by_doc = {}
    for r in got:
        by_doc.setdefault(r.doc_id, []).append((r.start, r.length, r.doc_tokens))
    assert len(by_doc) == 300
    for pieces in by_doc.values():
        pieces.sort()
        assert pieces[0][0] == 0 and all(a[0] + a[1] == b[0] for a, b in zip(pieces, pieces[1:])) and sum(x[1] for x in pieces) == pieces[0][2]

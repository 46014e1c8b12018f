import numpy as np
import pytest
from pyspark.sql import functions as F

from meridian.llm.ann import balanced_parts, nearest, neighbour_graph


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(2)
    centre = rng.standard_normal((8, 24)) * 0.6
    x = centre[rng.integers(0, 8, 3000)] + rng.standard_normal((3000, 24)) * 0.5
    x[100:400] = x[100]                                     # one very common vector
    return x


def test_nearest(spark, vectors):
    rows = [(i, v.tolist(), 1, 2) for i, v in enumerate(vectors)]
    rows += [(5000, None, 1, 2), (5020, [0.0] * 24, 1, 2), (5040, [None] * 24, 1, 2), (5060, [float("nan")] * 24, 1, 2),
             (5080, [1.0], 1, 2), (None, vectors[0].tolist(), 1, 2)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank int, part int").repartition(4)
    got = {}
    for r in nearest(df, F.col("vec_id") % 20 == 0, 20).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert sorted(got) == list(range(0, 3000, 20))
    hit = 0
    for q, found in got.items():
        found.sort()
        s = (vectors * vectors[q]).sum(axis=1)
        assert [f[0] for f in found] == list(range(1, 21)) and all(f[2] == s[f[1]] for f in found)
        s[q] = -np.inf
        best = np.lexsort((np.arange(3000), -s))[:20].tolist()
        hit += len(set(best) & {f[1] for f in found})
        assert [f[1] for f in found] == sorted((f[1] for f in found), key=lambda i: (-s[i], i))
    assert hit / (20 * len(got)) >= 0.9


def test_nearest_few_and_none(spark):
    few = spark.createDataFrame([(i, [float(i + 1), 1.0]) for i in (0, 1, 20)], "vec_id long, embedding array<double>")
    got = [(r.query_id, r["rank"], r.vec_id) for r in nearest(few, F.col("vec_id") % 20 == 0, 20).collect()]
    assert sorted(got) == [(0, 1, 20), (0, 2, 1), (20, 1, 1), (20, 2, 0)]
    none = spark.createDataFrame([], "vec_id long, embedding array<double>")
    assert nearest(none, F.col("vec_id") % 20 == 0, 20).count() == 0


def test_parts_are_balanced(vectors):
    a, _ = neighbour_graph(vectors[:512], 16)
    assert np.bincount(balanced_parts(a, 8), minlength=8).tolist() == [64] * 8


def test_pipeline_stages(spark, docs, none, tmp_path):
    import corpus_pipeline as p
    ids = [r.doc_id for r in docs.select("doc_id").dropna().distinct().collect()]
    spark.createDataFrame([(i, 1, 0) for i in ids], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    state = docs
    counts = []
    for name, stage in p.STAGES:
        state = stage(spark, state, str(tmp_path))
        path = str(tmp_path / name)
        state.write.parquet(path)
        state = spark.read.parquet(path)
        counts.append(state.count())
        if name != "packing":
            assert state.columns == docs.columns
    assert counts[0] == docs.count()                          # no toxic label: nothing goes
    assert counts[1] < counts[0] and counts[2] < counts[1] and counts[3] == counts[2]
    state = none
    for _, stage in p.STAGES:
        state = stage(spark, state, str(tmp_path))
    assert state.count() == 0

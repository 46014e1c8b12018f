import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

DOCS = "doc_id long, text string, lang string, source string, n_chars long, block int, pos int, kept string, row int, score double"


def words(rng, n, vocabulary=400):
    return " ".join(f"w{int(rng.random() ** 2 * vocabulary)}" for _ in range(n))


def odd_documents():
    """Nulls in every column, empty and blank texts, a very long text, ties, repeated
    rows, near copies, shared passages, and columns with clashing names."""
    rng = random.Random(11)
    base = [words(rng, 120) for _ in range(12)]
    passage = words(rng, 60)
    texts = [None, "", " \n\t ", "one", "one two", "one two three", *base]
    texts += [base[0], " ".join(base[0].split()), base[0].replace(" ", "  "), base[1].upper(), base[1] + " "]
    for b in base[:6]:
        w = b.split()
        w[5], w[77] = "changed", "other"
        texts.append(" ".join(w))
        texts.append(" ".join(w[:60]) + " " + words(rng, 60))
    texts += [words(rng, 30) + " " + passage + " " + words(rng, 30) for _ in range(4)]
    texts += [words(rng, 30_000, 50_000), passage + " " + passage, "aaaa " * 50, "é ñ 日本語 \x85 x\x1cy", "Licensed under CC BY-NC 4.0."]
    rows = [(i, t, None if i % 5 == 0 else "en", None if i % 4 == 0 else f"s{i % 3}", len(t or ""), 1, 2, "x", 3, 0.5)
            for i, t in enumerate(texts)]
    rows += [rows[8], rows[8], (None, base[2], None, None, None, None, None, None, None, None),
             (None, None, None, None, None, None, None, None, None, None)]
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="session")
def spark():
    from meridian.session import get_session
    s = get_session("local[*]", 4)
    yield s


@pytest.fixture(scope="session")
def rows():
    return odd_documents()


@pytest.fixture(scope="session")
def docs(spark, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("llm") / "documents")
    spark.createDataFrame(rows, DOCS).repartition(5).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS)

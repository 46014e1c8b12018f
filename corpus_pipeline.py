"""A training corpus from documents: five stages, each on what the one before kept.

1. toxicity: documents scored 0.3 or more by the class-conditional models go.
2. exact_dedup: of equal texts (white space aside) the longest, then smallest id, stays.
3. near_dedup: of documents linked by five-word shingles at a similarity of 0.8 or
   more, one of each group stays.
4. substring_dedup: words in passages of 20 words or more that start earlier go;
   documents from which nothing goes keep their text as it is.
5. packing: what is left becomes sequences of at most 2048 ids.

Nulls, empty and very long texts, ties, repeated rows and empty tables pass as each
operator states; columns keep their names and order, whatever they are called (extra
ones ride along), up to packing, whose rows are pieces.

SQL cannot express the learned, iterative and tokenizing stages, so ``ORACLE_SQL`` is
None; tests/llm holds the stages against brute force.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meridian.llm import queries as q
from meridian.llm.common import Scratch, table
from meridian.llm.exact_dedup import exact_dedup
from meridian.llm.near_dedup import near_dedup
from meridian.llm.packing import pack
from meridian.llm.substring_dedup import substring_dedup
from meridian.llm.toxicity import crc_fold, score, train
from meridian.plans.iterate import Steps

WINDOW_WORDS = 20


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(crc_fold(F.col("doc_id"), 4) == 2, F.lit(False))
    model = train(docs, table(spark, sf_dir, "labels"), ~held_out)
    return score(docs, model).where(F.col("score") < q.TOXIC_FROM).select("row.*")


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup(docs).where("kept").select("row.*")


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup(docs).where("kept").select("row.*")


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Text and n_chars follow what stays."""
    found = substring_dedup(docs, WINDOW_WORDS, as_is=True)
    changed = {"text": F.col("kept"), "n_chars": F.when(F.col("n_removed") > 0, F.length("kept").cast("long")).otherwise(
        F.col("rest.n_chars"))}
    return found.select(*[changed.get(c, F.col(f"rest.`{c}`")).alias(c) for c in docs.columns])


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, q.vocabulary_path())


_SCRATCH = Scratch()


def _stage(fn):
    """When a stage begins, the result of the one before has been written, so what that
    stage wrote for itself goes first."""
    @functools.wraps(fn)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        with _SCRATCH.step(docs):
            return fn(spark, docs, sf_dir)
    return run_stage


STAGES = [
    ("toxicity", _stage(without_toxic)),
    ("exact_dedup", _stage(without_copies)),
    ("near_dedup", _stage(without_near_copies)),
    ("substring_dedup", _stage(without_repeats)),
    ("packing", _stage(packed)),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, states = table(spark, sf_dir, "documents"), Steps(spark)
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = states.cut(docs)
    return docs

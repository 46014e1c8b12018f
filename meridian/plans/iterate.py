"""Fixpoint loops over DataFrames with lineage cut by reliable checkpoints.

Iterative operators (components, PageRank, HITS, Louvain, solvers) are driver
loops whose body is a DataFrame transformation.  Without a cut the logical plan
grows with every round; ``DataFrame.checkpoint`` writes the state to the shared
checkpoint folder, so a lost executor recomputes from the last checkpoint and
not from the first round.
"""

from __future__ import annotations

import itertools
import os
import uuid

from pyspark.sql import DataFrame

from meridian.session import ensure_checkpoint_dir


_SEQ = itertools.count()
#: Every state that this process has written, in order.
WRITTEN: list[str] = []
#: Catalog entries of the states that are tables, by path.
TABLES: dict[str, str] = {}
_RUN = f"{os.getpid()}-{uuid.uuid4().hex[:8]}"


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and drop its lineage.

    The state is written as parquet under ``spark.checkpoint.dir`` and read
    back.  Unlike ``DataFrame.checkpoint`` this gives the optimizer the real
    size of the state: a checkpointed plan keeps the size *estimate* of the
    plan that produced it, and in a loop of joins those estimates multiply
    round after round until planning itself dominates.  The files survive the
    loss of an executor (the folder is shared)."""
    return cut_at(df)[0]


def cut_at(df: DataFrame) -> tuple[DataFrame, str]:
    """``cut``, and where the state was written (for ``delete``)."""
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark)
    path = f"{base.rstrip('/')}/meridian-state-{_RUN}/{next(_SEQ):06d}"
    df.write.mode("overwrite").parquet(path)
    WRITTEN.append(path)
    return spark.read.parquet(path), path


def delete(spark, path: str) -> None:
    """Remove a state that nothing reads any more, and its catalog entry."""
    if path in TABLES:
        spark.sql(f"DROP TABLE IF EXISTS {TABLES.pop(path)}")
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def keep(df: DataFrame, bag: list | None = None) -> DataFrame:
    """Keep a temporary that one loop step reads several times (memory, then
    disk).  Unlike ``cut`` the lineage stays; use it only for values whose
    lineage starts at a ``cut`` state of the same step."""
    from pyspark import StorageLevel
    out = df.persist(StorageLevel.MEMORY_AND_DISK)
    if bag is not None:
        bag.append(out)
    return out


def release(bag: list) -> None:
    """Unpersist everything ``keep`` put into ``bag``."""
    for d in bag:
        d.unpersist()
    bag.clear()


def cut_by(df: DataFrame, column: str) -> DataFrame:
    """``cut`` into a table bucketed by ``column``: a loop that joins on it shuffles only
    the other side."""
    spark = df.sparkSession
    name = f"meridian_by_{_RUN.replace('-', '_')}_{next(_SEQ)}"
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}"
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = min(n, int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets")))
    (df.repartition(n, column).write.bucketBy(n, column).option("path", path).format("parquet").saveAsTable(name))
    WRITTEN.append(path)
    TABLES[path] = name
    return spark.table(name)


class Steps:
    """The states of one loop: ``cut`` writes the next one and deletes the oldest beyond
    ``keep``, so a loop of any length holds that many states in the shared folder.

    A state must not be read after the ``keep``-th ``cut`` that follows its own."""

    def __init__(self, spark, keep: int = 2):
        self.spark = spark
        self.keep = keep
        self.paths: list[str] = []

    def cut(self, df: DataFrame) -> DataFrame:
        out, path = cut_at(df)
        self.paths.append(path)
        if len(self.paths) > self.keep:
            delete(self.spark, self.paths.pop(0))
        return out

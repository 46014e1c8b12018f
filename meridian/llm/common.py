"""Helpers shared by the training-data operators.

*Block tables.*  Several operators work in two passes: a first pass sends
compact facts about the rows of a block (an input partition) to owners, and the
owners' answers come back to the block.  ``BlockTable`` writes the rows once, in
the shared folder, bucketed by their block number, so that the second pass joins
the answers with the rows without shuffling the texts again, and a lost executor
finds the same blocks.
"""

from __future__ import annotations

import ctypes
import functools
import itertools
import os
import re
import uuid
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meridian.plans.iterate import TABLES, WRITTEN, delete
from meridian.session import ensure_checkpoint_dir

_SEQ = itertools.count()
_RUN = f"{os.getpid()}_{uuid.uuid4().hex[:8]}"

#: The white space of the contracts, space and U+0009 to U+000D.
SPACES = (" ", "\t", "\n", "\x0b", "\x0c", "\r")
#: Blocks that one partition may be cut into.
BLOCKS_PER_PARTITION = 1 << 20
#: Text bytes of one block (a longer text is a block of its own).
BLOCK_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def strip_spaces(c: Column) -> Column:
    """The text without white space (the six characters of ``SPACES``)."""
    return functools.reduce(lambda x, s: F.replace(x, F.lit(s), F.lit("")), SPACES, c)


def text_of(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def with_block_facts(t: DataFrame, facts: DataFrame, name: str, key: str = "pos") -> DataFrame:
    """Rows of a block table that ``facts`` (block, ``key``, and others) has something
    about, with it as the struct ``name``.

    The facts of a block (no more than its rows) travel to the block as one map, so
    the join is on the block alone and the rows are not shuffled."""
    rest = F.struct(*[c for c in facts.columns if c not in ("block", key)])
    by_block = facts.groupBy("block").agg(F.map_from_entries(F.collect_list(F.struct(key, rest))).alias("__facts"))
    return (t.join(by_block.hint("shuffle_hash"), "block")
            .withColumn(name, F.get(F.array(F.element_at("__facts", F.col(key))), F.lit(0)))
            .drop("__facts").where(F.col(name).isNotNull()))


def give_back() -> None:
    """Return freed memory to the system: a Python worker lives on after a task, and what
    its allocators keep counts against the executor."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):                # not this C library
        return


def tidy(body):
    """A task's function over batches that gives memory back at its end."""
    @functools.wraps(body)
    def run(batches):
        try:
            yield from body(batches)
        finally:
            give_back()
    return run


def cut_blocks(sizes: list[int], state: list[int], limit_bytes: int, limit_rows: int) -> list[int]:
    """The block of each of some consecutive rows; ``state`` (block, bytes, rows) goes on."""
    block, held, rows = state
    out = []
    for s in sizes:
        if rows and (held + s > limit_bytes or rows >= limit_rows):
            block, held, rows = block + 1, 0, 0
        held, rows = held + s, rows + 1
        out.append(block)
    state[:] = block, held, rows
    return out


def _by_bytes(limit_bytes: int, limit_rows: int):
    def body(batches):
        state, pos = [TaskContext.get().partitionId() * BLOCKS_PER_PARTITION, 0, 0], 0
        for b in batches:
            blocks = cut_blocks(b.column(b.num_columns - 1).to_pylist(), state, limit_bytes, limit_rows)
            names = [*b.schema.names[:-1], "pos", "block"]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(range(pos, pos + b.num_rows), pa.int64()),
                                              pa.array(blocks, pa.int64())], names=names)
            pos += b.num_rows
    return tidy(body)


class BlockTable:
    """Rows written once, bucketed by block: columns ``block long, pos long`` and
    those of ``df``.  A block is one partition of ``df``, or, with ``size`` (a row's
    bytes), consecutive rows of one: at most ``rows_per_block`` of them and, beyond a
    single row, at most ``BLOCK_BYTES``.  A ``df`` that has both columns keeps them.

    Many blocks share a bucket; there are no more buckets than the session allows."""

    def __init__(self, df: DataFrame, rows_per_block: int = 1 << 30, size: Column | None = None,
                 buckets: int | None = None, compression: str = "snappy"):
        spark = df.sparkSession
        self.spark = spark
        # Not fewer buckets than shuffle partitions: of two sides that are dealt out by
        # block already, Spark keeps the finer one where it is.
        n = buckets or max(1, df.rdd.getNumPartitions(), shuffle_partitions(spark))
        n = min(n, int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets")))
        if size is not None:
            schema = T.StructType([*df.schema.fields, T.StructField("pos", T.LongType()), T.StructField("block", T.LongType())])
            df = df.withColumn("__size", F.coalesce(size.cast("long"), F.lit(0).cast("long"))).mapInArrow(
                _by_bytes(BLOCK_BYTES, rows_per_block), schema)
        elif "block" not in df.columns:
            pos = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
            df = df.withColumn("pos", pos).withColumn("block", F.spark_partition_id().cast("long"))
        name = f"llm_blocks_{_RUN}_{next(_SEQ)}"
        path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}"
        (df.write.bucketBy(n, "block").option("path", path).option("compression", compression)
         .format("parquet").saveAsTable(name))
        WRITTEN.append(path)
        TABLES[path] = name
        self.name = name

    def df(self) -> DataFrame:
        return self.spark.table(self.name)


class Scratch:
    """What a chain of steps has written for itself, deleted step by step.

    Inside ``with scratch.step(docs):`` the paths are noted that the step writes; when
    the next step begins, they go, unless its input still reads one of them."""

    def __init__(self):
        self.paths: list[str] = []

    @contextmanager
    def step(self, docs: DataFrame):
        read = docs.inputFiles() if self.paths else []
        held = [p for p in self.paths if any(re.sub(r"^\w+:/*", "", p) + "/" in f for f in read)]
        if not held:
            for p in self.paths:
                delete(docs.sparkSession, p)
            self.paths = []
        begun = len(WRITTEN)
        yield
        self.paths += WRITTEN[begun:]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer (splitmix64 finaliser; its constants are fixed values)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x

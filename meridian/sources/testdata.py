"""Shapes of the reference's inputs, derived from the driver's parquet tables.

Each function returns a DataFrame computed by Spark from the given tables, so
the work grows with them.  The SQL oracle in ``meridian.plans.oracle`` repeats
every derivation as a CTE over the same tables.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meridian.functions.draws import hash_uniform


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """product, quantity, customer, country (one row per line item).

    All joins are left to the planner, which knows the tables' sizes."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    cu = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    na = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (li.join(od, li.l_orderkey == od.o_orderkey)
            .join(cu, F.col("o_custkey") == cu.c_custkey)
            .join(na, F.col("c_nationkey") == na.n_nationkey)
            .select(F.col("l_partkey").alias("product"),
                    (F.col("l_quantity") - 10).cast("int").alias("quantity"),
                    F.col("o_custkey").alias("customer"),
                    F.col("n_name").alias("country")))


#: Line items of one task of the self-join of ``links``.
LINES = 1 << 20


def links(spark: SparkSession, sf_dir: str, kind: str = "part") -> DataFrame:
    """directed links between two line items of one order.

    Pairs a, b with a.l_linenumber < b.l_linenumber; an order holds at most a
    few dozen lines, so the self-join on the order key is bounded per key.
    ``kind`` = 'part' (sparse graph) or 'supp' (dense graph).  A session's parts, coalesced to about
    one a core, would make a task sort ever more lines; beyond ``LINES`` a core they are cut smaller."""
    key = {"part": "l_partkey", "supp": "l_suppkey"}[kind]
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", key,
                                                 "l_returnflag", "l_linestatus")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    parts = math.ceil(li.count() / LINES)
    if parts > spark.sparkContext.defaultParallelism:
        li, od = li.repartition(parts, "l_orderkey"), od.repartition(parts, "o_orderkey")
    a = li.alias("a")
    b = li.select("l_orderkey", "l_linenumber", key).alias("b")
    pairs = a.join(b, (F.col("a.l_orderkey") == F.col("b.l_orderkey"))
                   & (F.col("a.l_linenumber") < F.col("b.l_linenumber")))
    return (pairs.join(od, F.col("a.l_orderkey") == od.o_orderkey)
            .select(F.col(f"a.{key}").alias("src"),
                    F.col(f"b.{key}").alias("dst"),
                    F.col("o_orderdate").alias("ts"),
                    F.when(F.col("a.l_returnflag") == "R", -1).otherwise(1).cast("int").alias("sentiment"),
                    F.when(F.col("a.l_linestatus") == "F", "body").otherwise("title").alias("origin")))


def points(spark: SparkSession, sf_dir: str, dims: int | None = None) -> DataFrame:
    """id, features array<double> from ``embeddings`` (first ``dims`` coordinates)."""
    e = table(spark, sf_dir, "embeddings")
    feats = F.col("embedding").cast("array<double>")
    if dims:
        feats = F.slice(feats, 1, dims)
    return e.select(F.col("vec_id").alias("id"), feats.alias("features"))


LABEL_SHARE = 0.03
MIN_LABELLED = 4


def labeled_points(spark: SparkSession, sf_dir: str, share: float = LABEL_SHARE,
                   dims: int | None = None, seed: int = 1) -> DataFrame:
    """id, features, label (-1/0/+1, 0 = hidden), y_true, is_labeled.

    About ``share`` of the ids are labelled by a hash draw; the
    ``MIN_LABELLED`` smallest draws are always labelled (a distributed top-k)."""
    e = table(spark, sf_dir, "embeddings")
    feats = F.col("embedding").cast("array<double>")
    if dims:
        feats = F.slice(feats, 1, dims)
    base = e.select(F.col("vec_id").alias("id"), feats.alias("features"),
                    F.when(F.col("label") < 5, -1).otherwise(1).cast("int").alias("y_true"),
                    hash_uniform("vec_id", seed).alias("_u"))
    forced = (base.select("id", "_u").orderBy("_u", "id").limit(MIN_LABELLED)
              .select("id", F.lit(True).alias("_forced")))
    out = base.join(F.broadcast(forced), "id", "left")
    is_lab = (F.col("_u") < F.lit(share)) | F.col("_forced").isNotNull()
    return out.select("id", "features",
                      F.when(is_lab, F.col("y_true")).otherwise(0).cast("int").alias("label"),
                      "y_true", is_lab.alias("is_labeled"))


def census_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    """a mixed categorical / numeric table with missing values and a
    two-valued target, from customer, nation and per-customer order totals."""
    cu = table(spark, sf_dir, "customer")
    na = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    od = (table(spark, sf_dir, "orders").groupBy("o_custkey")
          .agg(F.count(F.lit(1)).alias("n_orders"), F.sum("o_totalprice").alias("total_spent")))
    avg_bal = cu.agg(F.avg("c_acctbal")).first()[0]
    return (cu.join(na, cu.c_nationkey == na.n_nationkey)
            .join(od, cu.c_custkey == od.o_custkey, "left")
            .select("c_custkey",
                    F.when(F.col("c_custkey") % 17 == 0, F.lit(None).cast("string"))
                    .otherwise(F.col("c_mktsegment")).alias("c_mktsegment"),
                    "n_name",
                    F.coalesce(F.col("n_orders"), F.lit(0)).cast("bigint").alias("n_orders"),
                    F.coalesce(F.col("total_spent"), F.lit(0.0)).alias("total_spent"),
                    F.when(F.col("c_acctbal") > F.lit(avg_bal), ">avg").otherwise("<=avg").alias("target")))

"""Readers and writers for the reference's file formats.

The reference parses text lines by position; here every reader declares a
schema so no inference pass is made and the parse is a JVM-side projection.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TRANSACTION_FIELDS = 8  # positional layout: 1 = product, 3 = quantity, 6 = customer, 7 = country


def read_transactions(spark: SparkSession, path: str) -> DataFrame:
    """A1: headerless comma lines; fields 1, 3, 6, 7 are product, quantity,
    customer, country; the other fields are kept as strings."""
    schema = T.StructType([T.StructField(f"f{i}", T.StringType()) for i in range(TRANSACTION_FIELDS)])
    raw = spark.read.schema(schema).csv(path, header=False)
    return raw.select(F.col("f1").alias("product"),
                      F.col("f3").try_cast("int").alias("quantity"),
                      F.col("f6").try_cast("bigint").alias("customer"),
                      F.col("f7").alias("country"),
                      *[F.col(f"f{i}") for i in (0, 2, 4, 5)])


def read_points(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """A2: one point per line of comma-separated floats, any dimension.

    ``id`` follows the input order (``monotonically_increasing_id`` is
    increasing in file order within and across splits)."""
    lines = spark.read.text(path).filter(F.trim("value") != "")
    pts = lines.select(F.monotonically_increasing_id().alias("id"),
                       F.transform(F.split(F.trim("value"), r"\s*,\s*"),
                                   lambda x: x.try_cast("double")).alias("features"))
    return pts.repartition(partitions) if partitions else pts


# The header of the tab-separated link files, in file order.
LINK_SCHEMA = T.StructType([
    T.StructField("SOURCE_SUBREDDIT", T.StringType()),
    T.StructField("TARGET_SUBREDDIT", T.StringType()),
    T.StructField("POST_ID", T.StringType()),
    T.StructField("TIMESTAMP", T.StringType()),
    T.StructField("LINK_SENTIMENT", T.IntegerType()),
    T.StructField("PROPERTIES", T.StringType()),
])


def read_links(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """A3: tab-separated link files with a header, one per origin
    (e.g. {'body': ..., 'title': ...}); appended with an ``origin`` column."""
    out = None
    for origin, path in paths.items():
        df = (spark.read.schema(LINK_SCHEMA).option("sep", "\t").option("header", True).csv(path)
              .select(F.col("SOURCE_SUBREDDIT").alias("src"), F.col("TARGET_SUBREDDIT").alias("dst"),
                      F.to_timestamp_ntz(F.col("TIMESTAMP")).alias("ts"),
                      F.col("LINK_SENTIMENT").alias("sentiment"), F.lit(origin).alias("origin")))
        out = df if out is None else out.unionByName(df)
    return out


CENSUS_COLUMNS = [
    ("age", T.IntegerType()), ("workclass", T.StringType()), ("fnlwgt", T.IntegerType()),
    ("education", T.StringType()), ("education_num", T.IntegerType()),
    ("marital_status", T.StringType()), ("occupation", T.StringType()),
    ("relationship", T.StringType()), ("race", T.StringType()), ("sex", T.StringType()),
    ("capital_gain", T.IntegerType()), ("capital_loss", T.IntegerType()),
    ("hours_per_week", T.IntegerType()), ("native_country", T.StringType()), ("income", T.StringType()),
]


def read_census(spark: SparkSession, path: str) -> DataFrame:
    """A4: ', '-separated, no header, given names, '?' is missing."""
    schema = T.StructType([T.StructField(n, t) for n, t in CENSUS_COLUMNS])
    return (spark.read.schema(schema).option("sep", ",").option("ignoreLeadingWhiteSpace", True)
            .option("ignoreTrailingWhiteSpace", True).option("nullValue", "?").csv(path))


def write_result(df: DataFrame, path: str, fmt: str = "csv", mode: str = "overwrite") -> None:
    """A5: write a result table (CSV with header, or parquet)."""
    w = df.write.mode(mode)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)


def read_node_attribute(spark: SparkSession, path: str, value: str = "community",
                        value_type: str = "bigint") -> DataFrame:
    """Read a saved node -> value file (CSV with header ``node,<value>``)."""
    schema = f"node bigint, {value} {value_type}"
    return spark.read.schema(schema).option("header", True).csv(path)


def repartition_cache(df: DataFrame, k: int) -> DataFrame:
    """Spread into ``k`` partitions and keep in memory (spilling to disk)."""
    from pyspark import StorageLevel
    return df.repartition(k).persist(StorageLevel.MEMORY_AND_DISK)


def table_profile(tables: dict[str, DataFrame]) -> DataFrame:
    """Per table its row count and number of columns (one count job each)."""
    spark = next(iter(tables.values())).sparkSession
    rows = [(name, int(df.count()), len(df.columns)) for name, df in tables.items()]
    return spark.createDataFrame(rows, "table_name string, n_rows bigint, n_columns int")

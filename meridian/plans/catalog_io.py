"""Registered reader and writer queries: a given table is written by Spark in the source's
text form, in the checkpoint folder, and read back with the reader."""

from __future__ import annotations

import itertools

from pyspark.sql import functions as F

from meridian.plans.catalog import query
from meridian.plans.iterate import WRITTEN
from meridian.session import ensure_checkpoint_dir
from meridian.sources import io
from meridian.sources import testdata as T

_SEQ = itertools.count()


def _place(spark, name: str) -> str:
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/text-{name}-{next(_SEQ)}"
    WRITTEN.append(path)
    return path


@query("read_transactions", "SELECT CAST(product AS VARCHAR) AS product, quantity, customer, country FROM transactions",
       ("transactions",))
def q_read_transactions(spark, d):
    path = _place(spark, "transactions")
    t = T.transactions(spark, d)
    t.select(F.lit("i"), "product", F.lit("d"), "quantity", F.lit("t"), F.lit("p"), "customer", "country").toDF(
        *[f"f{i}" for i in range(8)]).write.csv(path)
    return io.read_transactions(spark, path).select("product", "quantity", "customer", "country")


@query("read_points", "SELECT features FROM points", ("points",))
def q_read_points(spark, d):
    path = _place(spark, "points")
    T.points(spark, d).select(F.concat_ws(",", F.transform("features", lambda x: x.cast("string")))).write.text(path)
    return io.read_points(spark, path).select("features")


@query("read_links", "SELECT CAST(src AS VARCHAR) AS src, CAST(dst AS VARCHAR) AS dst, ts, sentiment, origin FROM links_part",
       ("links_part",))
def q_read_links(spark, d):
    lk = T.links(spark, d, "part")
    paths = {}
    for origin in ("body", "title"):
        paths[origin] = _place(spark, f"links-{origin}")
        rows = lk.where(F.col("origin") == origin).select(
            "src", "dst", F.lit("p"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), "sentiment", F.lit("x"))
        rows.toDF(*io.LINK_SCHEMA.names).write.option("sep", "\t").option("header", True).csv(paths[origin])
    return io.read_links(spark, paths)


@query("read_census", """
SELECT CAST(n_orders AS INTEGER) AS age, c_mktsegment AS workclass, n_name AS native_country, target AS income FROM census_like""",
       ("census_like",))
def q_read_census(spark, d):
    path = _place(spark, "census")
    t = T.census_like(spark, d)
    given = {"age": F.col("n_orders"), "workclass": F.coalesce("c_mktsegment", F.lit("?")), "native_country": F.col("n_name"),
             "income": F.col("target")}
    fields = [F.concat(F.lit("" if i == 0 else " "), given.get(n, F.lit("0")).cast("string")) for i, (n, _) in
              enumerate(io.CENSUS_COLUMNS)]
    t.select(F.concat_ws(",", *fields)).write.text(path)
    return io.read_census(spark, path).select(*given)


@query("write_read_node_attribute", "SELECT node, degree AS community FROM degree_part", ("degree_part",))
def q_node_attribute(spark, d):
    from meridian.operators.graph import build as GB
    from meridian.operators.graph.degree import degree
    path = _place(spark, "attribute")
    io.write_result(degree(GB.build_graph(T.links(spark, d, "part"))).withColumnRenamed("degree", "community"), path)
    return io.read_node_attribute(spark, path)

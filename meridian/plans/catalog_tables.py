"""Registered table-cleaning, set and community-table queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from meridian.operators import relational as R
from meridian.operators import ssl as S
from meridian.operators.graph import build as GB
from meridian.operators.graph import components as GC
from meridian.operators.graph import degree as GD
from meridian.plans.catalog import NODE, query
from meridian.sources import testdata as T

FIRST_N = 1000
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


def _comp(spark, d):
    return GC.connected_components(GB.build_graph(T.links(spark, d, "part")))


# ------------------------------------------------------------ census-like table (OPT)

@query("census_like", "SELECT * FROM census_like", ("census_like",))
def q_census(spark, d):
    return T.census_like(spark, d)


@query("first_n_rows", f"SELECT * FROM census_like ORDER BY c_custkey LIMIT {FIRST_N}", ("census_like",))
def q_first_n(spark, d):
    return R.first_n_rows(T.census_like(spark, d), FIRST_N, "c_custkey")


_CENSUS_COLS = ("c_custkey", "c_mktsegment", "n_name", "n_orders", "total_spent", "target")


@query("null_counts", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column, CAST(count(*) - count({c}) AS BIGINT) AS n_null FROM census_like"
    for c in _CENSUS_COLS), ("census_like",))
def q_nulls(spark, d):
    return R.null_counts(T.census_like(spark, d))


@query("drop_null_rows", "SELECT * FROM census_like WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in _CENSUS_COLS),
       ("census_like",))
def q_dropna(spark, d):
    return R.drop_null_rows(T.census_like(spark, d))


@query("recode_labels", "SELECT *, CAST(CASE WHEN target = '>avg' THEN 1 ELSE -1 END AS INTEGER) AS y "
       "FROM census_like", ("census_like",))
def q_recode(spark, d):
    return R.recode_labels(T.census_like(spark, d), "target", ">avg")


@query("string_columns", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column, CAST(count(DISTINCT {c}) AS BIGINT) AS n_levels, CAST(count(*) - count({c}) AS BIGINT) AS n_null "
    "FROM census_like" for c in ("c_mktsegment", "n_name", "target")), ("census_like",))
def q_string_cols(spark, d):
    return R.string_columns(T.census_like(spark, d))


@query("one_hot", "SELECT c_custkey, n_orders, total_spent, target, n_name, "
       + ", ".join(f"CAST(c_mktsegment = '{v}' AS INTEGER) AS c_mktsegment_{v}" for v in SEGMENTS)
       + " FROM census_like WHERE c_mktsegment IS NOT NULL", ("census_like",))
def q_one_hot(spark, d):
    c = R.drop_null_rows(T.census_like(spark, d))
    return R.one_hot(c, ["c_mktsegment"])


@query("feature_vector", "SELECT c_custkey, [CAST(n_orders AS DOUBLE), total_spent] AS features FROM census_like",
       ("census_like",))
def q_feature_vector(spark, d):
    return R.feature_vector(T.census_like(spark, d), ["n_orders", "total_spent"]).select("c_custkey", "features")


@query("prepare_census", f"""
SELECT c_custkey AS id,
       [CAST(n_orders AS DOUBLE), total_spent, {', '.join(f"CAST(c_mktsegment = '{v}' AS DOUBLE)" for v in SEGMENTS)}]
         AS features,
       CAST(CASE WHEN target = '>avg' THEN 1 ELSE -1 END AS INTEGER) AS y
FROM census_like WHERE c_mktsegment IS NOT NULL""",
       ("census_like",))
def q_prepare(spark, d):
    return S.prepare_census(T.census_like(spark, d), ["c_mktsegment"], ["n_orders", "total_spent"],
                            "target", ">avg", "c_custkey")


# ------------------------------------------------------------ labelled points (OPT)

@query("labeled_points", "SELECT * FROM labeled_points", ("labeled_points",))
def q_labeled(spark, d):
    return T.labeled_points(spark, d)


@query("class_balance", "SELECT label, is_labeled, CAST(count(*) AS BIGINT) AS n FROM labeled_points "
       "GROUP BY label, is_labeled", ("labeled_points",))
def q_balance(spark, d):
    return R.class_balance(T.labeled_points(spark, d))


@query("unlabeled_rows", "SELECT id, y_true FROM labeled_points WHERE NOT is_labeled", ("labeled_points",))
def q_unlabeled(spark, d):
    lp = T.labeled_points(spark, d)
    return R.unlabeled_rows(lp, lp.filter("is_labeled")).select("id", "y_true")


@query("index_difference", "SELECT id FROM labeled_points EXCEPT SELECT id FROM labeled_points WHERE is_labeled",
       ("labeled_points",))
def q_index_difference(spark, d):
    lp = T.labeled_points(spark, d)
    return R.index_difference(lp, lp.filter("is_labeled"))


# ------------------------------------------------------------ community tables

@query("community_of", f"""
SELECT node, component FROM comp_part WHERE component = (SELECT component FROM comp_part WHERE node = {NODE})""",
       ("comp_part",))
def q_community_of(spark, d):
    return R.community_of(_comp(spark, d), NODE, comm_col="component")


@query("induced_subgraph", f"""
SELECT e.* FROM edges_part e
WHERE e.u IN (SELECT node FROM comp_part WHERE component = (SELECT component FROM comp_part WHERE node = {NODE}))
  AND e.v IN (SELECT node FROM comp_part WHERE component = (SELECT component FROM comp_part WHERE node = {NODE}))""",
       ("comp_part", "edges_part"))
def q_induced(spark, d):
    e = GB.build_graph(T.links(spark, d, "part"))
    comp = GC.connected_components(e)
    members = R.community_of(comp, NODE, comm_col="component")
    return R.induced_subgraph(e, members)


@query("community_summary", """
SELECT CAST(count(*) AS BIGINT) AS n_communities, CAST(max(size) AS BIGINT) AS largest_size
FROM (SELECT component, count(*) AS size FROM comp_part GROUP BY component)""", ("comp_part",))
def q_comm_summary(spark, d):
    return R.community_summary(_comp(spark, d), "component")


@query("distinct_communities", """
WITH lab AS (SELECT node, component AS community FROM comp_part
             UNION ALL
             SELECT c.node, m.mx + 1000000000 AS community FROM comp_part c
             JOIN (SELECT component, max(node) AS mx FROM comp_part GROUP BY component) m
               ON c.component = m.component),
sig AS (SELECT community, string_agg(CAST(node AS VARCHAR), ',' ORDER BY node) AS members FROM lab GROUP BY community),
keep AS (SELECT min(community) AS community FROM sig GROUP BY members)
SELECT node, community FROM lab WHERE community IN (SELECT community FROM keep)""", ("comp_part",))
def q_distinct_comm(spark, d):
    comp = _comp(spark, d)
    mx = comp.groupBy("component").agg(F.max("node").alias("_mx"))
    lab = (comp.select("node", F.col("component").alias("community"))
           .unionByName(comp.join(mx, "component")
                        .select("node", (F.col("_mx") + F.lit(1000000000)).alias("community"))))
    return R.distinct_communities(lab)


@query("largest_gap", """
WITH v AS (SELECT row_number() OVER (ORDER BY degree) AS pos, CAST(degree AS DOUBLE) AS value
           FROM (SELECT DISTINCT degree FROM degree_part)),
g AS (SELECT pos, value, lead(value) OVER (ORDER BY pos) - value AS gap FROM v)
SELECT pos, value, gap FROM g WHERE gap IS NOT NULL ORDER BY gap DESC, pos DESC LIMIT 1""", ("degree_part",))
def q_largest_gap(spark, d):
    from pyspark.sql import Window
    deg = GD.degree(GB.build_graph(T.links(spark, d, "part"))).select("degree").distinct()
    v = deg.select(F.row_number().over(Window.orderBy("degree")).alias("pos"),
                   F.col("degree").cast("double").alias("value"))
    return R.largest_gap(v)


@query("kth_largest_distance")
def q_kth(spark, d):
    from meridian.plans.catalog_vectors import KC_Z
    from meridian.functions.vectors import euclidean
    from meridian.operators.vectors import vectors_literal
    pts = T.points(spark, d)
    ref = vectors_literal([pts.orderBy("id").limit(1).first().features])[0]
    dd = pts.select(euclidean(F.col("features"), ref).alias("distance"))
    v = R.kth_largest(dd, "distance", KC_Z + 1)
    return spark.createDataFrame([(round(v, 6),)], "kth_largest double")


def _kth_sql():
    from meridian.plans import oracle as O
    from meridian.plans.catalog_vectors import KC_Z, sq
    O.register("kth_largest_distance", f"""
SELECT round(min(d), 6) AS kth_largest FROM (
  SELECT sqrt({sq('p.features', 'f.features')}) AS d
  FROM points p, (SELECT features FROM points ORDER BY id LIMIT 1) f ORDER BY d DESC LIMIT {KC_Z + 1})""",
               "points")


_kth_sql()

"""Registered queries: the reference's operators run on the driver's tables.

``QUERIES[name](spark, sf_dir)`` returns a DataFrame; ``oracle.ORACLE[name]``
(when present) is the DuckDB SQL with the same column names and values.
Every query reads whole tables; floating outputs are rounded to
``ROUND_DIGITS`` on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meridian.operators import relational as R
from meridian.operators.graph import build as GB
from meridian.plans import oracle as O
from meridian.sources import testdata as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
RD = O.ROUND_DIGITS


def query(name: str, sql: str | None = None, ctes: tuple[str, ...] = ()):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            O.register(name, sql, *ctes)
        return fn
    return deco


def rnd(c, digits: int = RD):
    return F.round(F.col(c) if isinstance(c, str) else c, digits)


# Fixed parameters of the registered queries.
SALT_GROUPS = 8        # K in the popularity program
TOP_H = 10             # H
COUNTRY = "NATION_3"   # S
YEARS = (1997, 1998)
NODE = 7               # a part key present at every scale factor
OTHER = 1
KEYWORDS = ("12", "777")


def _pairs(spark, d, country="all"):
    t = R.country_filter(R.positive_quantity(T.transactions(spark, d)), country)
    return R.distinct_product_customer(t)


# ------------------------------------------------------------ product popularity

@query("transactions", "SELECT * FROM transactions", ("transactions",))
def q_transactions(spark, d):
    return T.transactions(spark, d)


@query("positive_quantity", "SELECT * FROM transactions WHERE quantity > 0", ("transactions",))
def q_positive_quantity(spark, d):
    return R.positive_quantity(T.transactions(spark, d))


@query("country_filter", f"SELECT * FROM transactions WHERE country = '{COUNTRY}'", ("transactions",))
def q_country_filter(spark, d):
    return R.country_filter(T.transactions(spark, d), COUNTRY)


@query("product_customer_projection", "SELECT product, customer FROM transactions", ("transactions",))
def q_projection(spark, d):
    return R.product_customer_projection(T.transactions(spark, d))


@query("distinct_product_customer",
       "SELECT DISTINCT product, customer FROM transactions WHERE quantity > 0", ("transactions",))
def q_distinct_pairs(spark, d):
    return _pairs(spark, d)


_POP_SQL = """SELECT product, CAST(count(DISTINCT customer) AS BIGINT) AS popularity
FROM transactions WHERE quantity > 0 {flt} GROUP BY product"""


@query("product_popularity", _POP_SQL.format(flt=""), ("transactions",))
def q_popularity(spark, d):
    return R.product_popularity(_pairs(spark, d))


@query("product_popularity_country", _POP_SQL.format(flt=f"AND country = '{COUNTRY}'"), ("transactions",))
def q_popularity_country(spark, d):
    return R.product_popularity(_pairs(spark, d, COUNTRY))


@query("product_popularity_salted", _POP_SQL.format(flt=""), ("transactions",))
def q_popularity_salted(spark, d):
    return R.product_popularity_salted(_pairs(spark, d), SALT_GROUPS)


@query("top_h_products",
       "SELECT * FROM (" + _POP_SQL.format(flt="") + f") ORDER BY popularity DESC, product LIMIT {TOP_H}",
       ("transactions",))
def q_top_h(spark, d):
    return R.top_h_products(R.product_popularity(_pairs(spark, d)), TOP_H)


@query("popularity_listing",
       "SELECT product, popularity, popularity AS popularity_salted FROM (" + _POP_SQL.format(flt="")
       + ") ORDER BY product", ("transactions",))
def q_listing(spark, d):
    pairs = _pairs(spark, d)
    return R.popularity_listing(R.product_popularity(pairs), R.product_popularity_salted(pairs, SALT_GROUPS))


@query("repartition_cache", "SELECT * FROM transactions", ("transactions",))
def q_repartition_cache(spark, d):
    from meridian.sources.io import repartition_cache
    return repartition_cache(T.transactions(spark, d), SALT_GROUPS)


@query("table_profile", """
SELECT 'transactions' AS table_name, CAST(count(*) AS BIGINT) AS n_rows, 4 AS n_columns FROM transactions
UNION ALL SELECT 'links_part', CAST(count(*) AS BIGINT), 5 FROM links_part""", ("transactions", "links_part"))
def q_table_profile(spark, d):
    from meridian.sources.io import table_profile
    return table_profile({"transactions": T.transactions(spark, d),
                          "links_part": T.links(spark, d, "part")})


# ------------------------------------------------------------ hyperlink tables

@query("links_part", "SELECT * FROM links_part", ("links_part",))
def q_links(spark, d):
    return T.links(spark, d, "part")


@query("union_links", "SELECT * FROM links_part WHERE origin = 'body' UNION ALL "
       "SELECT * FROM links_part WHERE origin = 'title'", ("links_part",))
def q_union_links(spark, d):
    lk = T.links(spark, d, "part")
    return R.union_links(lk.filter(F.col("origin") == "body"), lk.filter(F.col("origin") == "title"))


@query("drop_negative_links", "SELECT * FROM links_part WHERE sentiment IS DISTINCT FROM -1", ("links_part",))
def q_drop_negative(spark, d):
    return R.drop_negative_links(T.links(spark, d, "part"))


@query("filter_years", f"SELECT * FROM links_part WHERE year(ts) IN {YEARS}", ("links_part",))
def q_filter_years(spark, d):
    return R.filter_years(T.links(spark, d, "part"), YEARS)


@query("directed_pair_filter",
       f"SELECT * FROM links_supp WHERE (src = {NODE} AND dst = {OTHER}) OR (src = {OTHER} AND dst = {NODE})",
       ("links_supp",))
def q_pair_filter(spark, d):
    lk = T.links(spark, d, "supp")
    return R.directed_pair_filter(lk, NODE, OTHER).unionByName(R.directed_pair_filter(lk, OTHER, NODE))


@query("node_keyword_search", """
SELECT name FROM (SELECT CAST(src AS VARCHAR) AS name FROM links_part
                  UNION SELECT CAST(dst AS VARCHAR) FROM links_part)
WHERE """ + " OR ".join(f"contains(lower(name), '{k}')" for k in KEYWORDS), ("links_part",))
def q_keyword(spark, d):
    return R.node_keyword_search(T.links(spark, d, "part"), KEYWORDS)


@query("year_month", "SELECT src, dst, strftime(ts, '%Y-%m') AS year_month FROM links_part", ("links_part",))
def q_year_month(spark, d):
    return T.links(spark, d, "part").select("src", "dst", R.year_month("ts").alias("year_month"))


_D4_SQL = """
SELECT strftime(ts, '%Y-%m') AS year_month,
       CAST(sum(CASE WHEN {i} THEN 1 ELSE 0 END) AS BIGINT) AS in_degree,
       CAST(sum(CASE WHEN {o} THEN 1 ELSE 0 END) AS BIGINT) AS out_degree
FROM {t} WHERE sentiment IS DISTINCT FROM -1 AND (({i}) OR ({o})) GROUP BY 1 ORDER BY 1"""


@query("monthly_in_out_degree", _D4_SQL.format(t="links_part", i=f"dst = {NODE}", o=f"src = {NODE}"), ("links_part",))
def q_monthly(spark, d):
    return R.monthly_in_out_degree(R.drop_negative_links(T.links(spark, d, "part")), NODE)


@query("monthly_pair_interactions",
       _D4_SQL.format(t="links_supp", i=f"src = {OTHER} AND dst = {NODE}", o=f"src = {NODE} AND dst = {OTHER}"),
       ("links_supp",))
def q_monthly_pair(spark, d):
    return R.monthly_in_out_degree(R.drop_negative_links(T.links(spark, d, "supp")), NODE, OTHER)


@query("link_weights", "SELECT * FROM wdir_part", ("wdir_part",))
def q_link_weights(spark, d):
    return R.link_weights(R.drop_negative_links(T.links(spark, d, "part")))


@query("all_nodes", "SELECT src AS node FROM links_part UNION SELECT dst FROM links_part", ("links_part",))
def q_all_nodes(spark, d):
    return R.all_nodes(T.links(spark, d, "part"))


# ------------------------------------------------------------ graph construction

@query("build_graph_part", "SELECT * FROM edges_part", ("edges_part",))
def q_build_part(spark, d):
    return GB.build_graph(T.links(spark, d, "part"))


@query("build_graph_supp", "SELECT * FROM edges_supp", ("edges_supp",))
def q_build_supp(spark, d):
    return GB.build_graph(T.links(spark, d, "supp"))


@query("build_graph_years", f"""
SELECT a.src AS u, a.dst AS v, least(a.weight, b.weight) AS weight
FROM (SELECT src, dst, CAST(count(*) AS BIGINT) AS weight FROM links_supp
      WHERE sentiment IS DISTINCT FROM -1 AND year(ts) IN {YEARS} GROUP BY src, dst) a
JOIN (SELECT src, dst, CAST(count(*) AS BIGINT) AS weight FROM links_supp
      WHERE sentiment IS DISTINCT FROM -1 AND year(ts) IN {YEARS} GROUP BY src, dst) b
  ON a.src = b.dst AND a.dst = b.src WHERE a.src <= a.dst""", ("links_supp",))
def q_build_years(spark, d):
    return GB.build_graph(T.links(spark, d, "supp"), YEARS)


@query("inverse_weights", "SELECT u, v, weight, round(1.0 / weight, 6) AS inv_weight FROM edges_supp "
       "WHERE weight <> 0", ("edges_supp",))
def q_inverse_weights(spark, d):
    e = R.inverse_weights(GB.build_graph(T.links(spark, d, "supp")))
    return e.withColumn("inv_weight", rnd("inv_weight"))

"""Relational steps: filters, projections, joins, aggregations, rankings, set ops.

Everything here is a plain DataFrame plan: filters and projections reach the
parquet scan, aggregations run partial (map side) then final, and top-k uses
``orderBy(..).limit(..)`` which Spark plans as TakeOrderedAndProject (a
per-partition top-k, never a full sort).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meridian.operators.scan import Ranges
from meridian.functions.draws import hash_int


# ---------------------------------------------------------------- filters (B)

def positive_quantity(df: DataFrame, col: str = "quantity") -> DataFrame:
    """B1: keep rows with quantity > 0."""
    return df.filter(F.col(col) > 0)


def country_filter(df: DataFrame, country: str, col: str = "country") -> DataFrame:
    """B2: keep one country; ``'all'`` keeps every row."""
    return df if country == "all" else df.filter(F.col(col) == country)


def product_customer_projection(df: DataFrame) -> DataFrame:
    """Row -> (product, customer)."""
    return df.select("product", "customer")


def drop_negative_links(links: DataFrame) -> DataFrame:
    """Drop links whose sentiment is -1; any other value is kept."""
    return links.filter(~F.col("sentiment").eqNullSafe(-1))


def filter_years(links: DataFrame, years, ts: str = "ts") -> DataFrame:
    """Keep links of the given years."""
    return links.filter(F.year(ts).isin([int(y) for y in years]))


def directed_pair_filter(links: DataFrame, a, b) -> DataFrame:
    """Links a -> b only."""
    return links.filter((F.col("src") == F.lit(a)) & (F.col("dst") == F.lit(b)))


def node_keyword_search(links: DataFrame, keywords) -> DataFrame:
    """Distinct node names (sources and targets) that contain any keyword,
    compared case-folded."""
    nodes = all_nodes(links).select(F.col("node").cast("string").alias("name"))
    cond = None
    for k in keywords:
        c = F.lower(F.col("name")).contains(str(k).lower())
        cond = c if cond is None else (cond | c)
    return nodes.filter(cond)


def first_n_rows(df: DataFrame, n: int, order_col: str) -> DataFrame:
    """The first ``n`` rows in an explicit order (file order is not a
    DataFrame notion, so the caller names the order column)."""
    return df.orderBy(order_col).limit(n)


def null_counts(df: DataFrame) -> DataFrame:
    """Number of missing values per column, one row per column.

    One aggregation pass computes every count; the wide result row is then
    unpivoted into (column, n_null)."""
    cols = df.columns
    wide = df.agg(*[F.sum(F.when(F.col(c).isNull(), 1).otherwise(0)).cast("bigint").alias(c)
                    for c in cols])
    return wide.unpivot([], cols, "column", "n_null")


def drop_null_rows(df: DataFrame) -> DataFrame:
    """Drop rows with any missing value."""
    return df.dropna(how="any")


def recode_labels(df: DataFrame, col: str, positive, out: str = "y") -> DataFrame:
    """A two-valued column -> +1 (``positive``) / -1."""
    return df.withColumn(out, F.when(F.col(col) == F.lit(positive), 1).otherwise(-1).cast("int"))


def string_columns(df: DataFrame) -> DataFrame:
    """The categorical (string) columns with their levels and missing values,
    counted in one aggregation."""
    names = [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    wide = df.agg(*[F.struct(F.countDistinct(c).alias("n_levels"), F.sum(F.col(c).isNull().cast("long")).alias("n_null")).alias(c)
                    for c in names]) if names else df.limit(0).agg(F.count(F.lit(1)))
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"`{c}`.n_levels").alias("n_levels"),
                     F.coalesce(F.col(f"`{c}`.n_null"), F.lit(0)).cast("bigint").alias("n_null")) for c in names]
    empty = F.array().cast("array<struct<column:string,n_levels:bigint,n_null:bigint>>")
    return wide.select(F.inline(F.array(*rows) if rows else empty))


MAX_LEVELS = 1000


def one_hot(df: DataFrame, cols: list[str], drop_original: bool = True, max_levels: int = MAX_LEVELS) -> DataFrame:
    """One 0/1 integer column ``<col>_<value>`` per category value.

    The distinct values of each column are a distributed aggregation; a column with
    more than ``max_levels`` of them is refused, since the table would get that many
    columns.  The encoding is one narrow projection."""
    keep = [F.col(c) for c in df.columns if not (drop_original and c in cols)]
    hot = []
    for c in cols:
        rows = df.select(c).where(F.col(c).isNotNull()).distinct().limit(max_levels + 1).collect()
        if len(rows) > max_levels:
            raise ValueError(f"{c} has more than {max_levels} levels")
        hot += [(F.col(c) == F.lit(v)).cast("int").alias(f"{c}_{v}") for v in sorted(r[0] for r in rows)]
    return df.select(*keep, *hot)


def feature_vector(df: DataFrame, cols: list[str], out: str = "features") -> DataFrame:
    """Numeric columns -> one ``array<double>`` column."""
    return df.withColumn(out, F.array(*[F.col(c).cast("double") for c in cols]))


def inverse_weights(edges: DataFrame, weight: str = "weight", out: str = "inv_weight") -> DataFrame:
    """Weight -> 1/weight; rows with weight 0 are dropped."""
    return edges.filter(F.col(weight) != 0).withColumn(out, F.lit(1.0) / F.col(weight))


def year_month(ts: str = "ts"):
    """Timestamp -> 'yyyy-MM'."""
    return F.date_format(F.col(ts), "yyyy-MM")


# ---------------------------------------------------------------- joins (C)

def community_of(assign: DataFrame, node, node_col: str = "node", comm_col: str = "community") -> DataFrame:
    """Every node in the same community as ``node`` (a semi join)."""
    target = assign.filter(F.col(node_col) == F.lit(node)).select(comm_col)
    return assign.join(target, comm_col, "left_semi")


def flag_candidate_pairs(scores: DataFrame, train: DataFrame, held_out: DataFrame) -> DataFrame:
    """Flag scored pairs 0 = training edge, 1 = held-out edge, 2 = other.

    Pairs are canonical (u < v) on every side."""
    tr = train.select("u", "v", F.lit(0).alias("_f0"))
    ho = held_out.select("u", "v", F.lit(1).alias("_f1"))
    return (scores.join(tr, ["u", "v"], "left").join(ho, ["u", "v"], "left")
            .withColumn("flag", F.coalesce("_f0", "_f1", F.lit(2)).cast("int"))
            .drop("_f0", "_f1"))


def unlabeled_rows(df: DataFrame, labelled: DataFrame, key: str = "id") -> DataFrame:
    """Rows whose key is not in the labelled set (anti join)."""
    return df.join(labelled.select(key), key, "left_anti")


def induced_subgraph(edges: DataFrame, nodes: DataFrame, node_col: str = "node") -> DataFrame:
    """Edges whose two ends are both in ``nodes`` (two semi joins)."""
    n = nodes.select(F.col(node_col).alias("_n"))
    return (edges.join(n, edges.u == n._n, "left_semi")
            .join(n, edges.v == n._n, "left_semi"))


# ---------------------------------------------------------------- aggregations (D)

def distinct_product_customer(df: DataFrame) -> DataFrame:
    """Distinct (product, customer) pairs."""
    return df.select("product", "customer").distinct()


def product_popularity(pairs: DataFrame) -> DataFrame:
    """Number of distinct customers per product.

    ``pairs`` is already distinct; the count runs partial per partition then
    final, so a product holding a third of the rows contributes one partial row
    per partition to the shuffle."""
    return pairs.groupBy("product").agg(F.count(F.lit(1)).cast("bigint").alias("popularity"))


def product_popularity_salted(pairs: DataFrame, k: int) -> DataFrame:
    """D3: same result in two rounds over ``k`` groups; the group is a hash of
    the customer (stable on recompute), so a hot product is split k ways."""
    salted = (pairs.groupBy("product", F.pmod(hash_int("customer"), F.lit(k)).alias("_salt"))
              .agg(F.count(F.lit(1)).alias("_n")))
    return salted.groupBy("product").agg(F.sum("_n").cast("bigint").alias("popularity"))


def monthly_in_out_degree(links: DataFrame, node, other=None) -> DataFrame:
    """Links per month into and out of ``node`` (or, with ``other``,
    other -> node as 'in' and node -> other as 'out'); ordered by month."""
    if other is None:
        is_in = F.col("dst") == F.lit(node)
        is_out = F.col("src") == F.lit(node)
    else:
        is_in = (F.col("src") == F.lit(other)) & (F.col("dst") == F.lit(node))
        is_out = (F.col("src") == F.lit(node)) & (F.col("dst") == F.lit(other))
    return (links.filter(is_in | is_out)
            .groupBy(year_month("ts").alias("year_month"))
            .agg(F.sum(F.when(is_in, 1).otherwise(0)).cast("bigint").alias("in_degree"),
                 F.sum(F.when(is_out, 1).otherwise(0)).cast("bigint").alias("out_degree"))
            .orderBy("year_month"))


def link_weights(links: DataFrame) -> DataFrame:
    """Links per (src, dst)."""
    return links.groupBy("src", "dst").agg(F.count(F.lit(1)).cast("bigint").alias("weight"))


def component_size_distribution(comp: DataFrame, comp_col: str = "component") -> DataFrame:
    """Component size -> number of components."""
    sizes = comp.groupBy(comp_col).agg(F.count(F.lit(1)).cast("bigint").alias("size"))
    return sizes.groupBy("size").agg(F.count(F.lit(1)).cast("bigint").alias("n_components"))


def degree_distribution(deg: DataFrame, col: str = "degree") -> DataFrame:
    """Per distinct degree: count, share, CDF and CCDF = P(K > k).

    The running sums are windows over the distribution table, whose size is
    the number of distinct degrees (at most sqrt(2|E|)+1), not the node count;
    CDF/CCDF come from integer running counts so the last CCDF is exactly 0."""
    dist = deg.groupBy(F.col(col).alias("degree")).agg(F.count(F.lit(1)).cast("bigint").alias("n_nodes"))
    w = Window.orderBy("degree").rowsBetween(Window.unboundedPreceding, 0)
    total = Window.partitionBy()
    cum = F.sum("n_nodes").over(w)
    tot = F.sum("n_nodes").over(total)
    return dist.select("degree", "n_nodes",
                       (F.col("n_nodes") / tot).alias("share"),
                       (cum / tot).alias("cdf"),
                       ((tot - cum) / tot).alias("ccdf"))


def value_share(df: DataFrame, col: str, value) -> DataFrame:
    """Share of rows whose ``col`` equals ``value``."""
    return df.agg(F.avg(F.when(F.col(col) == F.lit(value), 1.0).otherwise(0.0)).alias("share"))


def histogram(df: DataFrame, col: str, bins: int = 5) -> DataFrame:
    """Equal-width bins between min and max (last bin closed), with empty
    bins listed.  Min and max come from one distributed aggregation."""
    lo, hi = df.agg(F.min(col), F.max(col)).first()
    spark = df.sparkSession
    if lo is None:
        return spark.createDataFrame([], "bin int, lower double, upper double, count bigint")
    lo, hi = float(lo), float(hi)
    width = (hi - lo) / bins if hi > lo else 1.0
    b = F.least(F.floor((F.col(col) - F.lit(lo)) / F.lit(width)).cast("int"), F.lit(bins - 1))
    counts = df.filter(F.col(col).isNotNull()).groupBy(b.alias("bin")).agg(
        F.count(F.lit(1)).cast("bigint").alias("count"))
    edges = (spark.range(bins).select(F.col("id").cast("int").alias("bin"))
             .withColumn("lower", F.lit(lo) + F.col("bin") * F.lit(width))
             .withColumn("upper", F.lit(lo) + (F.col("bin") + 1) * F.lit(width)))
    return (edges.join(F.broadcast(counts), "bin", "left")
            .select("bin", "lower", "upper", F.coalesce("count", F.lit(0)).cast("bigint").alias("count")))


def global_clustering(cc: DataFrame, col: str = "clustering") -> DataFrame:
    """Mean of the clustering coefficients."""
    return cc.agg(F.avg(col).alias("avg_clustering"))


def molloy_reed_ratio(deg: DataFrame, col: str = "degree", by: list[str] | None = None) -> DataFrame:
    """<k^2>/<k> (optionally per group) and the test ratio <= 2."""
    g = deg.groupBy(*(by or []))
    out = g.agg((F.avg(F.col(col) * F.col(col)) / F.avg(col)).alias("kappa"))
    return out.withColumn("below_critical", F.col("kappa") <= 2)


def class_balance(df: DataFrame) -> DataFrame:
    """Rows per label and labelled flag."""
    return df.groupBy("label", "is_labeled").agg(F.count(F.lit(1)).cast("bigint").alias("n"))


def community_summary(assign: DataFrame, comm_col: str = "community") -> DataFrame:
    """Number of communities and the size of the largest."""
    sizes = assign.groupBy(comm_col).agg(F.count(F.lit(1)).alias("size"))
    return sizes.agg(F.count(F.lit(1)).cast("bigint").alias("n_communities"),
                     F.max("size").cast("bigint").alias("largest_size"))


# ---------------------------------------------------------------- order (E)

def top_h_products(pop: DataFrame, h: int) -> DataFrame:
    """The ``h`` most popular products; ties by product id."""
    return pop.orderBy(F.desc("popularity"), F.asc("product")).limit(h)


def popularity_listing(pop1: DataFrame, pop2: DataFrame) -> DataFrame:
    """Both popularity tables side by side, sorted by product.  Both inputs
    are aggregated by product, so the join reuses their hash partitioning."""
    return (pop1.join(pop2.withColumnRenamed("popularity", "popularity_salted"), "product", "full")
            .orderBy("product"))


def rank_nodes(df: DataFrame, score: str, n: int | None = 100, node_col: str = "node") -> DataFrame:
    """Nodes by a score (best first, ties by node); ``n=None`` keeps all."""
    out = df.orderBy(F.desc(score), F.asc(node_col))
    return out.limit(n) if n else out


def kth_largest(df: DataFrame, col: str, k: int) -> float | None:
    """The k-th largest value (distributed top-k, then min)."""
    top = df.select(col).orderBy(F.desc(col)).limit(k)
    return top.agg(F.min(col)).first()[0]


def cumulative_share(df: DataFrame, order_col: str, value_col: str, out: str = "cum_share") -> DataFrame:
    """E5: running sum over an ordered table of any size (range parts and their offsets)."""
    return Ranges(df, [F.col(order_col)]).sums(**{out: value_col})


def largest_gap(values: DataFrame, pos_col: str = "pos", value_col: str = "value") -> DataFrame:
    """Position of the largest difference between consecutive ordered
    values (the last such position on ties)."""
    gaps = Ranges(values, [F.col(pos_col)]).following(value_col, "_next")
    gaps = gaps.withColumn("gap", F.col("_next") - F.col(value_col)).drop("_next").filter(F.col("gap").isNotNull())
    return gaps.orderBy(F.desc("gap"), F.desc(pos_col)).limit(1)


def topk_per_key(df: DataFrame, key: str, score: str, k: int, item: str = "node",
                 descending: bool = True) -> DataFrame:
    """The ``k`` best rows per key, ties by item id (a window ranked
    within each key's partition)."""
    order = [F.desc(score) if descending else F.asc(score), F.asc(item)]
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def argmax_row(df: DataFrame, col: str, id_col: str = "id") -> DataFrame:
    """The row with the largest value, lowest id on ties."""
    return df.orderBy(F.desc(col), F.asc(id_col)).limit(1)


# ---------------------------------------------------------------- set ops (F)

def union_links(a: DataFrame, b: DataFrame) -> DataFrame:
    """append two link tables (UNION ALL by column name)."""
    return a.unionByName(b)


def all_nodes(links: DataFrame) -> DataFrame:
    """distinct sources union distinct targets."""
    return (links.select(F.col("src").alias("node"))
            .union(links.select(F.col("dst").alias("node"))).distinct())


def index_difference(all_ids: DataFrame, some_ids: DataFrame, key: str = "id") -> DataFrame:
    """ids not in ``some_ids`` (EXCEPT)."""
    return all_ids.select(key).subtract(some_ids.select(key))


def distinct_communities(assign: DataFrame, comm_col: str = "community", node_col: str = "node") -> DataFrame:
    """drop communities whose member set equals that of another
    (the one with the lowest id is kept).

    Member sets are compared by (size, two independent 64-bit order-free
    hash sums) computed with one aggregation, so no member list is collected
    into a single row however large a community is."""
    sig = assign.groupBy(comm_col).agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum(F.xxhash64(node_col).cast("decimal(38,0)")).alias("_h1"),
        F.sum(F.xxhash64(F.col(node_col), F.lit("salt")).cast("decimal(38,0)")).alias("_h2"))
    w = Window.partitionBy("_n", "_h1", "_h2").orderBy(comm_col)
    keep = sig.withColumn("_r", F.row_number().over(w)).filter("_r = 1").select(comm_col)
    return assign.join(keep, comm_col, "left_semi")

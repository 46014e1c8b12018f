from pyspark.sql import functions as F

from conftest import SF_SMALL
from meridian.operators import relational as R
from meridian.sources import testdata as T


def _pairs(spark):
    return R.distinct_product_customer(R.positive_quantity(T.transactions(spark, SF_SMALL)))


def test_popularity_two_ways_agree(spark):
    p = _pairs(spark)
    a = {r.product: r.popularity for r in R.product_popularity(p).collect()}
    b = {r.product: r.popularity for r in R.product_popularity_salted(p, 5).collect()}
    assert a == b and len(a) > 0


def test_popularity_matches_python(spark):
    rows = T.transactions(spark, SF_SMALL).collect()
    seen = {}
    for r in rows:
        if r.quantity > 0:
            seen.setdefault(r.product, set()).add(r.customer)
    got = {r.product: r.popularity for r in R.product_popularity(_pairs(spark)).collect()}
    assert got == {k: len(v) for k, v in seen.items()}


def test_top_h_ties_by_product(spark):
    pop = spark.createDataFrame([(3, 5), (1, 5), (2, 7), (4, 1)], "product long, popularity long")
    assert [r.product for r in R.top_h_products(pop, 3).collect()] == [2, 1, 3]


def test_country_all_keeps_everything(spark):
    t = T.transactions(spark, SF_SMALL)
    assert R.country_filter(t, "all").count() == t.count()


def test_degree_distribution_ccdf_ends_at_zero(spark):
    deg = spark.createDataFrame([(i, d) for i, d in enumerate([1, 1, 2, 3, 3, 3])], "node long, degree long")
    dist = R.degree_distribution(deg).orderBy("degree").collect()
    assert [r.n_nodes for r in dist] == [2, 1, 3]
    assert dist[-1].ccdf == 0.0 and abs(dist[0].cdf - 2 / 6) < 1e-12


def test_histogram_includes_empty_bins_and_max(spark):
    df = spark.createDataFrame([(0.0,), (0.1,), (1.0,)], "x double")
    h = R.histogram(df, "x", 5).orderBy("bin").collect()
    assert [r["count"] for r in h] == [2, 0, 0, 0, 1]


def test_distinct_communities_drops_equal_member_sets(spark):
    a = spark.createDataFrame([(1, 10), (2, 10), (1, 20), (2, 20), (3, 30)], "node long, community long")
    got = sorted((r.node, r.community) for r in R.distinct_communities(a).collect())
    assert got == [(1, 10), (2, 10), (3, 30)]


def test_null_counts_and_one_hot(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "b")], "id long, c string")
    nc = {r.column: r.n_null for r in R.null_counts(df).collect()}
    assert nc == {"id": 0, "c": 1}
    oh = R.one_hot(R.drop_null_rows(df), ["c"]).orderBy("id").collect()
    assert [(r.c_a, r.c_b) for r in oh] == [(1, 0), (0, 1)]


def test_smallest_n_exact(spark):
    from meridian.operators.sampling import smallest_n
    rows = [(i, i % 7, (i * 37) % 11) for i in range(200)]
    df = spark.createDataFrame(rows, "u long, v long, h long")
    got = sorted((r.u, r.v) for r in smallest_n(df, 23, "h", ["u", "v"]).collect())
    exp = sorted((u, v) for u, v, h in sorted(rows, key=lambda r: (r[2], r[0], r[1]))[:23])
    assert got == exp

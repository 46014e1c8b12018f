import os
import tempfile

import duckdb

from conftest import SF_SMALL
from meridian.sources import io


def test_readers_round_trip(spark):
    d = tempfile.mkdtemp(prefix="meridian-test-", dir="/tmp")
    with open(f"{d}/tx.csv", "w") as f:
        f.write("a,P1,x,3,y,z,17,Italy\nb,P2,x,-1,y,z,18,all\n")
    t = io.read_transactions(spark, f"{d}/tx.csv").collect()
    assert (t[0].product, t[0].quantity, t[0].customer, t[0].country) == ("P1", 3, 17, "Italy")
    with open(f"{d}/pts.txt", "w") as f:
        f.write("1.0,2.0\n3.5, 4.5\n")
    p = io.read_points(spark, f"{d}/pts.txt").orderBy("id").collect()
    assert [r.features for r in p] == [[1.0, 2.0], [3.5, 4.5]]
    with open(f"{d}/census.csv", "w") as f:
        f.write("39, State-gov, 77516, Bachelors, 13, Never-married, ?, Not-in-family, White, Male, 2174, 0, 40,"
                " United-States, <=50K\n")
    c = io.read_census(spark, f"{d}/census.csv").first()
    assert c.age == 39 and c.occupation is None and c.income == "<=50K"
    with open(f"{d}/links.tsv", "w") as f:
        f.write("SOURCE_SUBREDDIT\tTARGET_SUBREDDIT\tPOST_ID\tTIMESTAMP\tLINK_SENTIMENT\tPROPERTIES\n"
                "a\tb\tp\t2016-01-02 03:04:05\t-1\tx\n")
    lk = io.read_links(spark, {"body": f"{d}/links.tsv"}).first()
    assert (lk.src, lk.dst, lk.sentiment, lk.origin, lk.ts.year) == ("a", "b", -1, "body", 2016)
    df = spark.createDataFrame([(1, 5), (2, 6)], "node long, community long")
    io.write_result(df, f"{d}/out")
    back = io.read_node_attribute(spark, f"{d}/out")
    assert sorted(tuple(r) for r in back.collect()) == [(1, 5), (2, 6)]


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0 and df.columns == ["product", "popularity"]


def test_oracle_small_scale(spark):
    import __spark_entry__ as E
    qs, sql = E.queries(), E.oracle_sql()
    con = duckdb.connect()
    for t in ("lineitem", "orders", "customer", "nation", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    for name in ("product_popularity", "build_graph_supp", "degree", "knn_join", "jaccard_score", "matvec"):
        a = sorted(tuple(r) for r in qs[name](spark, SF_SMALL).collect())
        b = sorted(tuple(r) for r in con.execute(sql[name]).fetchall())
        assert len(a) == len(b), name
        assert all(all((abs(x - y) < 1e-6) if isinstance(x, float) else x == y for x, y in zip(ra, rb))
                   for ra, rb in zip(a, b)), name
    assert os.path.exists(SF_SMALL)


def test_links_cut_a_large_table_into_more_tasks(spark, monkeypatch):
    """a task's share of the self-join does not grow with the line items."""
    from meridian.sources import testdata as T
    before = sorted(T.links(spark, SF_SMALL, "part").collect())
    monkeypatch.setattr(T, "LINES", 100, raising=False)
    cut = T.links(spark, SF_SMALL, "part")
    lines = T.table(spark, SF_SMALL, "lineitem").count()
    assert cut.rdd.getNumPartitions() == -(-lines // 100)
    assert sorted(cut.collect()) == before and before

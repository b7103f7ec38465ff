import datetime as dt

import duckdb

from emporium.llm import queries, url_lists

SF = "/root/testdata/sf0.001"


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"create view pages as select * from read_parquet('{sf}/pages.parquet')")
    rel = con.sql(queries.ORACLE["op5_url_lists"])
    got = queries.op5_url_lists(spark, sf)
    assert sorted(rel.columns) == sorted(got.columns)
    cols = sorted(rel.columns)
    assert sorted((tuple(r[c] for c in cols) for r in got.collect()), key=str) == sorted(con.sql(f"select {','.join(cols)} from ({queries.ORACLE['op5_url_lists']})").fetchall(), key=str)
    assert {r.action for r in got.select("action").distinct().collect()} == {"block", "allow", None}


def test_no_python_in_the_plan(spark):
    plan = queries.op5_url_lists(spark, SF)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan and "Cartesian" not in plan


def day(d):
    return dt.date(2024, 1, d)


def test_intervals_and_specificity(spark):
    entries = spark.createDataFrame([
        ("example.com", day(2), "block", 1), ("example.com", day(10), "remove", 1), ("a.example.com", day(5), "allow", 1),
        ("a.example.com/x", day(6), "block", 1), ("a.example.com", day(8), "block", 1), ("a.example.com", day(8), "allow", 1),
        (None, day(1), "block", 1), ("b.org", None, "block", 1), ("b.org", day(1), "?", 1)], "pattern string, listed_on date, action string, copies int")
    t = lambda d, h=0: dt.datetime(2024, 1, d, h)
    rows = [(1, "http://user@A.example.com:80/y?q", t(1, 23), None, False), (2, "http://a.example.com/y", t(2), "example.com", True),
            (3, "https://a.example.com/y", t(5), "a.example.com", False), (4, "https://a.example.com/x/z#f", t(6), "a.example.com/x", True),
            (5, "https://a.example.com/xx", t(8), "a.example.com", True), (6, "https://c.example.com", t(9, 23), "example.com", True),
            (7, "https://c.example.com", t(10), None, False), (8, None, t(9), None, False), (9, "not a url", t(9), None, False),
            (10, "http://b.org/", t(9), None, False), (11, "http://example.com/", None, None, False), (None, "http://example.com/", t(3), "example.com", True)]
    df = spark.createDataFrame([r[:3] + ("z",) for r in rows] + [rows[1][:3] + ("z",)], "page_id long, url string, fetched_at timestamp, pattern string")
    got = sorted(((r.page_id or 0, r.pattern, r.blocked) for r in url_lists.evaluate(df, entries).collect()), key=str)
    assert got == sorted([(r[0] or 0, r[3], r[4]) for r in rows] + [(2, "example.com", True)], key=str)
    assert url_lists.evaluate(df.limit(0), entries).count() == 0
    assert url_lists.evaluate(df, entries.limit(0)).where("blocked").count() == 0

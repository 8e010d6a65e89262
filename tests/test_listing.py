"""Listings (S1-S5, C5) and physical layout."""

import datetime as dt

from pyspark.sql import functions as F

from threadmill.operators import listing
from threadmill.sources import tables


def test_page_arithmetic_golden():
    # Top 1, 20, 21, 30, 40 -> 1, 1, 2, 2, 2 pages
    assert [listing.pages_needed(t) for t in (1, 20, 21, 30, 40)] == [1, 1, 2, 2, 2]
    assert listing.page_sizes(30) == [20, 10]


def _threads(spark):
    base = dt.datetime(2024, 1, 31)
    rows = [(i, f"t{i}", (i * 37) % 11, (i * 13) % 7, base - dt.timedelta(days=i % 10)) for i in range(1, 41)]
    return spark.createDataFrame(rows, "thread_id int, title string, reply_count int, view_count int, created_at timestamp_ntz")


def test_top_n_window_order_and_fallback(spark):
    df = _threads(spark)
    got = [r["thread_id"] for r in listing.top_n(df, 5, order="reply_count", direction="desc", last_days=7).collect()]
    rows = [r for r in df.collect() if r["created_at"] >= dt.datetime(2024, 1, 24)]
    want = [r["thread_id"] for r in sorted(rows, key=lambda r: (-r["reply_count"], r["thread_id"]))[:5]]
    assert got == want
    # invalid order / direction fall back to reply_count / desc
    bad = [r["thread_id"] for r in listing.top_n(df, 5, order="nope", direction="sideways", last_days=7).collect()]
    assert bad == want
    asc = [r["thread_id"] for r in listing.top_n(df, 3, order="view_count", direction="asc", last_days=None).collect()]
    assert asc == [r["thread_id"] for r in sorted(df.collect(), key=lambda r: (r["view_count"], r["thread_id"]))[:3]]


def test_page_range_and_empty_range(spark):
    df = _threads(spark)
    order = [F.asc("thread_id")]
    out = listing.page_range(df, 2, 2, order, page_size=10).collect()
    assert sorted(r["thread_id"] for r in out) == list(range(11, 21))
    assert {r["page_no"] for r in out} == {2}
    assert listing.page_range(df, 3, 2, order).count() == 0


def test_per_page_limit_flag_and_exclude(spark):
    df = _threads(spark).withColumn("pos", (F.col("thread_id") - 1) % 20)
    assert listing.per_page_limit(df, 5).count() == 10
    flagged = listing.flag_first_n(df, 3, [F.asc("thread_id")], "thread_id")
    assert sorted(r["thread_id"] for r in flagged.where("enriched").collect()) == [1, 2, 3]
    titles = spark.createDataFrame([("Covid news",), ("CORONA",), ("covid-19 update",), ("Keyboard",)], "title string")
    assert [r["title"] for r in listing.exclude_keywords(titles, "title").collect()] == ["Keyboard"]


def test_bucketed_tables_join_without_exchange(spark):
    a = spark.range(0, 1000).withColumnRenamed("id", "thread_id").withColumn("v", F.lit(1))
    b = spark.range(0, 1000, 3).withColumnRenamed("id", "thread_id")
    tables.save_bucketed(a, "tm_prod", "thread_id", 4)
    tables.save_bucketed(b, "tm_stg", "thread_id", 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = spark.table("tm_prod").join(spark.table("tm_stg"), "thread_id", "left_anti")
        plan = j._jdf.queryExecution().executedPlan().toString()
        assert j.count() == 1000 - 334
        assert "Exchange" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")

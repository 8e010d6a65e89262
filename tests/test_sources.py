"""IO round trips, versioned tables (D11), watermarks."""

import datetime as dt
import gzip
import os
import tempfile

import pandas as pd
import pytest
from pyspark.sql import types as T

from threadmill.sources import extract, files, tables


def _tmp():
    return tempfile.mkdtemp(prefix="tm-test-", dir="/tmp")


def test_tsv_gz_written_by_pandas_reads_back(spark):
    d = _tmp()
    pdf = pd.DataFrame({"id": [1, 2, 3, 4], "txt": ['a "q"\tb', "l1\nl2", "NA", None]})
    p = os.path.join(d, "x.csv.gz")
    with gzip.open(p, "wt", encoding="utf-8") as fh:
        pdf.to_csv(fh, sep="\t", index=False)
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("txt", T.StringType())])
    rows = {r["id"]: r["txt"] for r in files.read_by_suffix(spark, p, schema).collect()}
    assert rows == {1: 'a "q"\tb', 2: "l1\nl2", 3: "NA", 4: None}


def test_tsv_round_trip_nested_as_json(spark):
    d = _tmp()
    df = spark.createDataFrame([(1, ["a", "b"], 'x "y"\tz'), (2, None, None)], "id int, tags array<string>, t string")
    files.write_tsv(df, d + "/out")
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("tags", T.StringType()),
                           T.StructField("t", T.StringType())])
    back = {r["id"]: (r["tags"], r["t"]) for r in files.read_tsv(spark, d + "/out", schema).collect()}
    assert back == {1: ('["a","b"]', 'x "y"\tz'), 2: (None, None)}


def test_json_lines_and_legacy_concatenation(spark):
    d = _tmp()
    df = spark.createDataFrame([(1, "a"), (2, "b")], "thread_id int, title string")
    files.write_json(df, d + "/j")
    schema = T.StructType([T.StructField("thread_id", T.IntegerType()), T.StructField("title", T.StringType())])
    assert sorted(r["thread_id"] for r in files.read_json(spark, d + "/j", schema).collect()) == [1, 2]
    legacy = os.path.join(d, "legacy.json")
    with open(legacy, "w") as fh:
        fh.write('{"thread_id":1,"title":"x}{y"}{"thread_id":2,"title":"b"}{"thread_id":3,"title":"c"}')
    got = sorted((r["thread_id"], r["title"]) for r in files.read_legacy_concatenated_json(spark, legacy, schema).collect())
    assert got == [(1, "x}{y"), (2, "b"), (3, "c")]


def test_landing_paths():
    ts = dt.datetime(2024, 5, 6, 7, 8, 9)
    p = files.landing_path("s3a://b/files", "threads", ts)
    assert p == "s3a://b/files/threads/raw/20240506070809"
    assert files.clean_path(p) == "s3a://b/files/threads/clean/20240506070809"


def test_versioned_table_commit_and_uncommitted_version(spark):
    root = _tmp() + "/t"
    assert tables.current_version(spark, root) is None
    schema = "id int, v string"
    empty = tables.read(spark, root, T.StructType.fromDDL(schema) if hasattr(T.StructType, "fromDDL") else
                        spark.createDataFrame([], schema).schema)
    assert empty.count() == 0
    v1 = tables.write_version(spark.createDataFrame([(1, "a"), (2, "b")], schema), root, key="id")
    assert v1 == 1 and tables.read(spark, root).count() == 2
    # a version whose data exists but whose commit never happened stays invisible
    spark.createDataFrame([(9, "z")], schema).write.parquet(tables.version_path(root, 2))
    assert tables.current_version(spark, root) == 1
    assert sorted(r["id"] for r in tables.read(spark, root).collect()) == [1, 2]
    # the next write reuses that number and replaces the uncommitted data
    v2 = tables.write_version(tables.read(spark, root).where("id = 1"), root)
    assert v2 == 2 and [r["id"] for r in tables.read(spark, root).collect()] == [1]


def test_versioned_write_refuses_wrong_row_count(spark):
    root = _tmp() + "/t"
    df = spark.createDataFrame([(1,)], "id int")
    with pytest.raises(RuntimeError):
        tables.write_version(df, root, expect_rows=2)
    assert tables.current_version(spark, root) is None


def test_incremental_extract_and_watermarks(spark):
    t = spark.createDataFrame(
        [(1, dt.datetime(2024, 1, 1)), (2, dt.datetime(2024, 1, 2)), (3, dt.datetime(2024, 1, 3))],
        "id int, updated_at timestamp_ntz")
    assert extract.incremental(t, "updated_at", None).count() == 3
    wm = dt.datetime(2024, 1, 2)
    assert [r["id"] for r in extract.incremental(t, "updated_at", wm).collect()] == [3]
    assert sorted(r["id"] for r in extract.incremental(t, "updated_at", wm, inclusive=True).collect()) == [2, 3]
    state = extract.merge_watermarks(None, extract.next_watermark(t, "updated_at", "threads"))
    assert extract.read_watermark(state, "threads") == dt.datetime(2024, 1, 3)
    assert extract.read_watermark(state, "users") is None
    # an empty batch keeps the old watermark
    empty = t.where("id < 0")
    state2 = extract.merge_watermarks(state, extract.next_watermark(empty, "updated_at", "threads"))
    assert extract.read_watermark(state2, "threads") == dt.datetime(2024, 1, 3)


def test_incremental_filter_is_pushed_to_parquet(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    q = extract.incremental(df, "ts", dt.datetime(2024, 1, 20)).select("event_id")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThan(ts," in plan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in plan


def test_read_landing_keeps_run_stamp(spark):
    root = _tmp()
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("v", T.StringType())])
    for i, ts in enumerate([dt.datetime(2024, 1, 1, 0, 0, 1), dt.datetime(2024, 1, 8, 0, 0, 2)]):
        files.write_tsv(spark.createDataFrame([(i, f"r{i}")], "id int, v string"), files.landing_path(root, "users", ts))
    got = sorted((r["id"], r["run_stamp"]) for r in files.read_landing(spark, root, "users", schema).collect())
    assert got == [(0, "20240101000001"), (1, "20240108000002")]


def test_batch_committed_lookup(spark):
    root = _tmp() + "/t"
    assert not tables.batch_committed(spark, root, 5)
    tables.write_version(spark.createDataFrame([(1,)], "id int"), root, batch_id=5)
    assert tables.batch_committed(spark, root, 5) and not tables.batch_committed(spark, root, 6)

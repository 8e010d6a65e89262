"""Inputs that once lost, repeated or altered rows, or stopped a job."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from threadmill.functions import scalars
from threadmill.functions.text import explode_rows, split_ws, tokens
from threadmill.operators import dedupe, nested, wordcount
from threadmill.plans import html
from threadmill.schemas import PARTICIPANT
from threadmill.sources import files, tables
from threadmill.streaming import ingest


def _dir():
    return tempfile.mkdtemp(prefix="tm-faults-", dir="/tmp")


def test_null_elements_survive_an_explode(spark):
    df = spark.createDataFrame([(1, ["a", None, "b"]), (2, []), (3, None)], "id int, xs array<string>")
    assert [tuple(r) for r in explode_rows(df, ["id"], F.col("xs"), "x").collect()] == [(1, "a"), (1, None), (1, "b")]
    labels = nested.explode_status(df.withColumnRenamed("id", "thread_id").withColumnRenamed("xs", "status"))
    assert labels.count() == 3


def test_tokens_equal_python_split(spark):
    import string

    texts = ["a b c\x1cd\x85e", " lead, trail. \t", "", "...", "x​y", "tab\x0bvt\x0cff", "　wide　"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", split_ws("t").alias("w"), tokens("t").alias("k")).collect()
    for r in rows:
        assert r.w == r.t.split()
        assert r.k == r.t.translate(str.maketrans("", "", string.punctuation)).split()


def test_keyword_sums_are_exact(spark):
    facts = spark.createDataFrame([(1, 0.004), (1, 0.004), (1, 0.004), (2, 1e17), (2, 1e17), (2, 1e17)], "id int, m double")
    dims = spark.createDataFrame([(1, "small"), (2, "large")], "id int, title string")
    got = {r["word"]: r["sum_m"] for r in wordcount.keyword_stats(facts, dims, "id", "title", {"m": "m"}).collect()}
    assert got == {"small": 0.012, "large": 3e17}


def test_a_count_too_large_is_null(spark):
    df = spark.createDataFrame([("9" * 20,), ("12K",), ("9" * 40,)], "c string")
    assert [r[0] for r in df.select(scalars.abbrev_count("c")).collect()] == [None, 12000, None]


def test_keep_last_with_a_null_order(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, 5, "b"), (2, None, "c")], "k int, o int, v string")
    assert sorted(map(tuple, dedupe.keep_last(df, "k", "o").collect())) == [(1, None, "a"), (2, 5, "b")]
    assert sorted(r["v"] for r in dedupe.keep_first(df, "k", "o").collect()) == ["a", "c"]


def test_python_escapes_in_cells(spark):
    cells = [repr([{"user_id": 1, "reply": r}]) for r in ["a\xa0b", "bell\x07", "q'\"uote", "tab\tline\n", "plain", "back\\slash", "back\\x41"]]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "i int, c string")
    got = {r.i: r.p[0]["reply"] for r in df.select("i", nested.decode_repr_cell("c", PARTICIPANT).alias("p")).collect()}
    assert [got[i] for i in range(len(cells))] == ["a\xa0b", "bell\x07", "q'\"uote", "tab\tline\n", "plain", "back\\slash", "back\\x41"]


def test_a_deeply_nested_page():
    page = html.parse("<div class='a'>" * 10_000 + "deep<a href='x'>t</a>")
    assert page.text() == "deept" and len(page.find_all("div")) == 10_000 and page.find("a").attrs["href"] == "x"


def test_a_header_that_is_not_the_schema_raises(spark):
    d = _dir()
    with open(os.path.join(d, "x.tsv"), "w") as f:
        f.write("v\tid\na\t1\n")
    schema = spark.createDataFrame([], "id int, v string").schema
    with pytest.raises(Exception, match="(?i)header|schema"):
        files.read_tsv(spark, d + "/x.tsv", schema).collect()
    with open(os.path.join(d, "y.tsv"), "w") as f:
        f.write("id\tv\nnumber\tb\n")
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST"):
        files.read_tsv(spark, d + "/y.tsv", schema).collect()


def test_a_failed_read_is_not_an_empty_table(spark):
    root = _dir() + "/t"
    spark.range(3).write.parquet(root)  # no bucket column
    with pytest.raises(ValueError, match="key_bucket"):
        tables.upsert_partitioned(spark.range(1), root, "id", 10, lambda p, s: p.unionByName(s))
    with pytest.raises(ValueError, match="key_bucket"):
        tables.append_new_partitioned(spark.range(1), root, "id", 10)
    assert tables.read_partitioned(spark, root + "-absent") is None


def _stream(spark, d, name, rows, target, **options):
    landing = os.path.join(d, f"landing-{name}")
    schema = "id long, at long, v string"
    for i, part in enumerate(rows):
        files.write_tsv(spark.createDataFrame(part, schema).coalesce(1), os.path.join(landing, f"b{i}"))
    stream = ingest.landing_stream(spark, landing + "/*", spark.createDataFrame([], schema).schema)
    ingest.run_available_now(stream, ingest.upsert_batches(target, "id", order="at", **options), os.path.join(d, f"ckpt-{name}"))


@pytest.mark.parametrize("options", [{"key_width": 10}, {}])
def test_repeated_keys_of_one_batch_and_a_second_stream(spark, options):
    d = _dir()
    target = os.path.join(d, "target")
    _stream(spark, d, "one", [[(1, 1, "a"), (2, 1, "b")], [(1, 2, "A")]], target, **(options or {"stream": "one"}))
    _stream(spark, d, "two", [[(9, 1, "z"), (2, 5, "B")]], target, **(options or {"stream": "two"}))
    read = tables.read_partitioned if options else tables.read
    assert sorted(tuple(r) for r in read(spark, target).select("id", "at", "v").collect()) == [(1, 2, "A"), (2, 5, "B"), (9, 1, "z")]


def test_rows_without_a_key_are_kept_aside(spark):
    d = _dir()
    _stream(spark, d, "one", [[(1, 1, "a"), (None, 1, "lost")]], d + "/t", key_width=10, rejects_root=d + "/rejects")
    assert tables.read_partitioned(spark, d + "/t").count() == 1
    assert [r.v for r in spark.read.parquet(d + "/rejects/stream/batch=0").collect()] == ["lost"]
    with pytest.raises(ValueError, match="stream"):
        ingest.upsert_batches(d + "/t", "id", order="at")


def test_json_documents(spark):
    import json

    d = _dir()
    rows = [{"a": 1, "b": "x"}, {"a": 2, "b": "y"}]
    for name, text in {"array.json": json.dumps(rows, indent=2), "one.json": json.dumps(rows[0], indent=1), "lines.json": "\n".join(map(json.dumps, rows)),
                       "flat.json": json.dumps(rows)}.items():
        with open(os.path.join(d, name), "w") as f:
            f.write(text)
    schema = spark.createDataFrame([], "a int, b string").schema
    for name, n in (("array.json", 2), ("one.json", 1), ("lines.json", 2), ("flat.json", 2)):
        for s in (schema, None):
            assert sorted((r.a, r.b) for r in files.read_by_suffix(spark, f"{d}/{name}", s).collect()) == [(1, "x"), (2, "y")][:n]


def test_tables_bucketed_alike_join_without_an_exchange(spark):
    import uuid

    names = [f"bucketed_{uuid.uuid4().hex}" for _ in range(2)]
    for n in names:
        tables.save_bucketed(spark.range(1000).withColumn("v", F.lit(n)), n, "id", 4)
    a, b = (spark.table(n) for n in names)
    joined = a.hint("merge").join(b, "id")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert joined.count() == 1000 and "Exchange" not in plan and "SortMergeJoin" in plan
    for n in names:
        spark.sql(f"DROP TABLE {n}")


def test_unreadable_cells_are_counted(spark):
    from threadmill.plans import etl

    df = spark.createDataFrame([(1, "[{'user_id': 1}]", "['Locked']"), (2, "[broken", "None"), (3, "None", "['x'"), (4, None, None)],
                               "thread_id int, participants string, status string")
    assert {r.thread_id: r.undecoded for r in etl.decode_nested_text(df).collect()} == {1: 0, 2: 1, 3: 1, 4: 0}

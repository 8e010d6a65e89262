"""Late rows of the watermark's stamp, batches out of order, repeated files, bad records."""

import datetime as dt
import gzip
import itertools
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tests.test_etl import D1, _p, _roots, _threads
from threadmill.operators import upsert
from threadmill.plans import etl
from threadmill.sources import extract, files, ledger, rejects, tables
from threadmill.streaming import ingest


def _dir():
    return tempfile.mkdtemp(prefix="tm-deliveries-", dir="/tmp")


def _schema(spark, ddl):
    return spark.createDataFrame([], ddl).schema


# ------------------------------------------------------------------ rows of the watermark's stamp


def _at(minute):
    return dt.datetime(2024, 1, 1, 10, minute)


SOURCE = "id int, v string, at timestamp_ntz, tie_key string"


def _run(spark, rows, state):
    """One run over a source: (what it extracts, the state after it)."""
    got = extract.since(spark.createDataFrame(rows, SOURCE), "at", state, "e", "id")
    after = extract.advance(state, got, "at", "e", "id")
    return sorted(((r.id, r.v) for r in got.collect()), key=str), spark.createDataFrame(after.collect(), after.schema)


def test_a_late_row_of_the_watermarks_minute_arrives_once(spark):
    rows = [(1, "a", _at(1), None), (2, "b", _at(2), "x"), (None, "n", _at(2), "x"), (7, "no stamp", None, None)]
    got, state = _run(spark, rows, None)
    assert len(got) == 4 and (7, "no stamp") in got
    assert extract.read_watermark(state, "e") == _at(2) and state.where("tie_key is not null").count() == 2
    rows += [(3, "late", _at(2), "x")]
    got, state = _run(spark, rows, state)
    assert got == [(3, "late")]
    got, state = _run(spark, rows, state)  # nothing new
    assert got == [] and extract.read_watermark(state, "e") == _at(2) and state.where("tie_key is not null").count() == 3
    rows[1] = (2, "rewritten", _at(2), "x")  # within the minute
    got, state = _run(spark, rows, state)
    assert got == [(2, "rewritten")]
    rows += [(4, "next", _at(3), None), (5, "too", _at(2), None)]
    got, state = _run(spark, rows, state)
    assert got == [(4, "next"), (5, "too")]
    assert extract.read_watermark(state, "e") == _at(3) and [r.tie_key is not None for r in state.orderBy("tie_key").collect()] == [False, True]


def test_states_of_other_entities_and_without_ties(spark):
    old = spark.createDataFrame([("e", _at(2)), ("other", _at(9))], extract.WATERMARK)
    rows = [(1, "a", _at(1), None), (2, "b", _at(2), None)]
    got, state = _run(spark, rows, old)
    assert got == [(2, "b")]
    assert extract.read_watermark(state, "other") == _at(9) and extract.read_watermark(state, "e") == _at(2)
    got, state = _run(spark, [], state)
    assert got == [] and extract.read_watermark(state, "e") == _at(2)


def test_the_scan_gets_both_predicates(spark):
    d = _dir()
    spark.createDataFrame([(1, "a", _at(1), None), (2, "b", _at(2), None)], SOURCE).write.parquet(d + "/t")
    table = spark.read.parquet(d + "/t")
    state = extract.advance(None, table, "at", "e", "id")
    plan = extract.since(table, "at", state, "e", "id")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(at," in plan and "EqualTo(at," in plan


def test_etl_loads_a_thread_stamped_like_the_last_one(spark):
    roots = _roots()
    row = lambda i: (i, f"t{i}", "an", 7, "1", "2", [_p(7, f"hi {i}", "Jun 12, 2022 3:04 PM")], "Jun 12, 2022 at 3:04 PM", D1, 33, None)
    ids = lambda: sorted(r.thread_id for r in tables.read_partitioned(spark, roots.threads).collect())
    etl.threads_and_participants(spark, _threads(spark, [row(1), row(2)]), roots, dt.datetime(2022, 6, 21))
    out = etl.threads_and_participants(spark, _threads(spark, [row(1), row(2), row(3)]), roots, dt.datetime(2022, 6, 22))
    assert ids() == [1, 2, 3] and out["threads"]["delta"] == 1 and out["threads"]["rows_after"] == 3
    out = etl.threads_and_participants(spark, _threads(spark, [row(1), row(2), row(3)]), roots, dt.datetime(2022, 6, 23))
    assert ids() == [1, 2, 3] and out["threads"]["buckets"] == 0
    assert tables.read_partitioned(spark, roots.participants).count() == 3


# ------------------------------------------------------------------ batches out of order

VERSIONS = [[(1, 3, "c", {"k": 1}), (2, 1, "x", None)], [(1, 1, "a", None), (3, None, "old", None)], [(1, 3, "b", {"k": 2}), (3, 0, "new", None), (2, 1, "x", None)]]
ROW = "id long, at long, v string, m map<string,int>"


def test_every_order_of_batches_gives_one_table(spark):
    want = None
    for order in itertools.permutations(VERSIONS):
        prod = spark.createDataFrame([], ROW)
        for batch in order:
            prod = upsert.upsert_newest(prod, spark.createDataFrame(batch, ROW), "id", "at")
        got = sorted((r.id, r.at, r.v) for r in prod.collect())
        want = want or got
        assert got == want
    assert [r[:2] for r in want] == [(1, 3), (2, 1), (3, 0)] and want[2][2] == "new"


def test_locked_rows_stay_and_unknown_columns_raise(spark):
    prod = spark.createDataFrame([(1, 1, "kept", {"k": 1}), (2, 1, "b", None)], ROW)
    stg = spark.createDataFrame([(1, 9, "x", None), (2, 9, "y", None)], ROW)
    got = upsert.upsert_newest(prod, stg, "id", "at", F.col("m").isNotNull())
    assert sorted((r.id, r.v) for r in got.collect()) == [(1, "kept"), (2, "y")]
    for merge in (lambda s: upsert.upsert_newest(prod, s, "id", "at"), lambda s: upsert.upsert_replace(prod, s, "id"), lambda s: upsert.upsert_protect(prod, s, "id", F.lit(False))):
        with pytest.raises(ValueError, match="extra"):
            merge(stg.withColumn("extra", F.lit(1)))


@pytest.mark.parametrize("options", [{"key_width": 10}, {"stream": "s"}])
def test_streams_of_files_in_any_order_with_a_restart(spark, options):
    schema, results = _schema(spark, "id long, at long, v string"), []
    parts = [[r[:3] for r in b] for b in VERSIONS]
    for order in (parts, parts[::-1]):
        d = _dir()
        for i, part in enumerate(order):
            files.write_tsv(spark.createDataFrame(part, schema).coalesce(1), f"{d}/landing/b{i}")
            if i != 1:  # stop, and go on from the checkpoint with one and with two new files
                stream = ingest.landing_stream(spark, d + "/landing/*", schema, max_files_per_trigger=1)
                ingest.run_available_now(stream, ingest.upsert_batches(d + "/t", "id", order="at", **options), d + "/ckpt")
        table = tables.read_partitioned(spark, d + "/t") if "key_width" in options else tables.read(spark, d + "/t")
        results.append(sorted((r.id, r.at, r.v) for r in table.collect()))
    assert results[0] == results[1] and len(results[0]) == 3


def test_a_stream_asks_for_the_order_of_versions():
    with pytest.raises(ValueError, match="order"):
        ingest.upsert_batches("/nowhere", "id", key_width=10)


# ------------------------------------------------------------------ ledger of files


def _put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:  # equal texts give equal files
        f.write(gzip.compress(text.encode(), mtime=0))


def test_files_are_consumed_once_and_repeats_are_refused(spark):
    d = _dir()
    loaded = []
    run = lambda n: ledger.consume(spark, d + "/landing", d + "/ledger", n, lambda p: loaded.append(sorted(map(os.path.basename, p))), "*.gz")
    assert run("r0").paths == [] and loaded == []  # no folder yet
    _put(d + "/landing/1/a.csv.gz", "x\n1")
    _put(d + "/landing/1/b.csv.gz", "x\n2")
    _put(d + "/landing/1/b-again.csv.gz", "x\n2")
    with open(d + "/landing/1/notes.txt", "w") as f:
        f.write("not of the pattern")
    assert [os.path.basename(p) for p in run("r1").refused] == ["b.csv.gz"]
    assert loaded == [["a.csv.gz", "b-again.csv.gz"]]
    assert run("r2").paths == [] and len(loaded) == 1  # nothing is read
    _put(d + "/landing/2/c.csv.gz", "x\n1")  # a.csv.gz under another name
    _put(d + "/landing/2/d.csv.gz", "x\n3")
    out = run("r3")
    assert loaded[1:] == [["d.csv.gz"]] and [os.path.basename(p) for p in out.refused] == ["c.csv.gz"]
    _put(d + "/landing/1/a.csv.gz", "x\n1 and more")  # rewritten in place
    assert [os.path.basename(p) for p in run("r4").paths] == ["a.csv.gz"]
    status = {(os.path.basename(r.path), r.run): r.status for r in ledger.read_ledger(spark, d + "/ledger").collect()}
    assert len(status) == 6 and status["c.csv.gz", "r3"] == ledger.REFUSED and status["a.csv.gz", "r4"] == ledger.NEW


def test_a_load_that_fails_is_taken_again(spark):
    d = _dir()
    _put(d + "/landing/a.csv.gz", "x\n1")

    def fail(paths):
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError, match="lost"):
        ledger.consume(spark, d + "/landing", d + "/ledger", "r1", fail)
    assert len(ledger.consume(spark, d + "/landing", d + "/ledger", "r2", lambda p: None).paths) == 1


# ------------------------------------------------------------------ bad records


def test_bad_records_of_every_format_are_kept_with_file_and_reason(spark):
    d = _dir()
    schema = _schema(spark, "id int, v string, x double, tags array<string>")
    _put(d + "/json/a.json.gz", '{"id": 1, "v": "ok", "x": 1.5, "tags": ["p"]}\n{"id": "one", "v": "b", "x": 2}\n\n{"id": 3, "v": "torn"\n{"id": 4, "tags": "p"}\n{"id": 5, "other": 1}')
    got = rejects.load_checked(spark, d + "/json", schema, "json", d + "/rejects", "j", budget=0.9)
    assert sorted((r.id, r.v, r.x) for r in got.good.collect()) == [(1, "ok", 1.5), (5, None, None)] and got.good.columns == schema.names
    assert (got.rows, got.bad) == (5, 3) and got.good.select("v").distinct().count() == 2
    kept = {r.record[:10]: (r.reason, os.path.basename(r.source_file)) for r in rejects.read_rejects(spark, d + "/rejects", "j").collect()}
    assert kept == {'{"id": "on': ("id is no int", "a.json.gz"), '{"id": 3, ': ("broken record", "a.json.gz"), '{"id": 4, ': ("does not fit the schema", "a.json.gz")}

    flat = _schema(spark, "id int, v string, x double")
    for fmt, sep, name in (("tsv", "\t", "t.csv.gz"), ("csv", ",", "c.csv.gz")):
        lines = ["id,v,x", "1,ok,1.5", "two,b,2", '3,"say ""hi""\nthere",3', "4,short", "5,c,5,6", "6,NA,", "7,d,seven"]
        _put(f"{d}/{fmt}/{name}", "\n".join(lines).replace(",", sep))
        got = rejects.load_checked(spark, f"{d}/{fmt}", flat, fmt, d + "/rejects", fmt, budget=0.9)
        assert sorted(map(tuple, got.good.collect()), key=str) == [(1, "ok", 1.5), (3, 'say "hi"\nthere', 3.0), (6, "NA", None)]
        kept = sorted((r.record[0], r.reason) for r in rejects.read_rejects(spark, d + "/rejects", fmt).collect())
        assert kept == [("4", "not 3 fields"), ("5", "not 3 fields"), ("7", "x is no double"), ("t", "id is no int")]


def test_the_budget_fails_the_load_and_keeps_the_rejects(spark):
    d = _dir()
    _put(d + "/in/a.json.gz", '{"id": 1}\n{"id": "x"}')
    for _ in range(2):  # a rerun replaces its own
        with pytest.raises(rejects.TooManyRejects, match="1 of 2"):
            rejects.load_checked(spark, d + "/in", _schema(spark, "id int"), "json", d + "/rejects", "r", budget=0.4)
        assert rejects.read_rejects(spark, d + "/rejects").count() == 1
    assert rejects.load_checked(spark, d + "/in", _schema(spark, "id int"), "json", d + "/rejects", "r", budget=0.5).good.count() == 1
    _put(d + "/empty/a.json.gz", "")
    got = rejects.load_checked(spark, d + "/empty", _schema(spark, "id int"), "json", d + "/rejects", "e")
    assert (got.rows, got.bad, got.good.count()) == (0, 0, 0)


def test_strict_readers_raise(spark):
    d = _dir()
    for name, text in (("bad.json", '{"id": "x"}'), ("torn.json", '{"id": 1'), ("type.csv", "id,v\nx,1"), ("head.csv", "v,id\na,1")):
        with open(f"{d}/{name}", "w") as f:
            f.write(text + "\n")
        with pytest.raises(Exception):
            files.read_by_suffix(spark, f"{d}/{name}", _schema(spark, "id int, v string")).collect()
    with open(d + "/good.csv", "w") as f:
        f.write('id,v\n1,"two\nlines"\n2,"say ""hi"""\n')
    got = files.read_by_suffix(spark, d + "/good.csv", _schema(spark, "id int, v string")).collect()
    assert [tuple(r) for r in got] == [(1, "two\nlines"), (2, 'say "hi"')]


# ------------------------------------------------------------------ sums, page versions, first loads


def test_sums_are_exact_or_null_never_short(spark):
    from threadmill.operators import wordcount

    rows = [(1, 0.1)] * 10 + [(2, 1e30), (2, 1.0), (3, -2.5), (3, None), (4, float("nan")), (5, 123456.7891), (5, -123456.7891)]
    facts = spark.createDataFrame(rows, "k long, x double").withColumn("d", F.col("x").try_cast("decimal(20,4)"))
    dims = spark.createDataFrame([(k, f"w{k}") for k in range(1, 6)], "k long, t string")
    got = {r.word: r for r in wordcount.keyword_stats(facts, dims, "k", "t", {"x": "x", "d": "d"}).collect()}
    assert {w: r.sum_x for w, r in got.items()} == {"w1": 1.0, "w2": None, "w3": -2.5, "w4": None, "w5": 0.0}
    assert got["w1"].sum_d == 1.0 and got["w3"].sum_d == -2.5 and got["w5"].sum_d == 0.0 and got["w3"].n_rows == 2
    assert got["w2"].avg_x is None and got["w2"].n_rows == 2


def test_the_first_load_from_memory_reports(spark):
    root = _dir() + "/t"
    rule = lambda prod, stg: upsert.upsert_replace(prod, stg, "id")
    out = tables.upsert_partitioned(spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string"), root, "id", 10, rule)
    assert out == {"buckets": 1, "rows_before": 0, "rows_after": 2, "delta": 2}

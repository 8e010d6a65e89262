"""Groups of equal texts against SQL and by hand; chunk digests that collide."""

import duckdb
from pyspark.sql import functions as F

from threadmill.llm import recipe_dedup as R
from tests.llm.cases import documents, odd_documents


def by_sql(path):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{path}'")
    return sorted(con.execute(R.OP3_SQL).fetchall())


def test_query(spark):
    got = sorted(map(tuple, R.op3(spark, "/root/testdata/sf0.01").collect()))
    assert got == by_sql("/root/testdata/sf0.01/documents.parquet")


def texts(n=120):
    base = ["the quick brown fox jumps over the lazy dog " * k for k in (1, 30, 90)]
    rows = [(i, base[i % 3] + " " * (i % 4) + ("x" if i % 5 == 0 else "") + "tail" * (i % 2)) for i in range(n)]
    return rows + [(500, "a b"), (501, "ab"), (502, "ba"), (503, ""), (504, " ")]


def test_colliding_digests_are_told_apart(spark, tmp_path):
    documents(spark, texts()).select("doc_id", "text").write.parquet(str(tmp_path / "d"))
    want = by_sql(f"{tmp_path}/d/*.parquet")
    docs = documents(spark, texts())
    for digest in (F.xxhash64, lambda c: F.length(c).cast("bigint"), lambda c: F.lit(1).cast("bigint")):
        got = R.dedup(docs, digest=digest, least=8, most=40).drop("n_points")
        assert sorted(map(tuple, got.collect())) == want


def test_chunks_make_up_the_text_and_follow_its_content(spark):
    body = "".join(chr(33 + (i * i * 7 + i // 3) % 90) for i in range(20000))
    rows = documents(spark, [(1, body), (2, "inserted" + body), (3, "é中🤦" * 9000), (4, "")])
    got = {r.doc_id: r.c for r in rows.select("doc_id", R.chunks(F.col("text")).alias("c")).collect()}
    assert "".join(got[1]) == body and "".join(got[2]) == "inserted" + body and "".join(got[3]) == "é中🤦" * 9000 and got[4] == []
    assert len(set(got[1]) & set(got[2])) >= len(got[1]) - 3 and max(map(len, got[3])) <= R.MAX_CHUNK


def test_defined_results(spark):
    rows = R.dedup(odd_documents(spark)).collect()
    assert len(rows) == odd_documents(spark).count()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    assert {r.keep_id for i in (1, 2, 3) for r in by[i]} == {3} and by[5][0].keep_id == 4 and by[5][0].group_size == 3
    assert {r.keep_id for r in by[None]} == {None, 3}
    assert R.dedup(documents(spark, [])).count() == 0


def test_a_hot_group(spark):
    rows = spark.range(4000).selectExpr("id as doc_id", "if(id % 2 = 0, 'hot text', concat('text ', id % 1500)) as text")
    got = {r.doc_id: r for r in R.dedup(rows).collect()}
    assert len(got) == 4000 and got[1998].keep_id == 0 and got[1998].group_size == 2000 and not got[1998].kept and got[0].kept


def test_plan_has_no_python(spark):
    plan = R.op3(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan

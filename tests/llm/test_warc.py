"""Archives: round trips against SQL and hand-made files."""

import gzip
import hashlib

import duckdb

from threadmill.llm import warc

SCHEMA = "page_id long, url string, html string, n int, digest string, bytes string"


def result(spark, df, tmp_path):
    folder = tmp_path / "pages.parquet"
    df.write.mode("overwrite").parquet(str(folder))
    return sorted(map(tuple, warc.op9(spark, str(tmp_path)).collect()), key=repr)


def by_sql(path):
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{path}'")
    return sorted(con.execute(warc.OP9_SQL).fetchall(), key=repr)


def test_query_on_table(spark):
    got = sorted(map(tuple, warc.op9(spark, "/root/testdata/sf0.001").collect()), key=repr)
    assert got == by_sql("/root/testdata/sf0.001/pages.parquet")


def test_copies_short_payloads_odd_characters(spark, tmp_path):
    long = "<p>é中🤦 " + "x" * 200
    rows = [(7, "http://a/b", long), (3, "http://a/c", long), (9, None, long), (4, "u", "short"), (5, "u", "short"), (6, "u", None), (8, "u", ""),
            (10, "http://x\r\ny z", "a" * 100), (11, "u", "a" * 100), (12, "u", "b" * 99), (13, "u", "b" * 99),
            (14, "u", "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n" + "y" * 80)]
    df = spark.createDataFrame([(*r, 1, "d", "b") for r in rows], SCHEMA)
    assert result(spark, df, tmp_path) == by_sql(f"{tmp_path}/pages.parquet/*.parquet")


def test_null_ids_repeated_rows_and_empty_table(spark, tmp_path):
    html = "z" * 150
    df = spark.createDataFrame([(None, "u", "q"), (1, "u", html), (1, "u", html), (2, "v", html), (None, None, html)], "page_id long, url string, html string")
    sha = hashlib.sha256(html.encode()).hexdigest()
    got = result(spark, df, tmp_path)
    assert sorted((g[0], g[3], g[4]) for g in got if g[2] == sha and g[0]) == [(1, "response", None), (1, "response", None), (2, "revisit", 1)]
    assert [g[1:] for g in got if g[0] is None and g[2] == sha] == [(150, sha, "revisit", 1)]
    assert len(got) == 5
    assert result(spark, df.limit(0), tmp_path) == []


def test_a_hot_payload(spark, tmp_path):
    df = spark.range(3000).selectExpr("id as page_id", "'u' as url", "if(id % 2 = 1, repeat('hot', 50), concat('page', id, repeat('-', 100))) as html")
    assert result(spark, df, tmp_path) == by_sql(f"{tmp_path}/pages.parquet/*.parquet")


def test_foreign_archives(spark, tmp_path):
    """Links in the other direction and through another record; gzip; damage; a record cut off."""
    def rec(kind, rid, to=None, body=b"", ctype="application/http"):
        head = f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: {rid}\r\n" + "".join(f"WARC-Concurrent-To: {t}\r\n" for t in to or [])
        return (head + f"Content-Type: {ctype}\r\nContent-Length: {len(body)}\r\n\r\n").encode() + body + b"\r\n\r\n"

    http = b"HTTP/1.1 200 OK\r\n\r\nbody"
    data = rec("warcinfo", "<w>") + rec("request", "<q>", body=b"GET / HTTP/1.1\r\n\r\n") + b"damage\r\n\r\n" + rec("response", "<r>", ["<q>"], http)
    data += rec("metadata", "<m>", ["<q>"], b"page-id: 5\r\n", "application/warc-fields") + rec("resource", "<s>", body=b"raw", ctype="text/plain")
    folder = tmp_path / "arc"
    folder.mkdir()
    (folder / "part-0.warc").write_bytes(data + rec("response", "<cut>", body=b"x" * 50)[:-30])
    (folder / "part-1.warc.gz").write_bytes(b"".join(gzip.compress(x) for x in (rec("response", "<g>", body=http), rec("request", "<h>", ["<g>"], b"GET"))))
    records = warc.read_records(spark, str(folder), payloads=True)
    assert records.where("record_type = 'broken'").count() == 1
    got = {r.capture_id: r for r in warc.assemble(records).collect()}
    assert set(got) == {"<r>", "<s>", "<g>"}
    assert [x.record_id for x in got["<r>"].requests] == ["<q>"] and [x.fields["page-id"] for x in got["<r>"].metadata] == ["5"]
    assert got["<s>"].requests is None and bytes(got["<s>"].payload) == b"raw" and bytes(got["<r>"].payload) == b"body"
    assert [x.record_id for x in got["<g>"].requests] == ["<h>"]

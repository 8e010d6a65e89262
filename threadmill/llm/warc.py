"""WARC archives: write captures, read them back, assemble transactions.

A capture is three records: request, response (or revisit) and metadata, tied
together by WARC-Concurrent-To. `write_archives` lays them out with Spark's
text writer (records are separated by CR LF CR LF, as the format asks), so any
file system that Spark can write to will do. `read_records` parses whole files
by Content-Length, never by searching payloads. `assemble` joins the records
of a transaction and returns one nested row per capture.

Defined results: NULL html is an empty payload; a NULL url writes no
WARC-Target-URI; a NULL page_id is written as an absent field and read back as
NULL; two rows alike in page_id and html are two captures; an empty table
gives an archive without records and no rows; other columns are ignored.
Damaged bytes between records are skipped up to the next version line; a
record cut off by the end of its file has type `broken`.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threadmill.llm.common import attach_groups, stage, table
from threadmill.session import checkpoint_dir

CRLF = "\r\n"
DATE = "2024-01-01T00:00:00Z"
MIN_REVISIT_BYTES = 100
#: Records in one archive file (three to a capture); keeps a file to tens of MB.
RECORDS_PER_FILE = 6000

# Fixed values of the format.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CAPTURE_TYPES = ["response", "revisit", "resource"]

RECORD_SCHEMA = (
    "record_id string, record_type string, target_uri string, date string, concurrent_to array<string>, refers_to string, "
    "declared_digest string, payload_digest string, payload_bytes long, fields map<string,string>, payload binary"
)


# ------------------------------------------------------------------ writing


def _urn(kind: str, page: str = "page", digest: str = "digest") -> Column:
    h = F.md5(F.concat_ws("|", F.lit(kind), F.coalesce(F.col(page).cast("string"), F.lit("")), F.col(digest)))
    part = lambda a, n: F.substring(h, a, n)
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", part(1, 8), part(9, 4), part(13, 4), part(17, 4), part(21, 12)), F.lit(">"))


def _record(headers: list[tuple[str, Column]], block: Column) -> Column:
    """One record as text, without the two line ends that follow it; NULL headers are left out."""
    lines = [F.lit("WARC/1.1")] + [F.concat(F.lit(f"{k}: "), v) for k, v in headers]
    lines.append(F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")))
    return F.concat(F.concat_ws(CRLF, *lines), F.lit(CRLF + CRLF), block)


def revisits(pages: DataFrame) -> DataFrame:
    """Adds digest, bytes and response_page: the smallest page_id with the same
    payload where that is another row's and the payload is large enough."""
    rows = pages.select(
        F.col("page_id").alias("page"), "url", F.coalesce("html", F.lit("")).alias("html"),
    ).withColumns({"digest": F.sha2("html", 256), "bytes": F.octet_length("html").cast("long")})
    repeated = stage(
        rows.where(F.col("bytes") >= MIN_REVISIT_BYTES).groupBy("digest")
        .agg(F.count(F.lit(1)).alias("n"), F.min("page").alias("first_page")).where("n > 1"),
        "warc-repeated",
    )
    n_rows = repeated.agg(F.sum("n")).first()[0] or 0
    if not n_rows:
        return rows.withColumn("response_page", F.lit(None).cast("long"))
    copies = attach_groups(rows, repeated, "digest", "n", n_rows)
    single = rows.join(F.broadcast(repeated), "digest", "left_anti") if n_rows < 1000 else rows.join(repeated, "digest", "left_anti")
    other = F.when(~F.col("page").eqNullSafe(F.col("first_page")), F.col("first_page"))
    return copies.withColumn("response_page", other).drop("n", "first_page").unionByName(
        single.withColumn("response_page", F.lit(None).cast("long")))


def write_archives(pages: DataFrame, path: str, date: str = DATE) -> None:
    """Write request, response or revisit, and metadata records of each row of `pages`."""
    rows = revisits(pages)
    again = F.col("response_page").isNotNull()
    clean = F.regexp_replace("url", r"[\x00-\x20\x7f]", "%20")
    uri = ("WARC-Target-URI", clean)
    capture = _urn("capture")
    html_len = F.col("bytes").cast("string")
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), html_len, F.lit(CRLF + CRLF))
    digest = ("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest")))
    response = _record(
        [("WARC-Type", F.lit("response")), ("WARC-Record-ID", capture), ("WARC-Date", F.lit(date)), uri, digest,
         ("Content-Type", F.lit("application/http;msgtype=response"))],
        F.concat(http, "html"))
    revisit = _record(
        [("WARC-Type", F.lit("revisit")), ("WARC-Record-ID", capture), ("WARC-Date", F.lit(date)), uri, digest,
         ("WARC-Profile", F.lit(REVISIT_PROFILE)), ("WARC-Refers-To", _urn("capture", "response_page")),
         ("Content-Type", F.lit("application/http;msgtype=response"))],
        http)
    request = _record(
        [("WARC-Type", F.lit("request")), ("WARC-Record-ID", _urn("request")), ("WARC-Date", F.lit(date)), uri,
         ("WARC-Concurrent-To", capture), ("Content-Type", F.lit("application/http;msgtype=request"))],
        F.concat(F.lit("GET "), F.coalesce(F.nullif(F.regexp_replace(clean, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/]*", ""), F.lit("")), F.lit("/")),
                 F.lit(f" HTTP/1.1{CRLF}Host: "), F.coalesce(F.regexp_extract(clean, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/]*)", 1), F.lit("")),
                 F.lit(CRLF + CRLF)))
    metadata = _record(
        [("WARC-Type", F.lit("metadata")), ("WARC-Record-ID", _urn("metadata")), ("WARC-Date", F.lit(date)), uri,
         ("WARC-Concurrent-To", capture), ("Content-Type", F.lit("application/warc-fields"))],
        F.concat_ws("", F.concat(F.lit("page-id: "), F.col("page").cast("string"), F.lit(CRLF)), F.lit(f"via: archive{CRLF}")))
    (
        rows.select(F.explode(F.array(request, F.when(again, revisit).otherwise(response), metadata)).alias("value"))
        .write.option("lineSep", CRLF + CRLF).option("maxRecordsPerFile", RECORDS_PER_FILE)
        .option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").text(path)
    )


# ------------------------------------------------------------------ reading


def parse_records(data: bytes) -> Iterator[tuple]:
    """Records of one archive file's bytes, in order, as RECORD_SCHEMA tuples."""
    import hashlib

    pos, end = 0, len(data)
    while pos < end:
        start = data.find(b"WARC/", pos)
        if start < 0:
            return
        head_end = data.find(b"\r\n\r\n", start)
        if head_end < 0:
            yield ("", "broken", None, None, [], None, None, None, 0, {}, None)
            return
        names: dict[str, list[str]] = {}
        for line in data[start:head_end].decode("utf-8", "replace").split("\r\n")[1:]:
            k, sep, v = line.partition(":")
            if sep:
                names.setdefault(k.strip().lower(), []).append(v.strip())
        one = lambda k: names.get(k, [None])[0]
        length = one("content-length")
        if length is None or not length.isdigit():
            pos = head_end + 4  # not a record: go on at the next version line
            continue
        at, pos = head_end + 4, head_end + 4 + int(length)
        kind = (one("warc-type") or "").lower()
        if pos > end:
            yield (one("warc-record-id"), "broken", one("warc-target-uri"), None, [], None, None, None, 0, {}, None)
            return
        block = data[at:pos]
        fields: dict[str, str] = {}
        payload = block
        if (one("content-type") or "").startswith("application/http"):
            cut = block.find(b"\r\n\r\n")
            payload = block[cut + 4 :] if cut >= 0 else b""
        elif (one("content-type") or "").startswith("application/warc-fields"):
            for line in block.decode("utf-8", "replace").split("\r\n"):
                k, sep, v = line.partition(":")
                if sep:
                    fields[k.strip().lower()] = v.strip()
        declared = one("warc-payload-digest")
        yield (
            one("warc-record-id"), kind, one("warc-target-uri"), one("warc-date"), names.get("warc-concurrent-to", []), one("warc-refers-to"),
            declared.partition(":")[2] if declared else None,
            hashlib.sha256(payload).hexdigest() if kind in ("response", "resource") else None, len(payload), fields, payload,
        )


def read_records(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """Every record of the archives under `path` (plain or gzip); `payloads` keeps the bytes."""

    def parse(batches):
        import gzip

        import pyarrow as pa

        names = [f.split(" ")[0] for f in RECORD_SCHEMA.replace("map<string,string>", "map").split(", ")]
        types = [pa.string(), pa.string(), pa.string(), pa.string(), pa.list_(pa.string()), pa.string(), pa.string(), pa.string(), pa.int64(),
                 pa.map_(pa.string(), pa.string()), pa.binary()]

        def batch(rows):
            cols = list(zip(*rows))
            return pa.RecordBatch.from_arrays(
                [pa.array([list(x.items()) for x in c] if n == "fields" else list(c), t) for c, t, n in zip(cols, types, names)], names=names)

        for b in batches:
            for i in range(b.num_rows):
                data = b.column(0)[i].as_py()
                if data[:2] == b"\x1f\x8b":
                    data = gzip.decompress(data)
                rows, held = [], 0
                for r in parse_records(data):
                    rows.append(r if payloads else (*r[:-1], None))
                    held += len(r[-1] or b"") * payloads
                    if len(rows) >= 5000 or held > 8 << 20:
                        yield batch(rows)
                        rows, held = [], 0
                if rows:
                    yield batch(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInArrow(parse, RECORD_SCHEMA)


# ------------------------------------------------------------------ assembly


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: capture_id, record_type, target_uri, payload
    figures, requests and metadata (arrays of structs), response (what a
    revisit refers to).

    Concurrent-to links count in both directions, and a record may point at
    its capture through one other record of the transaction.
    """
    captures = records.where(F.col("record_type").isin(CAPTURE_TYPES))
    others = records.where(F.col("record_type").isin("request", "metadata"))
    # a member and the record it is concurrent to, pointing at the capture's side
    links = others.select(F.col("record_id").alias("member"), F.explode("concurrent_to").alias("toward")).unionByName(
        captures.select(F.explode("concurrent_to").alias("member"), F.col("record_id").alias("toward"))).distinct()
    ids = captures.select(F.col("record_id").alias("toward")).distinct()
    direct = links.join(ids, "toward", "left_semi").select("member", F.col("toward").alias("capture_id"))
    around = (
        links.join(ids, "toward", "left_anti")
        .join(direct.select(F.col("member").alias("toward"), "capture_id"), "toward")
        .select("member", "capture_id")
    )
    member_of = direct.unionByName(around).distinct()
    # repeated rows write the same record more than once: one copy of each tells all
    distinct_others = others.groupBy("record_id").agg(F.first(F.struct("record_type", "record_id", "target_uri", "fields", "payload")).alias("record"))
    parts = (
        distinct_others.join(member_of, F.col("record_id") == F.col("member"))
        .groupBy("capture_id")
        .agg(
            F.collect_list(F.when(F.col("record.record_type") == "request", F.col("record"))).alias("requests"),  # the records of one transaction
            F.collect_list(F.when(F.col("record.record_type") == "metadata", F.col("record"))).alias("metadata"),
        )
    )
    return captures.withColumnRenamed("record_id", "capture_id").join(parts, "capture_id", "left")


def resolved(captures: DataFrame) -> DataFrame:
    """Adds `response` to assembled captures: what a revisit refers to, else the capture itself."""
    page = F.get(F.filter("metadata", lambda m: m["fields"]["page-id"].isNotNull()), F.lit(0))["fields"]["page-id"].cast("long")
    own = F.struct(page.alias("page_id"), "payload_digest", "payload_bytes")
    rows = stage(captures.select("capture_id", "record_type", "refers_to", "declared_digest", own.alias("own")), "warc-captures")
    plain = rows.where("record_type <> 'revisit'").withColumn("response", F.col("own"))
    revisit = rows.where("record_type = 'revisit'")
    sizes = revisit.groupBy("refers_to").agg(F.count(F.lit(1)).alias("n"))
    targets = stage(
        sizes.join(plain.select(F.col("capture_id").alias("refers_to"), "response").dropDuplicates(["refers_to"]), "refers_to", "left"),
        "warc-targets",
    )
    found = attach_groups(revisit, targets, "refers_to", "n", rows.count()).drop("n")
    lost = revisit.where("refers_to is null").withColumn("response", F.lit(None).cast(plain.schema["response"].dataType))
    return plain.unionByName(found).unionByName(lost)


def op9(spark, sf_dir) -> DataFrame:
    path = f"{checkpoint_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    write_archives(table(spark, sf_dir, "pages"), path)
    rows = resolved(assemble(stage(read_records(spark, path), "warc-records")))
    return rows.select(
        F.col("own.page_id").alias("page_id"),
        F.col("response.payload_bytes").alias("payload_bytes"),
        F.coalesce("response.payload_digest", "declared_digest").alias("payload_digest"),
        "record_type",
        F.when(F.col("record_type") == "revisit", F.col("response.page_id")).alias("refers_to"),
    )


OP9_SQL = """
WITH p AS (
  SELECT page_id, sha256(coalesce(html, '')) AS payload_digest, octet_length(encode(coalesce(html, ''))) AS payload_bytes FROM pages
), q AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_page FROM p
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_page THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_page THEN first_page END AS refers_to
FROM q
"""

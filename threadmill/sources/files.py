"""Landing-zone readers and writers.

Interchange files are gzip TSV with a header (as pandas wrote them) and gzip
JSON Lines; a schema is always passed, nothing is inferred. gzip text is not
splittable, so these formats are for the edges only; everything internal is
Parquet.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadmill.functions.text import explode_rows

# Fixed values (must equal the reference's): landing layout
# files/{entity}/{raw|clean}/{yyyyMMddHHmmss}.{csv|json}.gz
RUN_STAMP_FORMAT = "%Y%m%d%H%M%S"
RAW, CLEAN = "raw", "clean"

TSV_OPTIONS = {
    "sep": "\t",
    "header": "true",
    "quote": '"',
    "escape": '"',        # pandas doubles quotes inside quoted fields
    "multiLine": "true",  # quoted fields may hold newlines
    "nullValue": "",      # only the empty field is NULL; 'NA' stays text (D16)
    "emptyValue": "",
    "mode": "FAILFAST",         # a value that does not fit its type raises (D18)
    "enforceSchema": "false",   # and so does a header that is not the schema's
}


def read_tsv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A4: header TSV (gzip detected from the extension) with a declared schema."""
    return spark.read.schema(schema).options(**TSV_OPTIONS).csv(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A5: JSON Lines (gzip detected from the extension) with a declared schema.
    A broken line or a value of another type raises; `load_checked` sets such rows aside."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_legacy_concatenated_json(spark: SparkSession, path: str, schema: T.StructType,
                                  first_key: str = "thread_id") -> DataFrame:
    """Files of objects written back to back (`{..}{..}`) without newlines.

    Each line is split at every `}{"<first_key>":` boundary, then parsed.
    """
    boundary = r'(?<=\})(?=\{"' + first_key + r'":)'
    lines = spark.read.text(path)
    objs = explode_rows(lines, [], F.split("value", boundary), "j").where(F.length("j") > 0)
    return objs.select(F.from_json("j", schema).alias("r")).select("r.*")


def read_by_suffix(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Choose the reader from the file name: .json[.gz] -> JSON, .tsv[.gz] /
    raw-zone .csv.gz -> TSV, .csv -> comma CSV, else binaryFile.

    A JSON file whose first line is not a whole object (an array, a
    pretty-printed document) is read as one document, others as JSON Lines.
    Without a schema the columns are inferred, as a document's are unknown."""
    p = path.lower()
    if p.endswith(".json") or p.endswith(".json.gz"):
        first = spark.read.text(path).where(F.length(F.trim("value")) > 0).limit(1).collect()
        head = first[0][0].strip() if first else "{}"
        reader = spark.read.schema(schema) if schema is not None else spark.read
        return reader.option("mode", "FAILFAST").option("multiLine", str(not (head.startswith("{") and head.endswith("}"))).lower()).json(path)
    if p.endswith(".tsv") or p.endswith(".tsv.gz") or p.endswith(".csv.gz"):
        return read_tsv(spark, path, schema)
    if p.endswith(".csv"):
        r = spark.read.options(**TSV_OPTIONS).option("sep", ",")
        return (r.schema(schema) if schema else r).csv(path)
    return spark.read.format("binaryFile").load(path)


def _text_safe(df: DataFrame) -> DataFrame:
    """Nested columns cannot go to CSV: write them as JSON text."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            cols.append(F.to_json(f.name).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def write_tsv(df: DataFrame, path: str, compression: str = "gzip", mode: str = "errorifexists") -> None:
    """B1: header TSV, gzip, UTF-8; nested values as JSON text."""
    opts = {k: v for k, v in TSV_OPTIONS.items() if k in ("sep", "header", "quote", "escape", "nullValue")}
    _text_safe(df).write.mode(mode).options(**opts).option("compression", compression).csv(path)


def write_json(df: DataFrame, path: str, compression: str = "gzip", mode: str = "errorifexists") -> None:
    """B2: JSON Lines, one object per line (not the legacy concatenation, D5)."""
    df.write.mode(mode).option("compression", compression).json(path)


def run_stamp(run_ts: _dt.datetime) -> str:
    """The run's stamp, yyyyMMddHHmmss."""
    return run_ts.strftime(RUN_STAMP_FORMAT)


def landing_path(root: str, entity: str, run_ts: _dt.datetime, zone: str = RAW) -> str:
    """{root}/{entity}/{zone}/{stamp} (a directory of part files)."""
    return f"{root.rstrip('/')}/{entity}/{zone}/{run_stamp(run_ts)}"


def clean_path(raw_path: str) -> str:
    """The clean twin of a raw landing path."""
    return raw_path.replace(f"/{RAW}/", f"/{CLEAN}/")


def read_landing(spark: SparkSession, root: str, entity: str, schema: T.StructType, zone: str = RAW,
                 fmt: str = "tsv") -> DataFrame:
    """Every run directory of an entity's zone at once (the file name's
    stamp is kept as `run_stamp`); consumed-file tracking is the streaming
    source's job (`threadmill.streaming.ingest`)."""
    path = f"{root.rstrip('/')}/{entity}/{zone}/*"
    df = read_tsv(spark, path, schema) if fmt == "tsv" else read_json(spark, path, schema)
    return df.withColumn("run_stamp", F.regexp_extract(F.input_file_name(), r"/(\d{14})/", 1))

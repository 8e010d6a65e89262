"""Loads that set bad rows aside.

A strict reader loses the whole load to one bad row; a permissive one turns it
into NULLs without a word. Here every record that does not fit the declared
schema goes to a reject folder with its file, its raw text and a reason, and
an error budget decides whether the load may go on.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadmill.session import checkpoint_dir
from threadmill.sources import tables
from threadmill.sources.files import TSV_OPTIONS

#: The raw record, where it does not fit the schema; its file.
RAW, FILE = "_raw_record", "_source_file"
REJECTS = "source_file string, reason string, record string"
#: Reader options of each format; the CSV parser may not skip columns, or it would not see all errors.
FORMATS = {
    "json": ("json", {"mode": "PERMISSIVE"}),
    "tsv": ("csv", {**TSV_OPTIONS, "mode": "PERMISSIVE", "columnPruning": "false"}),
    "csv": ("csv", {**TSV_OPTIONS, "sep": ",", "mode": "PERMISSIVE", "columnPruning": "false"}),
}


class TooManyRejects(RuntimeError):
    """A load had more bad rows than its budget allows; the rejects are kept."""


@dataclass
class Loaded:
    """`good`: the rows that fit, with the declared columns only. `rows`, `bad`: records read, records set aside."""

    good: DataFrame
    rows: int
    bad: int


def _nested(kind: T.DataType) -> bool:
    return isinstance(kind, (T.ArrayType, T.MapType, T.StructType))


def reason(schema: T.StructType, raw: Column, fmt: str) -> Column:
    """Why a raw record does not fit: the first column whose text is not of its type, else that the record is broken."""
    if fmt == "json":
        text = F.from_json(raw, T.MapType(T.StringType(), T.StringType()), {"mode": "PERMISSIVE"})
        cell = lambda i, name: F.element_at(text, name)
        broken = text.isNull()
    else:
        sep = FORMATS[fmt][1]["sep"]
        strings = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(schema.fields) + 1)])
        text = F.from_csv(raw, strings.simpleString()[7:-1].replace(":", " "), {"sep": sep, "quote": '"', "escape": '"', "mode": "PERMISSIVE", "multiLine": "true"})
        cell = lambda i, name: text[f"c{i}"]
        last = len(schema.fields)
        broken = text[f"c{last}"].isNotNull() | text[f"c{last - 1}"].isNull()
    out = F.when(broken, F.lit("broken record" if fmt == "json" else f"not {len(schema.fields)} fields"))
    for i, f in enumerate(schema.fields):
        if not _nested(f.dataType) and not isinstance(f.dataType, T.StringType):
            value = cell(i, f.name)
            misfit = value.isNotNull() & (value != "") & value.try_cast(f.dataType).isNull()
            out = out.when(misfit, F.lit(f"{f.name} is no {f.dataType.simpleString()}"))
    return F.coalesce(out, F.lit("does not fit the schema"))


def load_checked(spark: SparkSession, path, schema: T.StructType, fmt: str, rejects_root: str, run: str, budget: float = 0.0) -> Loaded:
    """Read files of JSON Lines, TSV or CSV (`fmt`) once; bad records go to `<rejects_root>/<run>`.

    The records are parsed in one pass and staged in the shared folder; good
    and bad ones are split from the staged rows. A rerun of the same `run`
    replaces its rejects. If more than `budget` (a share) of the records are
    bad, TooManyRejects is raised after the rejects are written and before any
    good row is handed on. A header that is not the schema's raises: then no
    record of the file can be trusted. Blank lines of JSON files are no records.
    """
    kind, options = FORMATS[fmt]
    held = T.StructType(schema.fields + [T.StructField(RAW, T.StringType())])
    seen = Observation(f"load-{uuid.uuid4().hex}")
    read = spark.read.schema(held).options(**options).option("columnNameOfCorruptRecord", RAW).format(kind).load(path)
    staged = f"{checkpoint_dir(spark).rstrip('/')}/checked-{uuid.uuid4().hex}"
    rows = read.select("*", F.col("_metadata.file_path").alias(FILE))
    rows.observe(seen, F.count(F.lit(1)).alias("n"), F.count(RAW).alias("bad")).write.parquet(staged)
    counts = seen.get
    rows = spark.read.schema(rows.schema).parquet(staged)
    bad = rows.where(F.col(RAW).isNotNull()).select(F.col(FILE).alias("source_file"), reason(schema, F.col(RAW), fmt).alias("reason"), F.col(RAW).alias("record"))
    bad.write.mode("overwrite").parquet(f"{rejects_root.rstrip('/')}/{run}")
    n, n_bad = int(counts["n"]), int(counts["bad"])
    if n_bad > budget * n:
        raise TooManyRejects(f"{n_bad} of {n} records of {path} do not fit; they are in {rejects_root.rstrip('/')}/{run}")
    return Loaded(rows.where(F.col(RAW).isNull()).select(*[f.name for f in schema.fields]), n, n_bad)


def read_rejects(spark: SparkSession, rejects_root: str, run: str = "*") -> DataFrame:
    return tables.read_appended(spark, f"{rejects_root.rstrip('/')}/{run}", T._parse_datatype_string(REJECTS))

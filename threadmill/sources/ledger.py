"""A ledger of landing files for batch jobs.

The reference renames a file once it is consumed; a file that is delivered
again under another name is loaded again. Here the files stay where they are,
and a ledger (an append-only table) holds path, size, modification time and
content digest of each consumed one. A run

1. lists the landing folder (`binaryFile` without its content column),
   anti-joined with the ledger: files of a known path, size and time are not
   opened,
2. digests the others, and splits them into new ones and ones whose content
   was delivered before, in an earlier run or under a smaller path in this one,
3. loads the new ones, then commits: the ledger entry of all of them is one
   append job, made visible at once.

A run that dies before its commit leaves the ledger as it was: the next one
takes the same files again (the loads are idempotent). A file that is rewritten
in place has another digest and is a new delivery.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadmill.sources import tables

LEDGER = T.StructType([
    T.StructField("path", T.StringType(), False),
    T.StructField("length", T.LongType()),
    T.StructField("modified", T.TimestampType()),
    T.StructField("digest", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("run", T.StringType()),
])
NEW, REFUSED = "new", "refused"


def listing(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """path, length, modified of the files below `path`; nothing is opened."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if pattern:
        r = r.option("pathGlobFilter", pattern)
    try:
        files = r.load(path)
    except AnalysisException as e:
        if not tables.absent(e):
            raise
        return spark.createDataFrame([], T.StructType(LEDGER.fields[:3]))
    return files.select("path", "length", F.col("modificationTime").alias("modified"))


def unseen(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """The listed files that no run has met in this state (path, length, modified; null-safe)."""
    known = ledger.select(*[F.col(c).alias(f"_{c}") for c in ("path", "length", "modified")])
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in ("path", "length", "modified")]
    return files.join(known, same, "left_anti")


def classified(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """`files` (path, digest, ...) with `status`: NEW, or REFUSED where the ledger or a
    smaller path of these files holds the same content."""
    first = files.groupBy("digest").agg(F.min("path").alias("_first"))
    told = files.join(first, "digest").join(ledger.select(F.col("digest")).distinct().withColumn("_known", F.lit(True)), "digest", "left")
    new = F.col("_known").isNull() & (F.col("path") == F.col("_first"))
    return told.withColumn("status", F.when(new, NEW).otherwise(REFUSED)).drop("_first", "_known")


@dataclass
class Delivery:
    """The files of one run: `entries` (ledger rows, staged), paths of the new and of the refused ones."""

    entries: DataFrame
    paths: list[str]
    refused: list[str]


def read_ledger(spark: SparkSession, root: str) -> DataFrame:
    return tables.read_appended(spark, root, LEDGER)


def take(spark: SparkSession, landing: str, root: str, run: str, pattern: str | None = None) -> Delivery:
    """The files below `landing` that the ledger at `root` does not hold.

    Only they are opened. Their names reach the driver, as those of any read
    do; contents don't. A file must fit `spark.sql.sources.binaryFile.maxLength`.
    """
    ledger = read_ledger(spark, root)
    fresh = [r.path for r in unseen(listing(spark, landing, pattern), ledger).select("path").collect()]
    if not fresh:
        return Delivery(spark.createDataFrame([], LEDGER), [], [])
    opened = spark.read.format("binaryFile").load(fresh).select("path", "length", F.col("modificationTime").alias("modified"), F.sha2("content", 256).alias("digest"))
    entries = classified(opened, ledger).withColumn("run", F.lit(run)).select(*[f.name for f in LEDGER.fields])
    rows = entries.collect()  # one small row a file; the ledger gets what was decided here
    return Delivery(spark.createDataFrame(rows, LEDGER), sorted(r.path for r in rows if r.status == NEW), sorted(r.path for r in rows if r.status == REFUSED))


def commit(delivery: Delivery, root: str) -> None:
    """After the load: the files of the delivery are consumed (refused ones are not opened again either)."""
    if delivery.paths or delivery.refused:
        tables.append(delivery.entries.coalesce(1), root)


def consume(spark: SparkSession, landing: str, root: str, run: str, load, pattern: str | None = None) -> Delivery:
    """A8 once: `load(paths)` gets the new files of a landing folder, if any, and the ledger their entries after it."""
    delivery = take(spark, landing, root, run, pattern)
    if delivery.paths:
        load(delivery.paths)
    commit(delivery, root)
    return delivery

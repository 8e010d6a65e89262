"""Versioned Parquet tables: write a new version, validate, then commit.

Plain Parquet has no DELETE / MERGE, and overwriting a path that the same
query reads destroys the input. A table here is a directory

    <root>/data/v=<n>/part-*.parquet     one complete version per commit
    <root>/_log/v=<n>/part-*.json         commit record of version n

A version becomes visible only when its commit record exists, and the commit
record is itself written by a Spark job, whose output committer makes it
appear atomically (or not at all). A job killed between the data write and the
commit leaves the previous version current; a rerun writes the same version
number again and overwrites only that uncommitted directory.

Clustering (B12): data is hash-partitioned by the table key into a fixed
number of files and sorted within each, the analogue of a distribution key
and a sort key: Parquet min/max statistics then prune key lookups, and a
catalog user can ask for `bucketBy` instead (`save_bucketed`).

Append-only tables (participants) use `append` on a plain path: each append
job commits its new files atomically. Large keyed tables that receive upserts
use the partitioned layout at the end of this module, which rewrites only the
key ranges a batch touches.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException


def absent(e: AnalysisException) -> bool:
    """Is this the error of a path that does not exist? Anything else is a
    failed read and must not pass for an empty table."""
    return (e.getCondition() or "") == "PATH_NOT_FOUND"


def _root(root: str) -> str:
    return root.rstrip("/")


def current_version(spark: SparkSession, root: str) -> int | None:
    """The newest committed version, or None for a table that does not exist."""
    try:
        log = spark.read.schema("committed_at string, rows long, batch_id long, stream string, v int").json(f"{_root(root)}/_log")
        row = log.agg(F.max("v").alias("v")).first()
    except AnalysisException as e:
        if not absent(e):
            raise
        return None
    return None if row is None or row["v"] is None else int(row["v"])


def batch_committed(spark: SparkSession, root: str, batch_id: int, stream: str | None = None) -> bool:
    """Has this batch of this stream already been committed here (T2)? Batch
    numbers start at 0 with each checkpoint, so the stream's name is part of
    the key. A point lookup in the commit log; one flag reaches the driver."""
    try:
        log = spark.read.schema("committed_at string, rows long, batch_id long, stream string, v int").json(f"{_root(root)}/_log")
        return log.where((F.col("batch_id") == F.lit(batch_id)) & F.col("stream").eqNullSafe(F.lit(stream))).limit(1).count() > 0
    except AnalysisException as e:
        if not absent(e):
            raise
        return False


def version_path(root: str, v: int) -> str:
    return f"{_root(root)}/data/v={v:08d}"


def read(spark: SparkSession, root: str, schema: T.StructType | None = None) -> DataFrame | None:
    """The current version; None if absent (or an empty frame when `schema` is given, B6)."""
    v = current_version(spark, root)
    if v is None:
        return spark.createDataFrame([], schema) if schema is not None else None
    return spark.read.parquet(version_path(root, v))


def exists(spark: SparkSession, root: str) -> bool:
    return current_version(spark, root) is not None


def write_version(df: DataFrame, root: str, key=None, files: int | None = None, expect_rows: int | None = None,
                  batch_id: int | None = None, stream: str | None = None) -> int:
    """Write `df` as the next version of the table at `root` and commit it.

    With `key`, rows are clustered: hash-partitioned by key into `files` files
    (default: the session's shuffle partitions) and sorted by key within each.
    `expect_rows` makes the commit conditional on the written row count.
    Returns the committed version number.
    """
    spark = df.sparkSession
    prev = current_version(spark, root)
    v = 1 if prev is None else prev + 1
    out = df
    if key is not None:
        ks = [key] if isinstance(key, str) else list(key)
        out = out.repartition(files, *ks) if files else out.repartition(*ks)
        out = out.sortWithinPartitions(*ks)
    path = version_path(root, v)
    out.write.mode("overwrite").parquet(path)  # only this uncommitted version dir
    written = spark.read.parquet(path).count()  # validate from the files themselves
    if expect_rows is not None and written != expect_rows:
        raise RuntimeError(f"{root} v{v}: wrote {written} rows, expected {expect_rows}; not committed")
    if current_version(spark, root) != prev:
        raise RuntimeError(f"{root}: another writer committed while v{v} was written; not committed")
    commit = spark.createDataFrame(
        [(_dt.datetime.now(_dt.timezone.utc).isoformat(), written, batch_id, stream)],
        "committed_at string, rows long, batch_id long, stream string",
    )
    commit.coalesce(1).write.mode("overwrite").json(f"{_root(root)}/_log/v={v}")
    return v


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a folder on whatever file system it lives on."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def append(df: DataFrame, path: str, key=None) -> None:
    """B10 for append-only tables: the job's new files appear atomically."""
    out = df
    if key is not None:
        ks = [key] if isinstance(key, str) else list(key)
        out = out.sortWithinPartitions(*ks)
    out.write.mode("append").parquet(path)


def read_appended(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if not absent(e):
            raise
        return spark.createDataFrame([], schema)


def save_bucketed(df: DataFrame, table: str, key, buckets: int, sort_by=None, mode: str = "overwrite") -> None:
    """B12 with a catalog: `bucketBy(n, key).sortBy(...)`; joins of two tables
    bucketed alike on the key need no exchange."""
    ks = [key] if isinstance(key, str) else list(key)
    sb = sort_by or ks
    sb = [sb] if isinstance(sb, str) else list(sb)
    df.write.mode(mode).bucketBy(buckets, *ks).sortBy(*sb).saveAsTable(table)


# ----------------------------------------------------------------------------- partitioned upsert tables
#
# A warehouse table that receives upserts is partitioned by a *range bucket*
# of its key (`key div width`). Ids are assigned in time order, so a batch of
# new and recently active rows touches few buckets. An upsert reads only the
# touched buckets (partition pruning), merges them with the batch, and
# replaces exactly those partitions with Spark's dynamic partition overwrite:
# the work is proportional to the touched buckets, not to the table.
#
# Dynamic overwrite replaces partition directories at job commit, after every
# task has read its input, so reading and rewriting the same partitions in one
# job is safe (unlike a static overwrite, which deletes before it reads). A
# crash during the commit can leave some touched partitions replaced and some
# not; the batch is then simply rerun: both upsert rules are idempotent, and
# the ETL moves its watermark only after the upsert has committed.

BUCKET = "key_bucket"


def bucket_column(key: str, width: int):
    return F.floor(F.col(key) / F.lit(width)).cast("long")


def _clustered(df: DataFrame, ks: list[str]) -> DataFrame:
    """Rebalance by bucket (AQE splits a large bucket by size and joins small
    ones), then sort by key within each task for min/max pruning (B12)."""
    return df.hint("rebalance", BUCKET).sortWithinPartitions(BUCKET, *ks)


def read_partitioned(spark: SparkSession, root: str, schema: T.StructType | None = None) -> DataFrame | None:
    """The table without its bucket column; None / empty frame when absent."""
    stored = _stored(spark, root)
    if stored is None:
        return spark.createDataFrame([], schema) if schema is not None else None
    return stored.drop(BUCKET)


def _stored(spark: SparkSession, root: str) -> DataFrame | None:
    """The partitioned table with its bucket column, None when it does not exist."""
    try:
        stored = spark.read.parquet(root)
    except AnalysisException as e:
        if not absent(e):
            raise
        return None
    if BUCKET not in stored.columns:
        raise ValueError(f"{root} holds files that are not partitioned by {BUCKET}")
    return stored


def touched_rows(spark: SparkSession, root: str, batch: DataFrame, key: str, width: int) -> DataFrame | None:
    """Stored rows (without the bucket column) of the buckets that `batch` touches:
    other partitions are pruned. None when the table does not exist."""
    stored = _stored(spark, root)
    if stored is None:
        return None
    buckets = batch.select(bucket_column(key, width).alias(BUCKET)).distinct()
    # a semi join on the partition column: dynamic partition pruning, no list on the driver
    return stored.join(buckets, BUCKET, "left_semi").drop(BUCKET)


def upsert_partitioned(stg: DataFrame, root: str, keys, width: int, merge) -> dict:
    """Merge a staged batch into the partitioned table at `root`.

    `merge(prod_part, stg)` is an upsert rule (`upsert_replace` or
    `upsert_protect`, partially applied) evaluated on the touched buckets only.
    The key's first column defines the bucket. The bucket list is the only
    value brought to the driver; it is bounded by the table's partition count.

    Returns {"buckets", "rows_before", "rows_after", "delta"} for the touched
    buckets (G-A3). The counts are observed metrics of the write job itself
    (`DataFrame.observe`), not extra scans.
    """
    from pyspark.sql import Observation

    spark = stg.sparkSession
    ks = [keys] if isinstance(keys, str) else list(keys)
    staged = stg.withColumn(BUCKET, bucket_column(ks[0], width))
    touched = [r[0] for r in staged.select(BUCKET).distinct().collect()]
    if not touched:
        return {"buckets": 0, "rows_before": 0, "rows_after": 0, "delta": 0}
    before, after = Observation("rows_before"), Observation("rows_after")
    stored = _stored(spark, root)
    if stored is None:
        prod = spark.createDataFrame([], staged.schema)
    else:
        prod = stored.where(F.col(BUCKET).isin(touched))  # partition pruning
    first = stored is None
    if not first:
        prod = prod.observe(before, F.count(F.lit(1)).alias("n"))
    merged = merge(prod, staged).observe(after, F.count(F.lit(1)).alias("n"))
    out = _clustered(merged, ks)
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(BUCKET).parquet(root))
    n_before = 0 if first else _observed(before)
    n_after = _observed(after)
    if n_after is None:  # the plan was folded to a constant before it ran: count the written rows
        n_after = spark.read.parquet(root).where(F.col(BUCKET).isin(touched)).count()
    delta = None if n_before is None else n_after - n_before
    return {"buckets": len(touched), "rows_before": n_before, "rows_after": n_after, "delta": delta}


def _observed(seen) -> int | None:
    """An observed count, None if the committed write did not report it: a missing report fails no load."""
    try:
        return int(seen.get["n"])
    except Exception:  # the kinds of errors differ between Spark's frontends
        return None


def append_new_partitioned(rows: DataFrame, root: str, keys, width: int) -> int:
    """B10 + D15 for a large append-only table partitioned like the upsert
    tables: append only rows whose (null-safe) key is not stored yet.

    Stored rows are read from the touched buckets only and narrowed to the
    batch's first-key values before the anti join, so the work follows the
    batch, not the table. Returns the touched bucket count.
    """
    spark = rows.sparkSession
    ks = [keys] if isinstance(keys, str) else list(keys)
    staged = rows.withColumn(BUCKET, bucket_column(ks[0], width))
    touched = [r[0] for r in staged.select(BUCKET).distinct().collect()]
    if not touched:
        return 0
    new = staged
    stored = _stored(spark, root)
    if stored is not None:
        known = stored.where(F.col(BUCKET).isin(touched)).select(*ks).join(staged.select(ks[0]), ks[0], "left_semi")
        known = known.select(*[F.col(k).alias(f"_known_{k}") for k in ks])
        new = staged.join(known, [F.col(k).eqNullSafe(F.col(f"_known_{k}")) for k in ks], "left_anti")
    _clustered(new, ks).write.mode("append").partitionBy(BUCKET).parquet(root)
    return len(touched)

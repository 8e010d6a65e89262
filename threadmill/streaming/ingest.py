"""Incremental file ingestion with Structured Streaming.

The landing zone is a file source: each file is processed once (the stream's
checkpoint remembers it), and with `cleanSource=archive` processed files are
moved to an archive folder, which replaces the reference's rename-to-`_read`
marks. Spark archives a batch's files when it plans the following batch, so
the newest batch's files stay in place until a later run; the checkpoint, not
the archive, is what guarantees once-only processing. `trigger(availableNow=True)` turns the stream into an incremental
batch job: it takes everything new, in bounded micro-batches, then stops; a
second run with no new file runs no batch.

Each micro-batch is merged into a keyed table (`foreachBatch`): either a
partitioned upsert table (only touched key ranges rewritten; the rules are
idempotent, so a replayed batch changes nothing) or, for small tables, a
versioned table, where the stream's name and the batch id are stored in the
commit record and a replayed batch (after a failure between commit and
checkpoint) is skipped. Files may be delivered in any order: of all rows that
share a key, in one micro-batch or in several, the one with the greatest
version stays (`upsert.upsert_newest`), so every order of delivery, every cut
into batches and every restart from the checkpoint ends in the same table.
Rows that a keyed table refuses are kept aside.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from threadmill.operators import upsert
from threadmill.sources import tables
from threadmill.sources.files import TSV_OPTIONS


def landing_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "tsv",
                   archive_dir: str | None = None, max_files_per_trigger: int | None = None) -> DataFrame:
    """A streaming DataFrame over the files landing under `path`."""
    r = spark.readStream.schema(schema)
    if archive_dir:
        r = r.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if fmt == "tsv":
        opts = {k: v for k, v in TSV_OPTIONS.items() if k != "multiLine"}
        return r.options(**opts).option("multiLine", "true").csv(path)
    if fmt == "json":
        return r.option("mode", "FAILFAST").json(path)
    return r.parquet(path)


def upsert_batches(target_root: str, keys, transform: Callable[[DataFrame], DataFrame] | None = None,
                   locked=None, key_width: int | None = None, order=None, stream: str | None = None,
                   rejects_root: str | None = None) -> Callable[[DataFrame, int], None]:
    """A `foreachBatch` body merging each micro-batch into `target_root`
    (J3, or J4 when `locked` is given: then a stored locked row stays, so what
    is locked first does depend on the order of delivery).

    `order` names the columns that tell a key's versions apart (a stamp, a
    counter; NULL is the oldest). Of rows that share a key, stored ones
    included, the one with the greatest `order` stays, equal ones decided by
    their content; rows with a NULL key go to
    `rejects_root` (a folder per stream and batch, so a replay replaces its
    own), or raise if there is none.

    With `key_width` the target is a partitioned upsert table and only the key
    ranges a batch touches are rewritten; a replayed batch is harmless there,
    as both rules are idempotent. Without it the target is a versioned table
    that each batch rewrites whole: for small tables. It needs the `stream`'s
    name, under which its batches are committed; ids already committed are
    skipped.
    """
    ks = [keys] if isinstance(keys, str) else list(keys)
    if not order:
        raise ValueError("name the columns that order a key's versions: batches can arrive out of order")
    if key_width is None and stream is None:
        raise ValueError("a versioned target needs the stream's name: batch numbers restart with each checkpoint")

    def rule(prod: DataFrame, stg: DataFrame) -> DataFrame:
        return upsert.upsert_newest(prod, stg, keys, order, locked)

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        stg = transform(batch) if transform else batch
        if key_width is None and tables.batch_committed(spark, target_root, batch_id, stream):
            return
        missing = F.lit(False)
        for k in ks:
            missing = missing | F.col(k).isNull()
        if rejects_root is not None:
            stg.where(missing).write.mode("overwrite").parquet(f"{rejects_root.rstrip('/')}/{stream or 'stream'}/batch={batch_id}")
            stg = stg.where(~missing)
        else:
            stg = stg.where(F.when(missing, F.raise_error(F.lit("a row without a key, and no folder for rejects"))).otherwise(F.lit(True)))
        stg = stg.groupBy(*ks).agg(F.max_by(F.struct(*stg.columns), upsert.row_version(stg, order)).alias("_row")).select("_row.*")
        if key_width is not None:
            tables.upsert_partitioned(stg, target_root, keys, key_width, rule)
            return
        prod = tables.read(spark, target_root, stg.schema)
        tables.write_version(rule(prod, stg), target_root, key=keys, batch_id=batch_id, stream=stream)

    return merge


def run_available_now(stream: DataFrame, on_batch: Callable[[DataFrame, int], None], checkpoint: str,
                      name: str | None = None) -> StreamingQuery:
    """Process everything that has landed, then stop (blocks until done)."""
    w = stream.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if name:
        w = w.queryName(name)
    q = w.start()
    q.awaitTermination()
    return q

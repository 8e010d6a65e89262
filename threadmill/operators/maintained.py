"""Word counts kept up with their texts (G-A1, N2 over flat comments; J3, B10 as changes).

A full recount reads every text again at each run. Here a batch becomes signed
rows, what leaves (-1) and what comes (+1); only their texts are tokenised, and
only the key ranges they touch are rewritten. Counting is linear, so the counts
equal a full recount after any batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadmill.functions.text import explode_rows, tokens
from threadmill.sources import tables

SIGN = "sign"


def _list(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def _signed(rows: DataFrame, sign: int) -> DataFrame:
    return rows.withColumn(SIGN, F.lit(sign).cast("bigint"))


def replaced(stored: DataFrame, batch: DataFrame, keys) -> DataFrame:
    """J3 as changes: stored rows of the batch's keys leave, the batch's rows come."""
    return removed(stored, batch, keys).unionByName(_signed(batch.select(*stored.columns), 1))


def appended(stored: DataFrame, batch: DataFrame, keys) -> DataFrame:
    """B10 as changes: the batch's rows whose key (NULLs equal) is not stored come."""
    ks = _list(keys)
    known = stored.select(*[F.col(k).alias(f"_known_{k}") for k in ks])
    new = batch.select(*stored.columns).join(known, [F.col(k).eqNullSafe(F.col(f"_known_{k}")) for k in ks], "left_anti")
    return _signed(new, 1)


def removed(stored: DataFrame, batch: DataFrame, keys) -> DataFrame:
    """Stored rows of the batch's keys leave; a NULL key matches nothing, as in the upserts."""
    ks = _list(keys)
    return _signed(stored.join(batch.select(*ks), ks, "left_semi").select(*stored.columns), -1)


def count_changes(changes: DataFrame, key, text: str, lower_case: bool = False) -> DataFrame:
    """Signed rows to `(key..., word, n)`: by how much each count changes (never 0).
    A word that leaves and comes again cancels out before the shuffle."""
    ks = _list(key)
    words = explode_rows(changes, [*ks, SIGN], tokens(text, lower_case), "word")
    return words.groupBy(*ks, "word").agg(F.sum(SIGN).alias("n")).where(F.col("n") != 0)


def merge_counts(counts: DataFrame, changes: DataFrame, key) -> DataFrame:
    """`(key..., word, n)` after the changes; counts of 0 go. A count below 0 means that the
    changes don't belong to these counts: the job fails rather than keeping it."""
    return _sum(counts, changes, [*_list(key), "word"]).where(F.col("n") > 0)


def _sum(counts: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    total = F.sum("n")
    checked = F.when(total < 0, F.raise_error(F.lit("a text was retracted that had never been counted")).cast("bigint")).otherwise(total)
    return counts.select(*keys, "n").unionByName(changes.select(*keys, "n")).groupBy(*keys).agg(checked.alias("n"))


def refresh(changes: DataFrame, root: str, key, text: str, width: int, batch: int, lower_case: bool = False) -> dict:
    """Bring the stored counts at `root` (buckets of the key, `tables.upsert_partitioned`) up by a batch.

    `changes` are worked out and staged (a written table) before the texts'
    own table takes the batch. Batch numbers grow; each bucket's rows carry
    the last one that reached it, so a batch that is run again, after a commit
    that was cut short too, changes only the buckets that it had not reached.
    Words that a batch brings to 0 stay as rows of 0 until their bucket is next
    rewritten (a bucket left without rows would not be replaced at all).
    """
    ks = _list(key)

    def merge(stored, staged):
        by = [tables.BUCKET, *ks, "word"]
        if "batch" not in stored.columns:
            stored = stored.withColumn("batch", F.lit(None).cast("bigint"))
        done = stored.groupBy(tables.BUCKET).agg(F.max("batch").alias("_done")).where(F.col("_done") >= batch).select(tables.BUCKET)
        left = stored.join(done, tables.BUCKET, "left_anti").where(F.col("n") > 0)
        fresh = _sum(left, staged.join(done, tables.BUCKET, "left_anti"), by).withColumn("batch", F.lit(batch).cast("bigint"))
        same = stored.join(done, tables.BUCKET, "left_semi")
        return fresh.unionByName(same.select(*fresh.columns))

    delta = count_changes(changes, ks, text, lower_case).withColumn("batch", F.lit(batch).cast("bigint"))
    return tables.upsert_partitioned(delta, root, [*ks, "word"], width, merge)


def stored_counts(spark: SparkSession, root: str) -> DataFrame | None:
    """`(key..., word, n)` at `root`, None where nothing was counted yet."""
    rows = tables.read_partitioned(spark, root)
    return None if rows is None else rows.where(F.col("n") > 0).drop("batch")

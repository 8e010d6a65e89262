"""Watermark-driven incremental extraction (A1, A2, A3, C4, G-A2, D4, D14).

One watermark per entity (D4), stored as rows `(entity, updated_at)` of a
small versioned state table (see `threadmill.sources.tables`). Reading it is
the only driver-side value in the package: one timestamp.

Stamps have a resolution (the source's is a minute), so rows can be written
with the watermark's own stamp after a run has read that stamp. The state
therefore also holds the *ties*: key and content digest of every row extracted
at the watermark itself (`tie_key`, `tie_digest`). `since` reads inclusively
and leaves exactly those out: a late row of that minute, and a row rewritten
within it, arrive with the next run, and nothing arrives twice.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threadmill.functions.scalars import ntz_literal
from threadmill.schemas import TIES, WATERMARK


def incremental(table: DataFrame, ts_col: str, watermark, inclusive: bool = False) -> DataFrame:
    """A1/A2: rows newer than the watermark; the whole table when there is none.

    `watermark` may be None, a Python datetime or a Column. The comparison is
    strict by default (`>`); `inclusive=True` gives `>=`, safe for the upserts
    (they are idempotent) and recovering rows stamped in the watermark's own
    minute. The predicate is pushed into the Parquet scan.
    """
    if watermark is None:
        return table
    wm = watermark if isinstance(watermark, Column) else ntz_literal(watermark)
    c = F.col(ts_col)
    return table.where(c >= wm if inclusive else c > wm)


def next_watermark(batch: DataFrame, ts_col: str, entity: str) -> DataFrame:
    """G-A2 (D4): the new watermark is the max stamp of the *extracted batch*
    (not of the table after load); one row `(entity, updated_at)`. An empty
    batch gives a NULL stamp, which `read_watermark` treats as no watermark."""
    return batch.agg(F.max(ts_col).cast("timestamp_ntz").alias("updated_at")).select(
        F.lit(entity).alias("entity"), "updated_at"
    )


def read_watermark(state: DataFrame | None, entity: str) -> _dt.datetime | None:
    """A3: the entity's watermark, or None (missing row or NULL stamp, D14)."""
    if state is None:
        return None
    row = state.where(F.col("entity") == entity).agg(F.max("updated_at").alias("wm")).first()
    return None if row is None else row["wm"]


def empty_state(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], WATERMARK)


def merge_watermarks(state: DataFrame | None, new: DataFrame) -> DataFrame:
    """B13 per entity: replace the entity's row; a NULL new stamp keeps the old one."""
    if state is None:
        return new.where(F.col("updated_at").isNotNull())
    ents = new.where(F.col("updated_at").isNotNull())
    return state.join(ents.select("entity"), "entity", "left_anti").unionByName(ents)


# ----------------------------------------------------------------------------- ties at the watermark


def _digests(rows: DataFrame, keys) -> DataFrame:
    """The rows with `tie_key` and `tie_digest` behind their own columns (in one struct, so no name clashes)."""
    ks = [keys] if isinstance(keys, str) else list(keys)
    text = lambda names: F.to_json(F.struct(*[F.col(f"`{c}`") for c in names]), {"ignoreNullFields": "false"})
    return rows.select(
        F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row"),
        F.sha2(text(ks), 256).alias("tie_key"), F.sha2(text(sorted(rows.columns)), 256).alias("tie_digest"))


def since(table: DataFrame, ts_col: str, state: DataFrame | None, entity: str, keys) -> DataFrame:
    """A1/A2 without losses: rows newer than the watermark, and those stamped like
    it that the runs before have not extracted (by key and content).

    Newer rows pass without a join; both predicates are pushed into the scan.
    Without a watermark the whole table comes. Rows without a stamp come with
    the first run only. A NULL in a key is a value like any other.
    """
    watermark = read_watermark(state, entity)
    if watermark is None:
        return table
    wm = ntz_literal(watermark)
    newer = table.where(F.col(ts_col) > wm)
    if "tie_key" not in state.columns:  # a state without ties: nothing of that stamp counts as extracted
        return newer.unionByName(table.where(F.col(ts_col) == wm))
    known = state.where((F.col("entity") == entity) & F.col("tie_key").isNotNull()).select("tie_key", "tie_digest")
    late = _digests(table.where(F.col(ts_col) == wm), keys).join(known, ["tie_key", "tie_digest"], "left_anti")
    return newer.unionByName(late.select("row.*"))


def advance(state: DataFrame | None, batch: DataFrame, ts_col: str, entity: str, keys) -> DataFrame:
    """B13 with ties: the state after `batch` (what `since` gave, staged): the
    entity's watermark (G-A2, D4; it never falls) and the ties at it, those of
    earlier runs included if the watermark has not moved. Other entities' rows stay."""
    spark = batch.sparkSession
    before = read_watermark(state, entity)
    newest = batch.agg(F.max(ts_col).cast("timestamp_ntz").alias("wm")).first()["wm"]
    stamp = max((x for x in (before, newest) if x is not None), default=None)
    old = empty_ties(spark) if state is None else empty_ties(spark).unionByName(state, allowMissingColumns=True)
    if stamp is None:
        return old
    mark = spark.createDataFrame([(entity, stamp, None, None)], TIES)
    ties = _digests(batch.where(F.col(ts_col) == ntz_literal(stamp)), keys).select(
        F.lit(entity).alias("entity"), ntz_literal(stamp).alias("updated_at"), "tie_key", "tie_digest")
    kept = old.where(F.col("entity") != entity)
    if before is not None and before == stamp:
        ties = ties.unionByName(old.where((F.col("entity") == entity) & F.col("tie_key").isNotNull()))
    return kept.unionByName(mark).unionByName(ties.distinct())


def empty_ties(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], TIES)

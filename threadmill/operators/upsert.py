"""Staged upserts: plain replace (J3) and replace that protects enriched rows
(J4), with staging checks (D19) and row deltas (G-A3).

The warehouse (`prod`) is large; a staged batch is small relative to it. Both
upserts touch prod only through scans joined against the *keys* of the batch.
No join carries a hint and nothing runs while the plan is built: where the key
list is under the planner's byte threshold, prod streams through broadcast
joins, otherwise the same plan shuffles.

Results are new DataFrames; writing them is the job of
`threadmill.sources.tables`: touched key-range partitions replaced at job
commit (partitioned tables), or a new version directory and then its commit
record (versioned tables), never a static overwrite of the path being read
(D11).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _list(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


@dataclass
class Checked:
    good: DataFrame
    rejects: DataFrame


def check_staging(stg: DataFrame, keys, not_null=(), widths: dict | None = None) -> Checked:
    """Split a staged batch into rows a keyed table accepts and rejects.

    A row is rejected when a key or NOT NULL column is NULL, when its key
    occurs more than once in the batch (every copy is rejected, as a primary
    key would refuse the load), or when a text is wider than its declared
    width. Rejects carry a `reject_reason`.
    """
    ks = _list(keys)
    reason = F.lit(None).cast("string")
    for c in list(ks) + [c for c in not_null if c not in ks]:
        reason = F.coalesce(reason, F.when(F.col(c).isNull(), F.lit(f"null {c}")))
    for c, w in (widths or {}).items():
        reason = F.coalesce(reason, F.when(F.length(c) > w, F.lit(f"width {c}")))
    # duplicated keys: counted with a grouped aggregate (combines map-side)
    dup = stg.groupBy(*ks).agg(F.count(F.lit(1)).alias("_copies")).where("_copies > 1").select(*ks)
    flagged = stg.join(dup.withColumn("_dup", F.lit(True)), ks, "left")
    reason = F.coalesce(reason, F.when(F.col("_dup"), F.lit("duplicate key")))
    tagged = flagged.withColumn("reject_reason", reason).drop("_dup")
    return Checked(
        good=tagged.where(F.col("reject_reason").isNull()).drop("reject_reason").select(*stg.columns),
        rejects=tagged.where(F.col("reject_reason").isNotNull()),
    )


def upsert_replace(prod: DataFrame, stg: DataFrame, keys) -> DataFrame:
    """Staged rows win; prod rows with other keys are kept.

    prod anti-join batch keys, union the batch. Idempotent:
    upsert(upsert(p, s), s) == upsert(p, s).
    """
    _missing(prod, stg)
    ks = _list(keys)
    kept = prod.join(stg.select(*ks), ks, "left_anti")
    return kept.unionByName(stg.select(*prod.columns))


def _missing(prod: DataFrame, stg: DataFrame) -> None:
    """A staged column that prod lacks would vanish without a word: raise."""
    extra = [c for c in stg.columns if c not in prod.columns]
    if extra:
        raise ValueError(f"the batch has columns that the table lacks: {', '.join(extra)}")


def row_version(df: DataFrame, order) -> Column:
    """What versions of a key are compared by: the `order` columns, NULL first, and
    behind them the row's content, so that rows of equal order also have a greatest one."""
    content = F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in sorted(df.columns)]), {"ignoreNullFields": "false"}), 256)
    return F.struct(*[x for o in _list(order) for x in (F.col(o).isNotNull().alias(f"has_{o}"), F.col(o).alias(o))], content.alias("content"))


def upsert_newest(prod: DataFrame, stg: DataFrame, keys, order, locked=None) -> DataFrame:
    """J3 (J4 with `locked`) for batches that may come in any order: of a key's
    stored and staged row the one with the greater `row_version` stays.

    The result depends on the set of rows merged so far, not on the order or
    number of their batches: merging is a maximum, so it is associative,
    commutative and idempotent. `stg` has one row per key
    (`dedupe.keep_last` by the same version). Prod meets the batch's keys only.
    """
    _missing(prod, stg)
    ks = _list(keys)
    stg = stg.select(*prod.columns)
    is_locked = F.coalesce(locked, F.lit(False)) if locked is not None else F.lit(False)
    stored = prod.select(*ks, is_locked.alias("_locked"), row_version(prod, order).alias("_stored"))
    met = stg.select(*ks, row_version(stg, order).alias("_staged")).join(stored, ks)
    older = met.where(F.col("_locked") | (F.col("_staged") <= F.col("_stored"))).select(*ks)
    accepted = stg.join(older, ks, "left_anti")
    return prod.join(accepted.select(*ks), ks, "left_anti").unionByName(accepted)


def upsert_protect(prod: DataFrame, stg: DataFrame, keys, locked) -> DataFrame:
    """Like J3, but a prod row that is *locked* (already enriched) is kept
    and the staged row for its key is discarded.

    `locked` is a Column over prod (e.g. ``participants IS NOT NULL``: an empty
    array still locks, NULL does not). A prod row survives exactly when its
    key is not in the batch or the row itself is locked: the locked rows pass,
    the others are anti-joined with the batch keys. Staged rows survive when
    their key is not among the locked keys (key and lock columns of prod).
    """
    _missing(prod, stg)
    ks = _list(keys)
    is_locked = F.coalesce(locked, F.lit(False))
    locked_keys = prod.where(is_locked).select(*ks).join(stg.select(*ks), ks, "left_semi")
    accepted = stg.join(locked_keys, ks, "left_anti")
    kept = prod.where(is_locked).unionByName(prod.where(~is_locked).join(stg.select(*ks), ks, "left_anti"))
    return kept.unionByName(accepted.select(*prod.columns))


def row_delta(before: DataFrame, after: DataFrame) -> DataFrame:
    """G-A3: one row (rows_before, rows_after, delta) from one aggregate.

    The two inputs are tagged and unioned, so both counts come out of a single
    aggregation (no join of two scalars).
    """
    tagged = before.select(F.lit(1).alias("_b"), F.lit(0).alias("_a")).unionByName(
        after.select(F.lit(0).alias("_b"), F.lit(1).alias("_a"))
    )
    agg = tagged.agg(F.sum("_b").cast("bigint").alias("rows_before"), F.sum("_a").cast("bigint").alias("rows_after"))
    return agg.select(
        F.coalesce("rows_before", F.lit(0)).alias("rows_before"),
        F.coalesce("rows_after", F.lit(0)).alias("rows_after"),
        (F.coalesce("rows_after", F.lit(0)) - F.coalesce("rows_before", F.lit(0))).alias("delta"),
    )

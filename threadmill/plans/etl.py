"""End-to-end compositions (P1-P6): incremental extract, clean, stage, upsert,
commit the watermark.

Each function is one Spark application step over DataFrames and table roots;
the run time is always a parameter (reruns of a batch give equal tables).
Order of commits: warehouse tables first, the watermark last, so a failure
anywhere leaves the watermark at the previous run and the next run redoes the
batch (the upserts and the keyed participants append are idempotent).
"""

from __future__ import annotations

import datetime as _dt
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadmill.functions import scalars as S
from threadmill.operators import dedupe, joins, nested, upsert, wordcount
from threadmill.plans import html as H
from threadmill.schemas import KEYS, NOT_NULL, PARTICIPANTS_CLEAN, WATERMARK, WIDTHS, columns
from threadmill.session import checkpoint_dir
from threadmill.sources import extract, tables


@dataclass
class Roots:
    """Where the tables of one deployment live (shared storage)."""

    state: str          # watermarks: one versioned table of (entity, updated_at) per entity below it
    threads: str        # warehouse threads, partitioned by key range (upserts rewrite touched ranges)
    users: str          # warehouse users, partitioned by key range
    participants: str   # append-only warehouse participants, partitioned by thread range
    rejects: str        # staging rows refused by the checks: a folder per entity and run
    staging: str        # run-scoped staging area (lineage cut between steps)
    key_width: int = 100_000  # ids per partition of the warehouse tables


# ----------------------------------------------------------------------------- transforms


def _ts(df: DataFrame, name: str):
    """A stamp column as timestamp_ntz: forum text is parsed (E7); a column
    that is already typed (read from the operational database) is kept."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return S.parse_forum_ts(name)
    return F.col(name).cast("timestamp_ntz")


def _date(df: DataFrame, name: str):
    """A date column: forum text is parsed (E8); typed values are kept."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return S.parse_forum_date(name)
    return F.col(name).cast("date")


def decode_nested_text(threads: DataFrame) -> DataFrame:
    """Nested columns that arrive as text (JSONB read over JDBC, or the legacy
    Python-repr cells of the landing files, A9/D2) become typed arrays;
    columns that are already arrays are left as they are. A cell that cannot
    be read is NULL and counted: `undecoded` tells how many a row has."""
    out = threads
    text = [c for c in ("participants", "status") if c in out.columns and isinstance(out.schema[c].dataType, T.StringType)]
    given = {c: F.col(c).isNotNull() & (F.trim(c) != "None") for c in text}
    out = out.withColumns({f"_given_{c}": v for c, v in given.items()}) if text else out
    if "participants" in out.columns and isinstance(out.schema["participants"].dataType, T.StringType):
        out = out.withColumn("participants", nested.decode_repr_cell("participants"))
    if "status" in out.columns and isinstance(out.schema["status"].dataType, T.StringType):
        out = out.withColumn("status", nested.decode_repr_cell("status", element=T.StringType()))
    undecoded = F.lit(0)
    for c in text:  # the cell `None` is a NULL, not a cell that cannot be read
        undecoded = undecoded + (F.col(f"_given_{c}") & F.col(c).isNull()).cast("int")
    return out.withColumn("undecoded", undecoded).drop(*[f"_given_{c}" for c in text])


def _thread_columns(df: DataFrame) -> DataFrame:
    created = _ts(df, "created_at")
    return df.select(
        "thread_id",
        "title",
        S.truncate_trim("author_name", WIDTHS["threads"]["author_name"]).alias("author_name"),
        "author_id",
        S.abbrev_count("reply_count").alias("reply_count"),
        S.abbrev_count("view_count").alias("view_count"),
        created.alias("created_at"),
        F.col("updated_at").cast("timestamp_ntz").alias("updated_at"),
        "f",
        S.status_array("status").alias("status"),
        "word_count",
    )


def clean_threads(raw: DataFrame) -> DataFrame:
    """P1 transform: counts (E1), word_count (G-A1, in-row over the nested
    replies), typed stamps (E7), width limits (E9); `participants` dropped
    (D6); warehouse column order."""
    return _thread_columns(wordcount.thread_word_count(raw))


def clean_threads_flat(raw: DataFrame, comments: DataFrame) -> DataFrame:
    """P1 transform for threads whose comments are stored flat (the layout
    `collect_threads` writes): word counts come from (thread, word) counts of
    the comment rows, one map per thread (its size is the thread's vocabulary).
    Never enriched (`n_comments` NULL) -> NULL map; enriched without words ->
    empty map."""
    maps = wordcount.word_count_map(comments, "thread_id", "reply")
    empty = F.create_map().cast("map<string,bigint>")
    j = raw.join(maps, "thread_id", "left").withColumn(
        "word_count", F.when(F.col("n_comments").isNull(), F.lit(None).cast("map<string,bigint>"))
        .otherwise(F.coalesce(F.col("word_count"), empty)))
    return _thread_columns(j)


def clean_users(raw: DataFrame, default_location: str = S.DEFAULT_LOCATION) -> DataFrame:
    """P2 transform: default location (E4), typed dates (E7/E8), widths."""
    w = WIDTHS["users"]
    return raw.select(
        "user_id",
        S.truncate_trim("username", w["username"]).alias("username"),
        S.truncate_trim("title", w["title"]).alias("title"),
        S.truncate_trim(S.fill_default("location", default_location), w["location"]).alias("location"),
        _date(raw, "join_date").alias("join_date"),
        _ts(raw, "last_seen").alias("last_seen"),
        "message", "reaction", "point",
        _ts(raw, "created_at").alias("created_at"),
        F.col("updated_at").cast("timestamp_ntz").alias("updated_at"),
    )


def clean_participants(raw_threads: DataFrame) -> DataFrame:
    """P3 transform: C1 -> C3 -> N1 -> G-A4 (in-row keep-last), typed stamps."""
    p = nested.explode_participants(raw_threads.select("thread_id", "participants"))
    return p.select(*columns(PARTICIPANTS_CLEAN))


def clean_participants_flat(comments: DataFrame) -> DataFrame:
    """P3 for flat comments: G-A4 as a grouped keep-last on (thread, user,
    minute) in page order (combines map-side; a hot thread is spread by user
    and minute)."""
    last = dedupe.keep_last(comments, KEYS["participants"], ["page_no", "pos"])
    return last.select(*columns(PARTICIPANTS_CLEAN))


# ----------------------------------------------------------------------------- steps


def _stage(df: DataFrame, root: str, name: str, run_ts: _dt.datetime) -> DataFrame:
    """Write a run-scoped staging copy and read it back: cuts lineage, and every
    later step reads the batch once from storage instead of recomputing it."""
    path = f"{root.rstrip('/')}/{name}/{run_ts.strftime('%Y%m%d%H%M%S')}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def _drop_staging(spark: SparkSession, root: str, names, run_ts: _dt.datetime) -> None:
    """The run's staging copies go once everything has been committed."""
    for name in names:
        tables.drop_path(spark, f"{root.rstrip('/')}/{name}/{run_ts.strftime('%Y%m%d%H%M%S')}")


def _keep_rejects(rejects: DataFrame, rejects_root: str, entity: str, run: str) -> int:
    """Write the refused rows of one entity and run (a rerun replaces its own)
    and return how many there are: the watermark moves past them."""
    path = f"{rejects_root.rstrip('/')}/{entity}/{run}"
    rejects.write.mode("overwrite").parquet(path)
    return rejects.sparkSession.read.schema(rejects.schema).parquet(path).count()


def _state(spark: SparkSession, roots: Roots, entity: str) -> tuple[str, DataFrame | None]:
    """The entity's own watermark table, so steps that run side by side never
    replace each other's."""
    root = f"{roots.state.rstrip('/')}/{entity}"
    return root, tables.read(spark, root, WATERMARK)


def _extracted(source: DataFrame, state: DataFrame | None, entity: str, inclusive: bool) -> DataFrame:
    """A1/A2: the rows that the runs before have not extracted; `inclusive` takes all of the watermark's stamp again."""
    if inclusive:
        return extract.incremental(source, "updated_at", extract.read_watermark(state, entity), True)
    return extract.since(source, "updated_at", state, entity, KEYS[entity])


def _upsert_into(spark: SparkSession, checked: upsert.Checked, root: str, entity: str, roots: Roots, run_ts: _dt.datetime, protect=None) -> dict:
    """Keep the rejects of a checked batch aside, then merge its good rows into
    the touched key ranges of the warehouse table (J3, or J4 with `protect`)."""
    n_rejects = _keep_rejects(checked.rejects, roots.rejects, entity, run_ts.strftime("%Y%m%d%H%M%S"))
    keys = KEYS[entity]

    def merge(prod, batch):
        if protect is not None:
            return upsert.upsert_protect(prod, batch, keys, protect)
        return upsert.upsert_replace(prod, batch, keys)

    return tables.upsert_partitioned(checked.good, root, keys, roots.key_width, merge) | {"rejects": n_rejects}


def threads_and_participants(spark: SparkSession, source: DataFrame, roots: Roots, run_ts: _dt.datetime,
                             inclusive: bool = False, comments: DataFrame | str | None = None) -> dict:
    """P1 + P3: extract threads newer than the threads watermark and those of its
    own stamp that are new (`extract.since`), upsert clean threads (J3), append new participants (keyed anti join, D15), then
    advance the threads watermark to the batch max (D4).

    `source` holds nested `participants` (the operational format of the
    reference), or, with `comments`, an `n_comments` column and a flat comment
    table (the format `collect_threads` writes): a frame, or the root of a
    partitioned table, of which only the batch's key ranges are read.
    """
    state_root, state = _state(spark, roots, "threads")
    # ties are taken from the staged raw rows: what arrives meanwhile is the next run's
    raw = _stage(_extracted(source, state, "threads", inclusive), roots.staging, "threads_raw", run_ts)
    batch = _stage(decode_nested_text(raw), roots.staging, "threads_decoded", run_ts)

    if comments is None:
        threads = clean_threads(batch)
    else:
        if isinstance(comments, str):
            comments = tables.touched_rows(spark, comments, batch, "thread_id", roots.key_width)
        batch_comments = _stage(comments.join(batch.select("thread_id"), "thread_id", "left_semi"),
                                roots.staging, "comments_raw", run_ts)
        threads = clean_threads_flat(batch, batch_comments)
    checked = upsert.check_staging(threads, KEYS["threads"], NOT_NULL.get("threads", ()), None)
    touched = _upsert_into(spark, checked, roots.threads, "threads", roots, run_ts)
    # comments of accepted threads only: their ids occur once, so one key per comment
    accepted = checked.good.select("thread_id")
    if comments is None:
        parts = clean_participants(batch.join(accepted, "thread_id", "left_semi"))
    else:
        parts = clean_participants_flat(batch_comments.join(accepted, "thread_id", "left_semi"))

    # Append only comments not stored yet (null-safe on the comment key),
    # comparing against the touched thread ranges only: a rerun appends nothing
    tables.append_new_partitioned(parts, roots.participants, KEYS["participants"], roots.key_width)

    v_state = tables.write_version(extract.advance(state, raw, "updated_at", "threads", KEYS["threads"]), state_root)
    undecoded = batch.agg(F.sum("undecoded")).first()[0] or 0
    _drop_staging(spark, roots.staging, ("threads_raw", "threads_decoded", "comments_raw"), run_ts)
    return {"threads": touched, "state_version": v_state, "undecoded_cells": undecoded}


def users(spark: SparkSession, source: DataFrame, roots: Roots, run_ts: _dt.datetime,
          inclusive: bool = False, default_location: str = S.DEFAULT_LOCATION) -> dict:
    """Users newer than the *users* watermark (D4), cleaned, upserted."""
    state_root, state = _state(spark, roots, "users")
    batch = _stage(_extracted(source, state, "users", inclusive), roots.staging, "users_raw", run_ts)
    checked = upsert.check_staging(clean_users(batch, default_location), KEYS["users"], NOT_NULL.get("users", ()), None)
    touched = _upsert_into(spark, checked, roots.users, "users", roots, run_ts)
    v_state = tables.write_version(extract.advance(state, batch, "updated_at", "users", KEYS["users"]), state_root)
    _drop_staging(spark, roots.staging, ("users_raw",), run_ts)
    return {"users": touched, "state_version": v_state}


def run_etl(spark: SparkSession, threads_source: DataFrame, users_source: DataFrame, roots: Roots,
            run_ts: _dt.datetime, inclusive: bool = False) -> dict:
    """The scheduled job: threads + participants (P1, P3), then users.

    Each step commits its own watermark after its tables, so a failure in the
    users step leaves the finished threads step in place and the next run
    redoes only what did not commit.
    """
    out = {"threads": threads_and_participants(spark, threads_source, roots, run_ts, inclusive)}
    out["users"] = users(spark, users_source, roots, run_ts, inclusive)
    return out


# ----------------------------------------------------------------------------- collection loads


@dataclass
class Collected:
    """A collection run's staged batch: threads (with `n_comments`: NULL when
    the thread's pages were not collected, else the number of comments), the
    flat comments of the collected threads, and the members whose cards were
    met on the thread pages (load them with `load_collected_users`)."""

    threads: DataFrame
    comments: DataFrame
    members: DataFrame | None = None


COMMENT_ROW_KEY = ["thread_id", "page_no", "pos"]


def collect_threads(listing_pages: DataFrame, thread_pages: DataFrame, stored_threads: DataFrame | None,
                    run_ts: _dt.datetime, f: int, top: int | None = None, exclude_words=None,
                    enrich_first: int | None = None, overlays: DataFrame | None = None) -> Collected:
    """Listing pages -> threads (H1), exact keep-first per id (G-A6), minus
    stored ids (J5), optional keyword exclusion (C5); comments of thread pages
    (H2) attached by id (J6, not by title: D10); stamped with the run time and
    forum section (C7). Load with `load_collected_threads` (J4).

    Comments stay rows (page, position): the reference nested them into one
    array per thread, which would gather a whole thread into one task. What
    J4 needs from the nesting, "this thread has been enriched", is
    `n_comments IS NOT NULL` (0 for a collected thread without comments).
    """
    listed = H.thread_listing(listing_pages)
    listed = dedupe.keep_first(listed, "thread_id", ["page_no", "pos"])
    if top is not None:
        listed = listed.orderBy("page_no", "pos").limit(top)
    if stored_threads is not None:
        listed = joins.anti_seen(listed, stored_threads, "thread_id")
    if exclude_words:
        from threadmill.operators.listing import exclude_keywords

        listed = exclude_keywords(listed, "title", exclude_words)
    comments = H.thread_comments(thread_pages, overlays)
    collected = thread_pages.select(H.thread_id_from_url("url").alias("thread_id")).distinct()
    counts = collected.join(
        comments.groupBy("thread_id").agg(F.count(F.lit(1)).alias("n_comments")), "thread_id", "left"
    ).select("thread_id", F.coalesce("n_comments", F.lit(0)).cast("bigint").alias("n_comments"))
    enriched = joins.enrich(listed, counts, "thread_id")
    if enrich_first is not None:
        # Only the first n listed threads carry comments
        first = listed.orderBy("page_no", "pos").limit(enrich_first).select("thread_id").withColumn("_e", F.lit(True))
        enriched = enriched.join(first, "thread_id", "left").withColumn(
            "n_comments", F.when(F.col("_e"), F.col("n_comments"))).drop("_e")
    run = S.ntz_literal(run_ts)
    threads = enriched.select(
        "thread_id", "title", "author_name", "author_id",
        F.col("reply_count").cast("string").alias("reply_count"),
        F.col("view_count").cast("string").alias("view_count"),
        "n_comments",
        S.format_stamp("created_at").alias("created_at"),
        run.alias("updated_at"),
        F.lit(f).cast("int").alias("f"),
        "status",
    )
    enriched_ids = threads.where(F.col("n_comments").isNotNull()).select("thread_id")
    return Collected(threads, comments.join(enriched_ids, "thread_id", "left_semi"), collect_users(thread_pages, run_ts))


def collect_users(card_pages: DataFrame, run_ts: _dt.datetime) -> DataFrame:
    """Member cards of all pages (H6: C6, G-A5, C7), location escape
    cell cleared (E20), ready for `upsert.upsert_replace` on user_id (J3)."""
    u = H.online_members(card_pages, run_ts)
    return u.withColumn("location", S.replace_escape_cell("location"))


def load_collected_threads(spark: SparkSession, batch: Collected, root: str, comments_root: str,
                           rejects_root: str, key_width: int = 100_000) -> dict:
    """P4 load with J4: a stored thread that has been enriched (`n_comments`
    not NULL, even 0) keeps its row and its comments; other staged threads
    replace or insert theirs.

    The comments of the accepted threads are appended first (keyed on thread,
    page and position, so a rerun adds nothing), then the threads are merged:
    a failure in between is repaired by rerunning the load.
    """
    keys = KEYS["threads"]
    # staged once: each page is parsed by one job, and every later step reads the same rows
    staging = f"{checkpoint_dir(spark).rstrip('/')}/collected-{uuid.uuid4().hex}"
    batch.threads.write.parquet(f"{staging}/threads")
    batch.comments.write.parquet(f"{staging}/comments")
    batch = Collected(spark.read.parquet(f"{staging}/threads"), spark.read.parquet(f"{staging}/comments"))
    checked = upsert.check_staging(batch.threads, keys, NOT_NULL["threads"], None)
    n_rejects = _keep_rejects(checked.rejects, rejects_root, "threads", _run_of(batch.threads))
    good = checked.good
    stored = tables.touched_rows(spark, root, good, keys[0] if not isinstance(keys, str) else keys, key_width)
    to_add = good.where(F.col("n_comments").isNotNull()).select(*keys)
    if stored is not None:
        locked = stored.where(F.col("n_comments").isNotNull()).select(*keys)
        to_add = to_add.join(locked, keys, "left_anti")
    new_comments = batch.comments.join(to_add, keys, "left_semi")
    tables.append_new_partitioned(new_comments, comments_root, COMMENT_ROW_KEY, key_width)
    rule = lambda prod, stg: upsert.upsert_protect(prod, stg, keys, F.col("n_comments").isNotNull())
    report = tables.upsert_partitioned(good, root, keys, key_width, rule) | {"rejects": n_rejects}
    tables.drop_path(spark, staging)
    return report


def _run_of(batch: DataFrame) -> str:
    """The stamp of a collection batch: all of its rows carry the run time."""
    row = batch.agg(F.date_format(F.max("updated_at"), "yyyyMMddHHmmss")).first()
    return row[0] or "empty"


def load_collected_users(spark: SparkSession, batch: DataFrame, root: str, rejects_root: str,
                         key_width: int = 100_000) -> dict:
    """P5/P6 load: collected members into the operational users table."""
    staging = f"{checkpoint_dir(spark).rstrip('/')}/collected-{uuid.uuid4().hex}"
    batch.write.parquet(staging)
    batch = spark.read.parquet(staging)
    checked = upsert.check_staging(batch, KEYS["users"], ["user_id", "username", "title"], None)
    n_rejects = _keep_rejects(checked.rejects, rejects_root, "users", _run_of(batch))
    rule = lambda prod, stg: upsert.upsert_replace(prod, stg, KEYS["users"])
    report = tables.upsert_partitioned(checked.good, root, KEYS["users"], key_width, rule) | {"rejects": n_rejects}
    tables.drop_path(spark, staging)
    return report


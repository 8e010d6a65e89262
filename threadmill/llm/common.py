"""Helpers shared by the operators: reading tables, staging, worker state, hot groups."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from threadmill.session import checkpoint_dir

#: A key is hot when it holds more than this share of the rows; at most
#: 1 / HOT_SHARE keys can, which bounds every broadcast of hot keys.
HOT_SHARE = 1 / 1000
#: Rows that one task numbers at a time.
NUMBER_ROWS = 5000


#: Rows in an Arrow batch: whole texts travel, so a batch of the default 10,000 rows would hold tens of MB.
ARROW_ROWS = 512


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of the session; smaller settings are kept."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    rows = int(spark.conf.get(key))
    if rows <= 0 or rows > ARROW_ROWS:
        spark.conf.set(key, str(ARROW_ROWS))


def table(spark: SparkSession, sf_dir, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{str(sf_dir).rstrip('/')}/{name}.parquet")


def stage(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Write `df` once as Parquet in the shared checkpoint folder and reread it;
    a folder for each value of `by` (few values), where only some are read at a time.

    Cuts the lineage: a lost executor costs the tasks it ran, not the stages
    before. The folder is scratch space of the session; each call takes a new
    name, so concurrent queries never meet.
    """
    spark = df.sparkSession
    small_batches(spark)
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path, partitionBy=by)
    return spark.read.schema(df.schema).parquet(path)


def worker_state(owner: str) -> dict:
    """A dict that outlives a task in its Python worker process (models, caches).
    A worker holds one operator's; another owner's state is dropped."""
    import sys
    import types

    holder = sys.modules.get("_threadmill_worker")
    if holder is None:
        holder = sys.modules["_threadmill_worker"] = types.ModuleType("_threadmill_worker")
        holder.owner = None
    if holder.owner != owner:
        holder.owner, holder.state = owner, {}
    return holder.state


def attach_groups(rows: DataFrame, groups: DataFrame, key: str, size: str, n_rows: int) -> DataFrame:
    """Inner join of `rows` to one `groups` row per `key`, safe for hot keys.

    Groups larger than HOT_SHARE of the rows number fewer than 1 / HOT_SHARE,
    so they are broadcast; all others go through a shuffle join in which no
    key exceeds that share.
    """
    least = max(1000, int(n_rows * HOT_SHARE))
    hot = groups.where(F.col(size) > least)
    rest = groups.where(F.col(size) <= least)
    warm = rows.join(F.broadcast(hot), key, "inner")
    cold = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(rest, key, "inner")
    return warm.unionByName(cold)


def with_row_id(staged: DataFrame, name: str) -> DataFrame:
    """Adds `name`: a hash of each staged row's file and place in it. It tells identical rows
    apart and stays the same when a task is run again."""
    return staged.withColumn(name, F.xxhash64("_metadata.file_path", "_metadata.row_index"))


def numbered(rows: DataFrame, group: str, sizes: dict, order: list[str], name: str) -> DataFrame:
    """Adds `name`: gapless numbers from 0 within each `group` (a few values, of known `sizes`).

    Rows are numbered inside buckets of about NUMBER_ROWS rows and shifted by
    the running count of the buckets before, so no task sorts a whole group.
    Rows that `order` doesn't tell apart share a bucket: where there may be many,
    let it hold `with_row_id`.
    """
    buckets = F.lit(1)
    for k, n in sizes.items():
        if n > NUMBER_ROWS:
            buckets = F.when(F.col(group) == k, -(-n // NUMBER_ROWS)).otherwise(buckets)
    dealt = rows.withColumn("_bucket", F.pmod(F.xxhash64(*order), buckets.cast("bigint")))
    inside = dealt.withColumn("_inner", F.row_number().over(Window.partitionBy(group, "_bucket").orderBy(*order)) - 1)
    before = Window.partitionBy(group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy(group, "_bucket").agg(F.count(F.lit(1)).alias("_n")).select(
        group, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return inside.join(starts, [group, "_bucket"]).withColumn(name, F.col("_start") + F.col("_inner")).drop("_bucket", "_inner", "_start")


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, comp): the smallest node of each linked node's component.

    Alternating large-star and small-star steps over the staged links; every
    step is a grouped minimum and a join, so no adjacency list is gathered.
    """
    edges = stage(
        links.select(F.least(a, b).alias("v"), F.greatest(a, b).alias("u")).where("u <> v").distinct(), "components")
    known = None
    while True:
        # large star: every larger neighbour goes to the smallest node around
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # small star: every smaller neighbour, and the node itself, goes to the smallest one
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionByName(
            low.select("u", F.col("m").alias("v"))).distinct()
        after = stage(small, "components")
        edges = after
        seen = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == known:
            break
        known = seen
    return edges.select(F.col("u").alias("node"), F.col("v").alias("comp")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct())

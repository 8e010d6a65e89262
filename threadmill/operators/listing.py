"""Listing operators: top-N (S1), paging (S2, S3, S5), first-n flag (S4),
keyword exclusion (C5).

Top-N and page slices are `orderBy(...).limit(k)`: Spark plans them as
TakeOrderedAndProject, keeping k rows per partition and merging, so the input
is never fully sorted or shuffled. Positions are only numbered inside the
already-limited result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadmill.functions.scalars import contains_any

# Fixed values (must equal the reference's): listing page size, accepted sort
# columns and directions, and the fallbacks for anything else.
PAGE_SIZE = 20
ORDER_COLUMNS = ("view_count", "reply_count")
DIRECTIONS = ("desc", "asc")
DEFAULT_ORDER, DEFAULT_DIRECTION = "reply_count", "desc"
EXCLUDED_TITLE_WORDS = ("covid", "corona", "covid-19")


def pages_needed(top: int, page_size: int = PAGE_SIZE) -> int:
    """ceil(top / page_size) listing pages."""
    return -(-top // page_size)


def page_sizes(top: int, page_size: int = PAGE_SIZE) -> list[int]:
    """Rows taken from each page, min(remaining, page_size)."""
    return [min(top - i * page_size, page_size) for i in range(pages_needed(top, page_size))]


def _sort_key(order: str, direction: str, id_col: str) -> list[Column]:
    c = F.col(order)
    return [c.desc() if direction == "desc" else c.asc(), F.col(id_col).asc()]


def top_n(df: DataFrame, n: int, order: str = DEFAULT_ORDER, direction: str = DEFAULT_DIRECTION,
          last_days: int | None = 7, ts_col: str = "created_at", id_col: str = "thread_id",
          now: Column | None = None, order_columns=ORDER_COLUMNS) -> DataFrame:
    """The `n` rows with the largest (or smallest) `order` within the last
    `last_days` days before `now`, ties by id. Invalid order / direction fall
    back to reply_count / desc. `now` defaults to the newest `ts_col` (a scalar
    subquery, evaluated once)."""
    if order not in order_columns:
        order = DEFAULT_ORDER if DEFAULT_ORDER in order_columns else order_columns[0]
    if direction not in DIRECTIONS:
        direction = DEFAULT_DIRECTION
    out = df
    if last_days is not None:
        if now is None:
            now = df.agg(F.max(ts_col)).scalar()
        out = out.where(F.col(ts_col) >= now - F.make_dt_interval(F.lit(last_days)))
    return out.orderBy(*_sort_key(order, direction, id_col)).limit(n)


def page_range(df: DataFrame, from_page: int, to_page: int, order: list[Column],
               page_size: int = PAGE_SIZE) -> DataFrame:
    """S5 (+S2): rows of pages from_page..to_page (inclusive, 1-based) in the
    given total order, with `page_no` and `pos` (1-based overall rank).

    Only the first to_page * page_size rows are ever kept (a bounded top-k);
    an empty range gives an empty frame with the same columns.
    """
    if to_page < from_page or to_page < 1:
        return df.withColumn("page_no", F.lit(0)).withColumn("pos", F.lit(0)).limit(0)
    from_page = max(from_page, 1)
    head = df.orderBy(*order).limit(to_page * page_size)
    # numbering inside <= to_page * page_size rows: a single small partition
    w = Window.orderBy(*order)
    ranked = head.withColumn("pos", F.row_number().over(w))
    return (
        ranked.where(F.col("pos") > (from_page - 1) * page_size)
        .withColumn("page_no", F.ceil(F.col("pos") / F.lit(page_size)).cast("int"))
    )


def per_page_limit(df: DataFrame, n: int, pos: str = "pos") -> DataFrame:
    """S3: first `n` rows of each page (`pos` is 0-based within the page)."""
    return df.where(F.col(pos) < n)


def flag_first_n(df: DataFrame, n: int, order: list[Column], keys, flag: str = "enriched") -> DataFrame:
    """Mark the first `n` rows in `order` (top-k ids joined back)."""
    ks = [keys] if isinstance(keys, str) else list(keys)
    first = df.orderBy(*order).limit(n).select(*ks).withColumn(flag, F.lit(True))
    return df.join(first, ks, "left").withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


def exclude_keywords(df: DataFrame, col: str, words=EXCLUDED_TITLE_WORDS) -> DataFrame:
    """Drop rows whose lower-cased text contains any of `words`."""
    return df.where(~contains_any(col, words))


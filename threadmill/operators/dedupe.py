"""Keep-last / keep-first deduplication over flat rows (G-A4 flat, G-A5, G-A6).

Implemented as a grouped `max_by` / `min_by` of the whole row, not as a
`row_number()` window: the aggregate combines map-side (one candidate per key
per input partition), so a key that holds a third of the rows is reduced
before the shuffle instead of being sorted inside one task. NULL keys compare
equal, as in pandas `drop_duplicates`.

The order columns must be unique within a key for a deterministic result
(a position, an event id, a (page, pos) pair).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _list(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def _pick(df: DataFrame, keys, order, last: bool) -> DataFrame:
    ks, os_ = _list(keys), _list(order)
    row = F.struct(*[F.col(c) for c in df.columns]).alias("_row")
    # a struct is never NULL, so a key whose order values are NULL keeps a row
    # (NULL is smaller than any value)
    ordering = F.struct(*[F.col(c) for c in os_])
    pick = F.max_by(row, ordering) if last else F.min_by(row, ordering)
    return df.groupBy(*ks).agg(pick.alias("_row")).select("_row.*")


def keep_last(df: DataFrame, keys, order) -> DataFrame:
    """One row per key: the one with the greatest `order`."""
    return _pick(df, keys, order, last=True)


def keep_first(df: DataFrame, keys, order) -> DataFrame:
    """One row per key: the one with the smallest `order` (exact, unlike D9)."""
    return _pick(df, keys, order, last=False)

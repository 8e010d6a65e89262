"""Text building blocks: punctuation removal and whitespace tokenising.

All of these are built-in Column expressions (JVM side, no Python per row).
"""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (must equal the reference's): the characters removed before
# counting words are exactly Python's `string.punctuation`, the 32 ASCII
# punctuation characters !"#$%&'()*+,-./:;<=>?@[\]^_`{|}~
PUNCTUATION = string.punctuation

# Python's str.split() breaks on every character for which str.isspace() is
# true: the Unicode White_Space set and the four information separators
# 0x1C-0x1F.
WHITESPACE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
_STRIP = r"(?U)^[\s\x{1c}-\x{1f}]+|[\s\x{1c}-\x{1f}]+$"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_punctuation(c) -> Column:
    """Delete the ASCII punctuation characters."""
    return F.translate(_c(c), PUNCTUATION, "")


def py_strip(c) -> Column:
    """Python `str.strip()` (all Unicode whitespace, both ends)."""
    return F.regexp_replace(_c(c), _STRIP, "")


def _split_after(c: Column, deleted: str) -> Column:
    """One `translate` turns every whitespace character into a space and deletes
    `deleted`; splitting at single spaces then needs no regular expression, and
    the empty tokens go with the native `array_remove`."""
    plain = F.translate(c, WHITESPACE + deleted, " " * len(WHITESPACE))
    return F.array_remove(F.split(plain, " "), "")


def split_ws(c) -> Column:
    """Python `str.split()`: whitespace runs, no empty tokens; NULL stays NULL."""
    return _split_after(_c(c), "")


def tokens(c, lower_case: bool = False) -> Column:
    """Punctuation-free whitespace tokens of a text column (G-A1's words).

    ``lower_case=True`` gives the lower-cased variant (G-A1b).
    """
    t = _c(c)
    if lower_case:
        t = F.lower(t)
    return _split_after(t, PUNCTUATION)


def explode_rows(df, keep: list, arr, names):
    """`select(*keep, explode(arr))` without evaluating `arr` twice.

    For a plain `explode`, Catalyst infers the filter `size(arr) > 0` and
    pushes it towards the scan; when `arr` is an expensive expression (a word
    map, an in-row dedupe) it is then computed once for the filter and again
    for the generator. `posexplode_outer` infers nothing; the rows it adds for
    NULL / empty input (position NULL) are dropped right after, so the result
    equals `explode`'s, NULL elements included.
    """
    names = [names] if isinstance(names, str) else list(names)
    out = df.select(*keep, F.posexplode_outer(arr).alias("_at", *names))
    return out.where(F.col("_at").isNotNull()).drop("_at")

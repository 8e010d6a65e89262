"""Scalar cleaning functions (E1-E22) as Column -> Column builders.

Every function is a composition of built-in expressions, so it stays inside
whole-stage code generation. Parsing uses the `try_` forms: malformed input
gives NULL rather than failing the job (ANSI mode is on in Spark 4).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from threadmill.functions.text import _c, py_strip

# Fixed values (must equal the reference's): forum date/time text formats and
# the default location filled in for members without one.
FORUM_TS_FORMAT = "MMM d, yyyy h:mm a"          # "Jun 12, 2022 3:04 PM"
FORUM_TS_FORMAT_SECONDS = "MMM d, yyyy h:mm:ss a"
FORUM_DATE_FORMAT = "MMM d, yyyy"               # "Jun 2, 2022"
STAMP_FORMAT = "MMM dd, yyyy hh:mm a"           # what a run writes: "Jun 12, 2022 03:04 PM"
DEFAULT_LOCATION = "Namek"
OPEN, LOCKED = "Open", "Locked"
LOCATION_ESCAPE_CELL = "\\./"

_ABBREV = r"^\s*([+-]?[0-9]+(?:\.[0-9]+)?)([KM]?)\s*$"


def abbrev_count(c) -> Column:
    """E1: '12K' -> 12000, '3M' -> 3000000, '1.5K' -> 1500; bad text -> NULL.

    Plain integers parse as integers. A fraction before the suffix is scaled
    exactly through decimal arithmetic and rounded half up; a number too
    large for a bigint is NULL.
    """
    c = _c(c)
    mantissa = F.regexp_extract(c, _ABBREV, 1)
    suffix = F.regexp_extract(c, _ABBREV, 2)
    scale = F.when(suffix == "M", F.lit(1_000_000)).when(suffix == "K", F.lit(1_000)).otherwise(F.lit(1))
    value = mantissa.try_cast("decimal(30,6)") * scale
    return F.when(mantissa != "", F.round(value, 0).try_cast("bigint"))


def fill_default(c, default: str = DEFAULT_LOCATION) -> Column:
    """NULL or blank -> default."""
    c = _c(c)
    return F.coalesce(F.nullif(F.trim(c), F.lit("")), F.lit(default))


def format_stamp(c) -> Column:
    """A timestamp as forum text 'Jun 12, 2022 03:04 PM' (text sinks only)."""
    return F.date_format(_c(c), STAMP_FORMAT)


def normalise_forum_text(c) -> Column:
    """Drop the ' at ' joiner and collapse whitespace runs to one space."""
    return F.trim(F.regexp_replace(_c(c), r"\s+at\s+|\s+", " "))


def _parse_ntz(t: Column, fmt: str) -> Column:
    # try_to_timestamp validates; to_timestamp_ntz parses straight to wall-clock
    # time, so no session time zone (or daylight-saving gap) is involved.
    return F.when(F.try_to_timestamp(t, F.lit(fmt)).isNotNull(), F.to_timestamp_ntz(t, F.lit(fmt)))


def parse_forum_ts(c) -> Column:
    """E7: 'Jun 12, 2022 at 3:04 PM' / 'Jun 12, 2022  3:04 PM' -> timestamp_ntz.

    An optional ':ss' is accepted; anything else is NULL.
    """
    t = normalise_forum_text(c)
    return F.coalesce(_parse_ntz(t, FORUM_TS_FORMAT), _parse_ntz(t, FORUM_TS_FORMAT_SECONDS))


def parse_forum_date(c) -> Column:
    """E8: 'Jun 2, 2022' -> date; NULL when malformed."""
    return F.try_to_date(normalise_forum_text(c), FORUM_DATE_FORMAT)


def ntz_literal(value: _dt.datetime) -> Column:
    """A wall-clock timestamp literal (built from text: no time zone applies)."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def truncate_trim(c, width: int) -> Column:
    """Drop trailing blanks, then keep the first `width` characters."""
    return F.left(F.rtrim(_c(c)), F.lit(width))


def replace_invalid_utf8(c, replacement: str = " ") -> Column:
    """Invalid UTF-8 byte sequences -> `replacement` (string or binary input)."""
    c = _c(c)
    valid = F.make_valid_utf8(c.cast("string"))
    return F.translate(valid, "\ufffd", replacement)


def id_from_link(c) -> Column:
    """E11: '/t/some-title.12345/' -> 12345 (digits after the last dot)."""
    return F.regexp_extract(_c(c), r"\.(\d+)/?$", 1).try_cast("int")


def remove_tabs_newlines(c) -> Column:
    """E12."""
    return F.regexp_replace(_c(c), r"[\t\n]", "")


def int_with_separators(c) -> Column:
    """E13: '1,204\\n' -> 1204."""
    return F.regexp_replace(_c(c), r"[\t\n,]", "").try_cast("int")


def digits_or_zero(c) -> Column:
    """Keep digits only, to int, default 0 ('Love 1,204' -> 1204)."""
    return F.coalesce(F.regexp_replace(_c(c), r"\D", "").try_cast("int"), F.lit(0))


def text_after_marker(c, marker: str = "From", default: str = DEFAULT_LOCATION) -> Column:
    """Text after the last `marker`, stripped; `default` when absent."""
    c = _c(c)
    last = F.element_at(F.split(c, _quote(marker)), -1)
    return F.when(c.contains(marker), py_strip(last)).otherwise(F.lit(default))


def strip(c) -> Column:
    """Python strip()."""
    return py_strip(c)


def status_array(c) -> Column:
    """Labels + 'Open' unless 'Locked' is present; no labels -> ['Open']."""
    a = _c(c)
    return (
        F.when(a.isNull() | (F.size(a) == 0), F.array(F.lit(OPEN)))
        .when(F.array_contains(a, LOCKED), a)
        .otherwise(F.array_append(a, F.lit(OPEN)))
    )


def coalesce_run_time(c, run_ts: _dt.datetime) -> Column:
    """Missing value -> the run's timestamp (a parameter, so reruns agree)."""
    return F.coalesce(_c(c), ntz_literal(run_ts))


def role_suffix(title, banner, is_moderator) -> Column:
    """E19: 'title | banner' for moderators."""
    return F.when(_c(is_moderator), F.concat_ws(" | ", _c(title), py_strip(banner))).otherwise(_c(title))


def replace_escape_cell(c, remove_backslashes: bool = False) -> Column:
    """Whole-cell replace of the three characters \\./ by ''."""
    c = _c(c)
    out = F.when(c == F.lit(LOCATION_ESCAPE_CELL), F.lit("")).otherwise(c)
    if remove_backslashes:
        out = F.regexp_replace(out, r"\\", "")
    return out


def array_is_null(c) -> Column:
    """The JSON array is absent (an empty array is *not* null)."""
    return _c(c).isNull()


def contains_any(c, words, lower_case: bool = True) -> Column:
    """Does the text contain any of `words` (case-insensitive by default)."""
    c = _c(c)
    if lower_case:
        c = F.lower(c)
    out = F.lit(False)
    for w in words:
        out = out | c.contains(w.lower() if lower_case else w)
    return out


def _quote(s: str) -> str:
    import re

    return re.escape(s)

"""Nested data: explode, in-row keep-last, JSON text, legacy repr cells.

N1 explode participants, N2 (see wordcount.count_map), N3 flatten, N4 to JSON
text, N5 status array to rows, A9 Python-repr cell decode, A10 typed JSON
recordset, C3 keep non-null nested, G-A4 keep-last of comments.

Comments live inside their thread row, and the comment key contains the thread
id, so duplicates can only occur inside one array. `keep_last_in_array`
therefore removes them inside the row (sort by key and position, keep the last
element of each run): the participants table is produced by a narrow
transformation of the threads table, without any shuffle.
"""

from __future__ import annotations

import ast
import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadmill.functions.text import _c, explode_rows
from threadmill.functions import scalars as S
from threadmill.operators.wordcount import let
from threadmill.schemas import PARTICIPANT

# The per-page / per-cell Python code of this module runs in Python workers.
# Ship it by value, so workers need no installed copy of this package (they
# may start anywhere on a cluster, with any working directory).
from threadmill._ship import ship_by_value  # noqa: E402

ship_by_value(__name__)

PARTICIPANT_FIELDS = ["user_id", "username", "reply", "created_at", "love", "brick"]
COMMENT_KEY = ["user_id", "created_at"]


def _null_safe_eq(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def keep_last_in_array(arr, key_fields: list[str]) -> Column:
    """G-A4 inside one array: for equal key (NULLs equal), keep the last element.

    Returns the surviving elements in their original order. O(n log n) per row.
    """
    a = _c(arr)
    tagged = F.transform(
        a,
        lambda x, i: F.struct(*[x[k].alias(f"_k{j}") for j, k in enumerate(key_fields)], i.alias("_pos"), x.alias("_v")),
    )

    def same_key(x, y):
        out = F.lit(True)
        for j in range(len(key_fields)):
            out = out & _null_safe_eq(x[f"_k{j}"], y[f"_k{j}"])
        return out

    def with_sorted(s):
        n = F.size(s)
        last_of_run = F.filter(
            F.sequence(F.lit(0), n - 1),
            lambda i: (i == n - 1) | ~same_key(s[i], s[F.least(i + 1, n - 1)]),
        )
        kept = F.sort_array(F.transform(last_of_run, lambda i: F.struct(s[i]["_pos"].alias("_pos"), s[i]["_v"].alias("_v"))))
        return F.transform(kept, lambda x: x["_v"])

    return F.when(a.isNull() | (F.size(a) == 0), a).otherwise(let(F.sort_array(tagged), with_sorted))


def explode_participants(threads: DataFrame, key: str = "thread_id", participants: str = "participants",
                         dedupe: bool = True, parse_created_at: bool = True) -> DataFrame:
    """N1 + C3 + G-A4: threads -> one row per comment.

    Rows with NULL participants give nothing (C3). Comments that share
    (user_id, created_at) within a thread keep the last one (G-A4); the thread
    id must be unique in `threads` (the staging checks enforce it).
    Output: thread_id, user_id, username, reply, created_at, love, brick.
    """
    arr = F.col(participants)
    if dedupe:
        arr = keep_last_in_array(arr, COMMENT_KEY)
    rows = explode_rows(threads.where(F.col(participants).isNotNull()), [F.col(key)], arr, "_p")
    cols = [F.col(key)] + [F.col(f"_p.{f}").alias(f) for f in PARTICIPANT_FIELDS]
    out = rows.select(*cols)
    if parse_created_at:
        out = out.withColumn("created_at", S.parse_forum_ts("created_at"))
    return out


def explode_positions(df: DataFrame, keys, arr: str, pos: str = "pos", value: str = "value") -> DataFrame:
    """posexplode with the parent keys first (N1's general form)."""
    ks = [keys] if isinstance(keys, str) else list(keys)
    out = df.select(*ks, F.posexplode_outer(arr).alias(pos, value))
    return out.where(F.col(pos).isNotNull())


def explode_status(threads: DataFrame, key: str = "thread_id", status: str = "status") -> DataFrame:
    """One (thread_id, status) row per label."""
    return explode_rows(threads, [key], F.col(status), "status")


def flatten_lists(c) -> Column:
    """List of lists -> one list."""
    return F.flatten(_c(c))


def to_json_text(c) -> Column:
    """Nested value -> JSON text."""
    return F.to_json(_c(c))


def json_recordset(df: DataFrame, json_col: str, schema: T.StructType) -> DataFrame:
    """A10: a JSON array of objects -> typed rows; unknown keys dropped, missing -> NULL."""
    arr_type = T.ArrayType(schema)
    return df.select(F.inline(F.from_json(F.col(json_col), arr_type)))


# ---------------------------------------------------------------- A9 legacy repr cells

# a backslash and a character after which Python and JSON part ways
_PYTHON_ESCAPE = r"\\[xUNav0-7\n]"
_REPR_OPTIONS = {"allowSingleQuotes": "true", "allowBackslashEscapingAnyCharacter": "true"}


def _literal_eval_json(cells: pd.Series) -> pd.Series:
    """Python-repr text -> JSON text, with `ast.literal_eval` (never `eval`)."""

    def one(v):
        if v is None:
            return None
        try:
            return json.dumps(ast.literal_eval(v))
        except (ValueError, SyntaxError, TypeError, MemoryError, RecursionError):
            return None

    return cells.map(one)


_literal_eval_udf = F.pandas_udf(_literal_eval_json, T.StringType())


def decode_repr_cell(c, element: T.DataType = PARTICIPANT) -> Column:
    """A cell holding a Python-repr list of dicts -> array<struct>.

    The JVM JSON parser accepts single quotes and escaped apostrophes; cells it
    cannot read (`None`, ...) and cells with an escape that JSON reads
    differently (`\\xNN`, `\\UNNNNNNNN`, `\\N{...}`, octal, `\\a`, `\\v`) go
    through an Arrow-batched `ast.literal_eval` fallback, only for those rows.
    """
    c = _c(c)
    arr_type = T.ArrayType(element)
    fast = F.when(~c.rlike(_PYTHON_ESCAPE), F.from_json(c, arr_type, _REPR_OPTIONS))
    # Python UDFs run for every row of their input, so only rows the JVM parser
    # rejected carry their text to Python; the rest send NULL.
    slow = F.from_json(_literal_eval_udf(F.when(fast.isNull(), c)), arr_type)
    return F.when(c.isNull(), F.lit(None).cast(arr_type)).when(fast.isNotNull(), fast).otherwise(slow)

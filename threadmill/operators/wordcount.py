"""Word counting (G-A1, G-A1b, N2, S7) and the README's keyword questions (Q1, Q2).

Two shapes, chosen by where the words live:

* **in-row** (`count_map`, `thread_word_count`): a thread row already holds all
  of its replies (the nested `participants` array), so its `{word: n}` map is
  computed inside the row: sort the tokens, run-length count them. No shuffle,
  no join back, and the cost is O(w log w) per thread. This is the plan that
  scales to a warehouse of threads: the threads table is never repartitioned.
* **grouped** (`word_counts`, `word_count_map`): replies are separate rows
  (exploded comments, conversation turns). Tokens are exploded and counted by
  `groupBy(key, word)`, whose partial aggregation combines map-side, so a hot
  key is spread over many reducers by its words.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadmill.functions.text import _c, explode_rows, tokens


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


# --------------------------------------------------------------------------- in-row


def let(value, body) -> Column:
    """Evaluate `value` once and pass it to `body` as a lambda variable.

    Inside higher-order functions an outer *expression* is re-evaluated for
    every element; a lambda variable is a bound value. Binding the sorted
    array this way keeps the per-row cost O(n log n) instead of O(n^2 log n).
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def count_map(words) -> Column:
    """array<string> -> map<string,bigint> of occurrence counts (NULL stays NULL).

    Sorting brings equal words together; a word's count is the distance between
    its first index and the next distinct word's first index.
    """
    words = _c(words)
    empty = F.create_map().cast("map<string,bigint>")

    def with_sorted(s):
        n = F.size(s)
        starts = F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | (s[i] != s[F.greatest(i - 1, F.lit(0))]))

        def with_starts(st):
            m = F.size(st)
            keys = F.transform(st, lambda i: s[i])
            counts = F.transform(
                F.sequence(F.lit(0), m - 1),
                lambda j: (F.when(j == m - 1, n).otherwise(st[F.least(j + 1, m - 1)]) - st[j]).cast("bigint"),
            )
            return F.map_from_arrays(keys, counts)

        return F.when(n == 0, empty).otherwise(let(starts, with_starts))

    null_map = F.lit(None).cast("map<string,bigint>")
    # the token array itself is bound once too (tokenising is the costly part)
    return let(words, lambda w: F.when(w.isNull(), null_map).otherwise(let(F.sort_array(w), with_sorted)))


def reply_tokens(participants, lower_case: bool = False) -> Column:
    """All punctuation-free tokens of all replies of a thread, flattened.

    A NULL reply contributes nothing; a NULL array stays NULL.
    """
    per_reply = F.transform(_c(participants), lambda p: F.coalesce(tokens(p["reply"], lower_case), F.array().cast("array<string>")))
    return F.flatten(per_reply)


def thread_word_count(threads: DataFrame, participants: str = "participants", out: str = "word_count",
                      lower_case: bool = False) -> DataFrame:
    """G-A1: add `{word: n}` over all replies of each thread.

    NULL participants -> NULL; empty array or no words -> empty map (D13).
    Case is kept unless ``lower_case`` (G-A1b).
    """
    return threads.withColumn(out, count_map(reply_tokens(participants, lower_case)))


def text_word_count(df: DataFrame, text: str, out: str = "word_count", lower_case: bool = False) -> DataFrame:
    """In-row `{word: n}` of one text column (a whole document, a whole reply)."""
    return df.withColumn(out, count_map(tokens(text, lower_case)))


def text_word_rows(df: DataFrame, key, text: str, lower_case: bool = False, tasks: int | None = None) -> DataFrame:
    """In-row counts as `(key..., word, n)` rows: the map of each row, exploded.
    No shuffle: every row is counted where it was read, unless the caller names a
    number of `tasks` to deal the texts over (for files of few, large row groups)."""
    df = df.select(*_keys(key), text)
    if tasks:
        df = df.repartition(tasks)
    return explode_rows(df, _keys(key), count_map(tokens(text, lower_case)), ["word", "n"])


def ordered_counts(df: DataFrame, key, word_count: str = "word_count") -> DataFrame:
    """Map column -> `(key, word, n)` rows, most frequent first, ties by word."""
    ks = _keys(key)
    return explode_rows(df, ks, F.col(word_count), ["word", "n"]).orderBy(*ks, F.desc("n"), "word")


# --------------------------------------------------------------------------- grouped


def word_counts(df: DataFrame, key, text: str, lower_case: bool = False) -> DataFrame:
    """`(key..., word, n)` for texts spread over many rows per key."""
    ks = _keys(key)
    return (
        explode_rows(df, ks, tokens(text, lower_case), "word")
        .groupBy(*ks, "word")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def word_count_map(df: DataFrame, key, text: str, lower_case: bool = False) -> DataFrame:
    """`(key..., word_count map)` from rows: count per (key, word) first, then one
    map per key. The map has one entry per distinct word of the key, so its size
    is bounded by the vocabulary, not by the number of rows. Keys whose texts
    hold no word do not appear (join to the key table for empty maps)."""
    ks = _keys(key)
    return (
        word_counts(df, ks, text, lower_case)
        .groupBy(*ks)
        .agg(F.map_from_entries(F.collect_list(F.struct("word", "n"))).alias("word_count"))
    )


# --------------------------------------------------------------------------- Q1 / Q2


#: Digits behind the point that one piece of an exact sum holds: sums of 10**13 rows stay within 64 bits.
PIECE_DIGITS = 5


def _exact_pieces(facts: DataFrame, column: str, scale: int) -> list[Column]:
    """What to sum so that a column's sum is exact to `scale` decimals, in 64-bit integers: how many values
    can't be held, the whole parts, and the decimals in pieces of PIECE_DIGITS digits."""
    v = F.col(column)
    if not isinstance(facts.schema[column].dataType, (T.DoubleType, T.FloatType)):
        v = v.try_cast(f"decimal(38,{scale})")
        lost = F.col(column).isNotNull() & v.isNull()
        whole = F.floor(v)
        part = ((v - whole) * F.lit(10**scale)).cast("bigint")
    else:
        v = v.cast("double")
        whole = F.floor(v)
        lost = F.isnan(v) | (F.abs(v) >= F.lit(2.0**62))
        part = F.round((v - F.floor(v).cast("double")) * F.lit(10.0**scale)).cast("bigint")
    held = lambda x: F.when(~lost, x)
    out = [F.when(lost, 1).otherwise(0).cast("bigint"), held(whole.try_cast("bigint"))]
    for k in range(0, scale, PIECE_DIGITS):
        digits = min(PIECE_DIGITS, scale - k)
        below = scale - k - digits
        piece = F.floor(part / F.lit(10**below)) if below else part
        out.append(held((piece % F.lit(10**digits) if k else piece).cast("bigint")))
    return out


def _exact_total(sums: list[Column], scale: int) -> Column:
    """The sum of the pieces as a double; NULL where a value or a sum can't be held, or there is no value."""
    exact = f"decimal(38,{scale})"
    total = sums[1].cast(exact)
    for k, s in zip(range(0, scale, PIECE_DIGITS), sums[2:]):
        digits = min(scale, k + PIECE_DIGITS)
        total = total + (s.cast("decimal(20,0)") * F.lit(Decimal(1).scaleb(-digits))).cast(exact)
    return F.when(sums[0] == 0, total.cast("double"))


def keyword_stats(facts: DataFrame, dims: DataFrame, key: str, title: str, measures: dict[str, str],
                  lower_case: bool = True, scale: int = 10) -> DataFrame:
    """Q1: do words in a title go with larger measures?

    ``facts`` carries the measures per row and a foreign key into ``dims``
    (which carries the title). Facts are reduced to one row per key *before*
    the join (partial aggregation absorbs hot keys and shrinks the shuffle from
    fact rows to distinct keys); titles are tokenised once per key; then sums
    and counts are re-aggregated per word. Averages are sum / count.

    ``measures`` maps output name -> fact column. Each value counts to ``scale``
    decimal places; whole parts and decimals are summed as 64-bit integers, so
    sums are exact and do not depend on the order of summation; they are
    converted to double once at the end. A sum is NULL, never short, where a
    value (NaN, 2**62 and beyond) or the sum itself can't be held. NULLs are
    left out of sums and count as rows.
    """
    pieces = {name: _exact_pieces(facts, c, scale) for name, c in measures.items()}
    per_key = facts.groupBy(key).agg(
        F.count(F.lit(1)).alias("_n"), *[F.try_sum(p).alias(f"_{k}_{name}") for name, ps in pieces.items() for k, p in enumerate(ps)])
    words = explode_rows(dims, [F.col(key)], F.array_distinct(tokens(title, lower_case)), "word")
    joined = per_key.join(words, key, "inner")
    agg = joined.groupBy("word").agg(
        F.sum("_n").alias("n_rows"),
        *[F.try_sum(f"_{k}_{name}").alias(f"_{k}_{name}") for name, ps in pieces.items() for k in range(len(ps))],
    )
    out = [F.col("word"), F.col("n_rows")]
    for name, ps in pieces.items():
        total = _exact_total([F.col(f"_{k}_{name}") for k in range(len(ps))], scale)
        out.append(total.alias(f"sum_{name}"))
        out.append((total / F.col("n_rows")).alias(f"avg_{name}"))
    return agg.select(*out)


def top_words(df: DataFrame, key, text: str, k: int, lower_case: bool = False) -> DataFrame:
    """Q2: the `k` most frequent words over the given rows (ties by word)."""
    counts = word_counts(df, key, text, lower_case).groupBy("word").agg(F.sum("n").alias("n"))
    return counts.orderBy(F.desc("n"), F.asc("word")).limit(k)

"""Q1 beyond averages: quantiles of a measure for each title word, from mergeable sketches.

Means follow a few viral threads; medians don't, but exact ones need all values
of a word in one place. A KLL sketch holds a bounded number of values, is built
map-side per key, merged per word and merged again over runs, so each run reads
its own facts only. Its error is in rank: with `k` = 400 below 1 % of the
rows, whatever their number; words of few rows are exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadmill.functions.text import explode_rows, tokens

K = 400


def keyword_sketches(facts: DataFrame, dims: DataFrame, key: str, title: str, measure: str, lower_case: bool = True, k: int = K) -> DataFrame:
    """`(word, sketch)` of one run: facts become one sketch a key, titles are
    tokenised once, sketches are merged per word. NULL and NaN measures take no part."""
    value = F.col(measure).cast("double")
    per_key = facts.where(value.isNotNull() & ~F.isnan(value)).groupBy(key).agg(F.kll_sketch_agg_double(value, F.lit(k)).alias("sketch"))
    words = explode_rows(dims, [F.col(key)], F.array_distinct(tokens(title, lower_case)), "word")
    return merged(per_key.join(words, key).select("word", "sketch"), "word", k)


def merged(sketches: DataFrame, by, k: int = K) -> DataFrame:
    """One sketch for each value of `by`, of several runs' or keys' sketches."""
    by = [by] if isinstance(by, str) else list(by)
    return sketches.groupBy(*by).agg(F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"))


def n_values(sketch="sketch") -> Column:
    """How many values a sketch has seen (exact)."""
    return F.kll_sketch_get_n_double(sketch)


def quantile(q: float, sketch="sketch") -> Column:
    return F.kll_sketch_get_quantile_double(sketch, F.lit(float(q)))


def rank_errors(facts: DataFrame, dims: DataFrame, key: str, title: str, measure: str, sketches: DataFrame, q: float,
                lower_case: bool = True) -> DataFrame:
    """`(word, n_rows, error)`: by how many rows, as a share, the sketch's quantile misses `q`.
    Ties span a range of ranks; the error is the distance to that range (0 inside)."""
    words = explode_rows(dims, [F.col(key)], F.array_distinct(tokens(title, lower_case)), "word")
    value = F.col(measure).cast("double")
    told = sketches.select("word", quantile(q).alias("_q"))
    facts = facts.select(key, value.alias("_v")).where(value.isNotNull() & ~F.isnan(value))
    # values of one key and size meet the words as a count, not as rows
    counted = facts.groupBy(key, "_v").agg(F.count(F.lit(1)).alias("_n"))
    ranks = counted.join(words, key).join(told, "word").groupBy("word").agg(
        F.sum("_n").alias("n_rows"), F.sum(F.when(F.col("_v") < F.col("_q"), F.col("_n")).otherwise(0)).alias("_below"),
        F.sum(F.when(F.col("_v") <= F.col("_q"), F.col("_n")).otherwise(0)).alias("_upto"))
    low, high = F.col("_below") / F.col("n_rows"), F.col("_upto") / F.col("n_rows")
    return ranks.select("word", "n_rows", F.greatest(low - F.lit(q), F.lit(q) - high, F.lit(0.0)).alias("error"))

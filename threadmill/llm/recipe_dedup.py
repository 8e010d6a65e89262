"""Exact dedup by content-defined chunk recipes (DataFrame functions only).

Two texts are equal when they are identical after deleting ASCII white space.
Each normalised text is cut where its own content says so, chunks are
deduplicated to verified identifiers, and a document becomes the ordered list
of its chunk identifiers (its recipe). Long texts move through one shuffle, as
chunks that are combined before it; everything after compares recipes.

Verified: a chunk's digest only proposes an identifier. The chunk contents
themselves are grouped next to the digest, and where one digest stands for
several contents, each content gets its own ordinal, so unequal chunks never
share an identifier.

Defined results: a NULL text counts as empty; empty and all-white texts have
the empty recipe and are equal to each other; a NULL doc_id loses every tie; a
repeated row (same doc_id) shares the decision of its twin; an empty table
gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadmill.llm.common import attach_groups, stage

# The characters [\x20\x09-\x0D] that normalisation deletes.
WHITE = [" ", "\t", "\n", "\x0b", "\f", "\r"]

MIN_CHUNK, MAX_CHUNK = 1024, 8192


def normalised(text: Column) -> Column:
    """`text` without ASCII white space; NULL is empty."""
    return reduce(lambda c, w: F.replace(c, F.lit(w), F.lit("")), WHITE, F.coalesce(text, F.lit("")))


def chunk_pattern(least: int = MIN_CHUNK, most: int = MAX_CHUNK) -> str:
    """A chunk ends after `least` characters at the first three characters whose
    codes are 6 mod 11, after `most` characters, or with the text."""
    marks = "".join(f"\\x{c:02x}" for c in range(33, 127) if c % 11 == 6)
    return rf"(?s).{{{least},{most}}}?(?<=[{marks}]{{3}})|.{{{1},{most}}}"


def chunks(text: Column, least: int = MIN_CHUNK, most: int = MAX_CHUNK) -> Column:
    """Ordered chunks of a text; their concatenation is the text."""
    return F.regexp_extract_all(text, F.lit(chunk_pattern(least, most)), F.lit(0))


def recipes(
    docs: DataFrame,
    digest: Callable[[Column], Column] = F.xxhash64,
    least: int = MIN_CHUNK,
    most: int = MAX_CHUNK,
) -> DataFrame:
    """One row per document: doc_id, n_points (code points of the text as given),
    text_sha256 (normalised text), recipe (ordered verified chunk identifiers)."""
    norm = docs.select("doc_id", F.length(F.coalesce("text", F.lit(""))).alias("n_points"), normalised(F.col("text")).alias("norm"))
    cut = norm.withColumn("chunk", chunks(F.col("norm"), least, most))
    listed = stage(
        cut.select("doc_id", "n_points", F.sha2("norm", 256).alias("text_sha256"), F.transform("chunk", lambda c: digest(c)).alias("digests")),
        "recipes",
    )

    pieces = cut.select("doc_id", F.posexplode("chunk").alias("pos", "chunk")).withColumn("digest", digest(F.col("chunk")))
    # the only shuffle of text: distinct contents, combined before it
    contents = pieces.groupBy("digest", "chunk").agg(F.count(F.lit(1)).alias("n"))
    shared = stage(contents.groupBy("digest").agg(F.count(F.lit(1)).alias("n_contents")).where("n_contents > 1"), "shared-digests")
    if shared.isEmpty():  # every digest stands for one content: it is the identifier
        return listed.select(
            "doc_id", "n_points", "text_sha256",
            F.transform("digests", lambda d: F.struct(d.alias("digest"), F.lit(0).alias("ordinal"))).alias("recipe"),
        )
    return _with_ordinals(listed, pieces, shared)


def _with_ordinals(listed: DataFrame, pieces: DataFrame, shared: DataFrame) -> DataFrame:
    """Recipes in which contents that share a digest differ by their ordinal."""
    again = stage(pieces.join(shared, "digest", "left_semi"), "shared-chunks")
    # smaller contents of the same digest: a join of distinct contents only
    one = again.select("digest", "chunk").distinct()
    other = one.select(F.col("digest").alias("same_digest"), F.col("chunk").alias("smaller"))
    ordinals = (
        one.join(other, (F.col("digest") == F.col("same_digest")) & (F.col("smaller") < F.col("chunk")), "left")
        .groupBy("digest", "chunk").agg(F.count("smaller").cast("int").alias("ordinal"))
        .where("ordinal > 0")
    )
    fixes = (
        again.join(ordinals, ["digest", "chunk"])
        .select("doc_id", "pos", "ordinal").distinct()
        .groupBy("doc_id").agg(F.collect_list(F.struct("pos", "ordinal")).alias("fix"))  # at most one per chunk of a text
    )
    at = lambda i: F.filter("fix", lambda f: f["pos"] == i)
    return (
        listed.join(fixes.withColumnRenamed("doc_id", "fix_id"), F.col("doc_id").eqNullSafe(F.col("fix_id")), "left")
        .select(
            "doc_id", "n_points", "text_sha256",
            F.transform("digests", lambda d, i: F.struct(
                d.alias("digest"), F.coalesce(F.get(at(i), F.lit(0))["ordinal"], F.lit(0)).alias("ordinal"))).alias("recipe"),
        )
    )


def dedup(docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, n_points.

    Of equal texts, the one with the most code points as given stays, then the
    smallest doc_id. `options` go to `recipes`.
    """
    rows = stage(recipes(docs, **options), "dedup-rows")
    groups = rows.groupBy("recipe").agg(
        F.count(F.lit(1)).alias("group_size"),
        F.max(F.struct("n_points", (-F.col("doc_id")).alias("minus_id"))).alias("best"),
    )
    joined = attach_groups(rows, groups, "recipe", "group_size", rows.count())
    keep = -F.col("best.minus_id")
    return joined.select(
        "doc_id", keep.alias("keep_id"), "group_size", F.col("doc_id").eqNullSafe(keep).alias("kept"), "text_sha256", "n_points",
    )


def op3(spark, sf_dir) -> DataFrame:
    from threadmill.llm.common import table

    return dedup(table(spark, sf_dir, "documents")).drop("n_points")


OP3_SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_points,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents
), r AS (
  SELECT doc_id, norm,
         first_value(doc_id) OVER (PARTITION BY norm ORDER BY n_points DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY norm) AS group_size
  FROM d
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM r
"""

"""The training-data pipeline: operators of `threadmill.llm` as stages over documents.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and reread as the next stage's documents. All but the last return
the columns of `documents`; the last returns the packed pieces.

Documents travel as one struct column beside what a stage adds, so extra
columns may have any names and are handed on. Decisions are made per row:

- toxicity: NULL and empty texts are scored like a text without any
  landmark-like word; without labels of both classes all rows stay; repeated
  rows get the same score and go or stay together.
- copies: of equal normalised texts the row with the most code points, then
  the smallest doc_id (NULL ids last) stays, one row of repeated ones.
- near copies: of each component of similar sets the row with the smallest
  doc_id stays (NULL ids last, then the set's fingerprint), whatever ids other
  rows share with it; rows without words are linked with nothing and stay.
- an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from threadmill.llm import packing, parity_join, pii, recipe_dedup, toxicity
from threadmill.llm.common import stage, table


def _rows(docs, **more):
    """The documents as one struct column `row`, and columns computed from them."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *[c.alias(n) for n, c in more.items()])


def drop_toxic(spark, docs, sf_dir):
    """Documents that the classifier rejects go (operator 7)."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(_rows(docs, text=F.col("text")), model, carry=("row",)).where("score < 0.5").select("row.*")


def drop_copies(spark, docs, sf_dir):
    """One document of each group of equal texts stays (operator 3)."""
    kept = recipe_dedup.dedup(docs.select("doc_id", "text")).where("kept").select(F.col("doc_id").alias("keep_id"), F.col("text_sha256").alias("sha"), "n_points")
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = _rows(docs, doc_id=F.col("doc_id"), sha=F.sha2(recipe_dedup.normalised(F.col("text")), 256), points=F.length(text), given=text)
    same = rows.join(kept.dropDuplicates(["sha"]), "sha").where(F.col("doc_id").eqNullSafe(F.col("keep_id")))
    # a repeated row of the document that stays is a copy as well: the longest, then the least text
    first = same.groupBy("sha").agg(F.min_by("row", F.struct((-F.col("points")).alias("fewer"), "given")).alias("row"))
    return first.select("row.*")


def drop_near_copies(spark, docs, sf_dir):
    """One document of each component of similar texts stays (operator 6)."""
    rows = stage(parity_join.described_rows(docs), "near-rows")
    stays = stage(parity_join.representatives(docs), "near-kept").withColumnRenamed("node", "kept_node")
    same = (F.col("node") == F.col("kept_node")) & F.col("row.doc_id").cast("bigint").eqNullSafe(F.col("first_doc"))
    first = rows.where("n_shingles > 0").join(stays, same, "left_semi").groupBy("node").agg(F.min_by("row", F.struct("row.text")).alias("row"))
    return first.select("row.*").unionByName(rows.where("n_shingles = 0").select("row.*"))


def redact_pii(spark, docs, sf_dir):
    """Personal data is replaced by its kind (operator 4)."""
    return pii.redact(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def pack(spark, docs, sf_dir):
    """Token sequences (operator 8)."""
    return packing.op8_rows(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("ngram_jaccard_join", drop_near_copies),
    ("pii", redact_pii),
    ("best_fit_packing", pack),
]

#: A trained classifier and a tokenizer are among the stages: no SQL.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

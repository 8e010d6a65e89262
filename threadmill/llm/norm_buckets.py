"""Ranked lexical search over norm buckets.

A document is a vector of term impacts, an item a vector of term counts, and a
score is their inner product with the terms' weights. Documents are ordered by
the length (Euclidean norm) of their vectors and cut into waves, the longest
first, each WAVE_GROWTH times the one before; a wave is read by many tasks in
buckets of BUCKET_ROWS documents of falling length. Every item has a threshold,
its k-th best score so far. In a bucket

- Cauchy-Schwarz drops the items whose length times the longest vector stays
  below their threshold;
- coordinate bounds (the largest impact of each term in the bucket) drop
  further items, and for the rest split the terms: a document with none of the
  item's heaviest terms can't reach the threshold, so only the postings of
  those are added up, and documents whose sum and remaining bound stay below
  are dropped;
- what survives is scored exactly, in 64-bit integers.

Bounds are never below the true score (integers; the norms with a margin), and
equal scores are never pruned, so the result is exact. A task hands on its k
best documents of an item at most; thresholds rise from wave to wave.

Items are a query set: they are taken in blocks of about BLOCK_TERMS terms, a
block's vocabulary, weights and thresholds are held by the driver and every
task. Each block meets all documents. Document counts, lengths and document
frequencies are taken over the whole table.

Defined results: NULL and empty texts have no terms: such documents are not
counted and such items have no results; repeated documents are documents of
their own; rows that share an item_id are separate items, and each has its
ranks; a NULL doc_id comes after all others of its score; empty tables give no
rows; other columns are ignored.
"""

from __future__ import annotations

import math
import uuid

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from threadmill.llm.common import stage, table, worker_state

TOP = 20
#: Terms (items' distinct ones) of a block of items.
BLOCK_TERMS = 1 << 20
#: Documents of the first wave, and how many times as many each further one has.
FIRST_WAVE, WAVE_GROWTH = 4096, 8
#: Documents of a bucket.
BUCKET_ROWS = 2048
#: Steps of the histogram of norms to a factor of two.
NORM_STEPS = 16
#: Relative error that a norm or its product may have.
MARGIN = 1e-9

#: Fixed values of the contract: what separates terms, and the constants of weight, impact and length.
SEPARATORS = bytes([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
UPPER = bytes(range(0x41, 0x5B))
FOLD = bytes.maketrans(SEPARATORS + UPPER, b" " * len(SEPARATORS) + UPPER.lower())
WEIGHT_SCALE, IMPACT_SCALE, TF_SCALE, LENGTH_SCALE = 1000, 1_000_000_000, 1000, 12
LENGTH_FLAT, LENGTH_SLOPE = 75, 25


def terms(text: bytes | None) -> list[bytes]:
    """The terms of a text in UTF-8: only ASCII separates, only A-Z is lower-cased."""
    return text.translate(FOLD).split() if text else []


def impacts(tf: np.ndarray, length: np.ndarray) -> np.ndarray:
    return (IMPACT_SCALE * tf) // (TF_SCALE * tf + LENGTH_SCALE * length)


def weight(n_docs: int, df: int) -> int:
    return math.floor(WEIGHT_SCALE * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _item_vectors(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """item_id, spelled (distinct terms), counts; items without terms are left out."""

    def run(batches):
        import pyarrow as pa

        for b in batches:
            ids, words, counts = [], [], []
            for at, t in enumerate(b.column(1).cast(pa.binary()).to_pylist()):
                if found := terms(t):
                    own, n = np.unique(np.array(found, object), return_counts=True)
                    ids.append(at)
                    words.append(own.tolist())
                    counts.append(n.tolist())
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(ids, pa.int64())), pa.array(words, pa.list_(pa.binary())), pa.array(counts, pa.list_(pa.int64()))],
                names=["item_id", "spelled", "counts"])

    kind = dict(items.dtypes)[item_id]
    return items.select(F.col(item_id).alias("item_id"), F.col(text).alias("_text")).mapInArrow(
        run, f"item_id {kind}, spelled array<binary>, counts array<bigint>")


class Items:
    """A block of item vectors as arrays: entries of item i are at start[i]:start[i + 1]."""

    def __init__(self, rows):
        self.vocabulary: dict[bytes, int] = {}
        ids = [self.vocabulary.setdefault(bytes(t), len(self.vocabulary)) for r in rows for t in r.spelled]
        self.token = uuid.uuid4().hex
        self.term = np.array(ids, np.int32)
        self.count = np.array([c for r in rows for c in r.counts], np.int64)
        self.start = np.cumsum([0] + [len(r.spelled) for r in rows])
        self.n = len(rows)

    def weigh(self, weights: np.ndarray) -> None:
        self.weights = weights
        squares = self.count.astype(float) ** 2 * weights[self.term]
        self.norm = np.sqrt(np.add.reduceat(squares, self.start[:-1])) if self.n else np.zeros(0)


def _rows(docs: DataFrame, items: Items, doc_id: str, text: str) -> DataFrame:
    """doc_id, n (terms with repeats), terms and tfs (of the block's vocabulary, packed)."""
    vocabulary = items.vocabulary

    def run(batches):
        import pyarrow as pa

        get = vocabulary.get
        for b in batches:
            n, own, tfs = [], [], []
            for t in b.column(1).cast(pa.binary()).to_pylist():
                found = terms(t)
                n.append(len(found))
                ids, tf = np.unique(np.fromiter((i for i in map(get, found) if i is not None), np.int32), return_counts=True)
                own.append(ids.tobytes())
                tfs.append(tf.astype(np.int32).tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(own, pa.binary()), pa.array(tfs, pa.binary())], names=["doc_id", "n", "terms", "tfs"])

    return docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("_text")).mapInArrow(
        run, "doc_id bigint, n bigint, terms binary, tfs binary")


def _document_frequencies(rows: DataFrame, size: int) -> np.ndarray:
    """In how many documents each of `size` terms occurs."""

    def run(batches):
        import pyarrow as pa

        df = np.zeros(size, np.int64)
        for b in batches:
            df += np.bincount(np.frombuffer(b"".join(b.column(0).to_pylist()), np.int32), minlength=size)
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(df[at], pa.int64())], names=["term", "df"])

    out = np.zeros(size, np.int64)
    for r in rows.select("terms").mapInArrow(run, "term bigint, df bigint").groupBy("term").agg(F.sum("df").alias("df")).toLocalIterator():
        out[r.term] = r.df
    return out


def _lengths(n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    return LENGTH_FLAT + (LENGTH_SLOPE * n * n_docs) // n_terms


def _with_norms(rows: DataFrame, weights: np.ndarray, n_docs: int, n_terms: int) -> DataFrame:
    """The rows that hold a term of weight, with length, norm and its step in the histogram."""

    def run(batches):
        import pyarrow as pa

        for b in batches:
            lengths = _lengths(b.column(1).to_numpy(), n_docs, n_terms)
            norms = np.zeros(b.num_rows)
            for i, (own, tf) in enumerate(zip(b.column(2).to_pylist(), b.column(3).to_pylist())):
                impact = impacts(np.frombuffer(tf, np.int32).astype(np.int64), lengths[i])
                norms[i] = math.sqrt(float((weights[np.frombuffer(own, np.int32)] * (impact.astype(float) ** 2)).sum()))
            keep = np.flatnonzero(norms > 0)
            some = b.take(pa.array(keep))
            yield pa.RecordBatch.from_arrays(
                [some.column(0), pa.array(lengths[keep]), some.column(2), some.column(3), pa.array(norms[keep]),
                 pa.array(np.floor(np.log2(norms[keep]) * NORM_STEPS).astype(np.int32))],
                names=["doc_id", "length", "terms", "tfs", "norm", "step"])

    return rows.mapInArrow(run, "doc_id bigint, length bigint, terms binary, tfs binary, norm double, step int")


def wave_steps(histogram: dict[int, int]) -> list[int]:
    """The lowest step of each wave, from the counts of documents by step; all but the last wave hold their size at least."""
    out, held, size = [], 0, FIRST_WAVE
    for step in sorted(histogram, reverse=True):
        held += histogram[step]
        if held >= size:
            out.append(step)
            held, size = 0, size * WAVE_GROWTH
    if held:
        out.append(min(histogram))
    return out


class Best:
    """The k best documents of an item that a task has met: scores, NULL flags and ids, best first."""

    def __init__(self, least: int):
        self.least = least
        self.score, self.null, self.doc = (np.zeros(0, t) for t in (np.int64, bool, np.int64))

    def add(self, score, null, doc) -> None:
        score, null, doc = np.concatenate([self.score, score]), np.concatenate([self.null, null]), np.concatenate([self.doc, doc])
        order = np.lexsort((doc, null, -score))[:TOP]
        self.score, self.null, self.doc = score[order], null[order], doc[order]
        if len(order) == TOP:
            self.least = max(self.least, int(self.score[-1]))


def search_bucket(items: Items, best: list[Best], doc, null, length, own, tfs, norms) -> None:
    """Adds to `best` what one bucket of documents (arrays; packed terms and tfs) holds."""
    sizes = np.array([len(x) // 4 for x in own])
    term = np.frombuffer(b"".join(own), np.int32)
    value = items.weights[term] * impacts(np.frombuffer(b"".join(tfs), np.int32).astype(np.int64), np.repeat(length, sizes))
    row = np.repeat(np.arange(len(sizes)), sizes)
    least = np.array([b.least for b in best], np.int64)
    # Cauchy-Schwarz on the bucket's longest vector
    alive = items.norm * (float(norms.max()) * (1 + MARGIN)) >= least * (1 - MARGIN)
    if not alive.any():
        return
    order = np.argsort(term, kind="stable")
    term, value, row = term[order], value[order], row[order]
    cut = np.flatnonzero(np.concatenate([[True], term[1:] != term[:-1], [True]]))
    largest, at = np.zeros(len(items.weights), np.int64), np.full(len(items.weights), -1, np.int64)
    largest[term[cut[:-1]]] = np.maximum.reduceat(value, cut[:-1])
    at[term[cut[:-1]]] = np.arange(len(cut) - 1)
    # coordinate bounds
    bound = items.count * largest[items.term]
    alive &= np.add.reduceat(bound, items.start[:-1]) >= least
    score = np.zeros(len(sizes), np.int64)
    for i in np.flatnonzero(alive):
        a, b = items.start[i], items.start[i + 1]
        by_bound = a + np.argsort(-bound[a:b], kind="stable")
        rest = np.cumsum(bound[by_bound][::-1])[::-1]  # what a term and those after it can add
        heavy = int(np.searchsorted(-rest, -best[i].least, side="right"))  # the others stay below the threshold together
        score[:] = 0

        def add(entries):
            for e in entries:
                if (k := at[items.term[e]]) >= 0:
                    score[row[cut[k] : cut[k + 1]]] += items.count[e] * value[cut[k] : cut[k + 1]]

        add(by_bound[:heavy])
        left = int(rest[heavy]) if heavy < len(rest) else 0
        possible = (score > 0) & (score + left >= best[i].least)
        if left and possible.any():
            add(by_bound[heavy:])
        hit = np.flatnonzero(possible & (score >= best[i].least))
        if len(hit):
            best[i].add(score[hit], null[hit], doc[hit])


def _search(vectors: DataFrame, items: Items, least: np.ndarray) -> DataFrame:
    """item (number), doc_id, score: each task's best documents of every item that reach `least`."""

    def run(batches):
        import pyarrow as pa

        held = worker_state("norm-buckets")
        if held.get("token") != items.token:
            held.clear()
            held.update(token=items.token, items=items)
        best = [Best(max(1, int(x))) for x in least]

        def flush(some):
            t = pa.Table.from_batches(some).combine_chunks()
            doc = t.column(0).combine_chunks()
            search_bucket(
                held["items"], best, doc.fill_null(0).to_numpy(zero_copy_only=False), doc.is_null().to_numpy(zero_copy_only=False),
                t.column(1).to_numpy(), t.column(2).to_pylist(), t.column(3).to_pylist(), t.column(4).to_numpy())

        some, rows = [], 0
        for b in batches:
            if b.num_rows:
                some.append(b)
                rows += b.num_rows
            if rows >= BUCKET_ROWS:
                flush(some)
                some, rows = [], 0
        if rows:
            flush(some)
        for at in range(0, len(best), 1024):
            part = best[at : at + 1024]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.repeat(np.arange(at, at + len(part)), [len(x.score) for x in part]), pa.int64()),
                pa.array(np.concatenate([x.doc for x in part]), pa.int64(), mask=np.concatenate([x.null for x in part])),
                pa.array(np.concatenate([x.score for x in part]), pa.int64()),
            ], names=["item", "doc_id", "score"])

    return vectors.select("doc_id", "length", "terms", "tfs", "norm").mapInArrow(run, "item bigint, doc_id bigint, score bigint")


def _ranked(hits: DataFrame) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= TOP)


def search(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text") -> DataFrame:
    """item_id, rank, doc_id, score: the TOP documents of each item."""
    spark = docs.sparkSession
    vectors = stage(_item_vectors(items, item_id, text), "search-items")
    entries = vectors.agg(F.sum(F.size("spelled"))).first()[0] or 0
    blocks = -(-entries // BLOCK_TERMS)
    block_of = F.pmod(F.xxhash64("item_id", "spelled"), F.lit(max(1, blocks)))
    out = []
    for block in range(blocks):
        taken = vectors.where(block_of == block).collect()  # about BLOCK_TERMS terms
        if taken:
            out.append(_search_block(docs, Items(taken), [r.item_id for r in taken], vectors.schema["item_id"].dataType, doc_id, text))
    if not out:
        return vectors.select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("bigint").alias("doc_id"), F.lit(0).cast("bigint").alias("score")).limit(0)
    found = out[0]
    for more in out[1:]:
        found = found.unionByName(more)
    return found


def _search_block(docs, items: Items, names: list, kind, doc_id: str, text: str) -> DataFrame:
    spark = docs.sparkSession
    rows = stage(_rows(docs, items, doc_id, text), "search-rows")
    n_docs, n_terms = rows.where("n > 0").agg(F.count(F.lit(1)), F.sum("n")).first()
    df = _document_frequencies(rows, len(items.vocabulary))
    items.weigh(np.array([weight(n_docs, int(x)) for x in df], np.int64))
    norms = _with_norms(rows.where("n > 0"), items.weights, n_docs, n_terms or 1)
    steps = {r.step: r["count"] for r in norms.groupBy("step").count().collect()}
    lowest = wave_steps(steps)
    wave = F.lit(len(lowest))
    for k in range(len(lowest) - 1, -1, -1):
        wave = F.when(F.col("step") >= lowest[k], k).otherwise(wave)
    ordered = norms.withColumn("wave", wave.cast("int")).drop("step").sortWithinPartitions("wave", F.desc("norm"))
    by_wave = stage(ordered, "search-waves", by="wave")
    tops = spark.createDataFrame([], "item bigint, doc_id bigint, score bigint, rank int")
    least = np.zeros(items.n, np.int64)
    for k in range(len(lowest)):
        hits = _search(by_wave.where(F.col("wave") == k), items, least)
        tops = stage(_ranked(tops.drop("rank").unionByName(hits)), "search-top")
        if k + 1 < len(lowest):
            for r in tops.where(F.col("rank") == TOP).select("item", "score").toLocalIterator():
                least[r.item] = r.score
    named = spark.createDataFrame(list(enumerate(names)), f"item bigint, item_id {kind.simpleString()}")
    return tops.join(named, "item").select("item_id", "rank", "doc_id", "score")


def op13(spark, sf_dir) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_TERMS = r"regexp_extract_all(translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
OP13_SQL = f"""
WITH tf AS (
    SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest({_TERMS.format('text')}) AS term FROM documents) GROUP BY doc_id, term
), len AS (
    SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY doc_id
), tot AS (
    SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM len
), df AS (
    SELECT term, count(*) AS df FROM tf GROUP BY term
), q AS (
    SELECT item_id, term, count(*) AS c FROM (SELECT item_id, unnest({_TERMS.format('text')}) AS term FROM benchmark) GROUP BY item_id, term
), w AS (
    SELECT item_id, term, c, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT) AS w FROM q JOIN df USING (term), tot
), s AS (
    SELECT item_id, doc_id, CAST(sum(c * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * n_docs) // n_terms)))) AS BIGINT) AS score
    FROM w JOIN tf USING (term) JOIN len USING (doc_id), tot GROUP BY item_id, doc_id
), r AS (
    SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM s WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 20
"""

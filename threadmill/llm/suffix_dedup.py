"""Removal of repeated byte strings by suffix sorting of shards.

Every byte covered by a string of LENGTH bytes that also starts anywhere else
goes. Strings are dealt to shards so that equal ones always meet: each string
belongs to its anchor, the leftmost smallest hash of the ANCHOR-byte strings
inside it, which depends on its bytes alone. Neighbouring strings with the same
anchor form a segment.

1. Anchors of all texts, with a hash of each segment, meet by anchor. Anchors
   that occur once are done. Segments that occur as a whole more than once are
   repeated throughout.
2. Segments of one anchor with different contents may share some of their
   strings: one copy of each goes to the shard of its anchor, and the shard is
   sorted by external induced sorting (`induced_suffixes`). Neighbours in
   suffix order that share LENGTH bytes are repeated.
3. Marked string starts come back per text, and each document drops what they
   cover.

Copies of a text are one text that occurs twice; documents take part with
their whole bytes, matches never cross documents, and strings are judged on
the input.

Defined results: a NULL or empty text has no bytes; a text shorter than LENGTH
is kept whole; repeated rows (and NULL ids) count as further occurrences; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadmill.llm.common import attach_groups, stage, table
from threadmill.llm.induced_suffixes import repeated_starts
from threadmill.llm.shingles import BYTE_VALUES, _powers, mix

LENGTH = 200
ANCHOR = 64
BATCH_BYTES = 1 << 18
#: Anchors that one task compares, anchors that a map task gathers before it hands them on.
BUCKET_ANCHORS = 500_000
FLUSH_ANCHORS = 500_000
#: Bytes of segments that one task sorts, unless one anchor has more.
SHARD_BYTES = 1 << 19

_ANCHOR = np.dtype([("anchor", "<u8"), ("segment", "<u8"), ("text", "<i8"), ("first", "<u4"), ("n", "<u2"), ("more", "<u1")])


def segments(texts: list[bytes], length: int = LENGTH, width: int = ANCHOR):
    """Anchor hash, segment hash, text number, first string start and number of
    string starts of every segment of some texts (at most a few MB together)."""
    sizes = np.array([len(t) for t in texts])
    data = np.frombuffer(b"".join(texts) + bytes(length), np.uint8)
    n = len(data)
    _powers.upto(n)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(BYTE_VALUES[data] * _powers.up[:n])])
    grams = mix((total[width:] - total[:-width]) * _powers.down[: n - width + 1])
    # hash above, place below: the smallest value is the leftmost smallest hash
    bits = np.uint64(int(n).bit_length())
    least = ((grams >> bits) << bits) | np.arange(len(grams), dtype=np.uint64)
    window, size = length - width + 1, 1
    while size * 2 <= window:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    least = np.minimum(least[: len(least) - (window - size)], least[window - size :])
    at = (least & np.uint64((1 << int(bits)) - 1)).astype(np.int64)
    # string starts inside their text
    ends = np.cumsum(sizes)
    starts = ends - sizes
    inside = np.zeros(n + 1, np.int32)
    fit = sizes >= length
    np.add.at(inside, starts[fit], 1)
    np.add.at(inside, ends[fit] - length + 1, -1)
    x = np.flatnonzero(np.cumsum(inside)[: len(at)] > 0)
    if not len(x):
        z = np.zeros(0, np.int64)
        return z.astype(np.uint64), z.astype(np.uint64), z, z, z
    number = np.searchsorted(ends, x, side="right")
    new = np.concatenate([[True], (at[x[1:]] != at[x[:-1]]) | (number[1:] != number[:-1])])
    first = np.flatnonzero(new)
    count = np.diff(np.concatenate([first, [len(x)]]))
    lo = x[first]
    whole = mix((total[lo + count - 1 + length] - total[lo]) * _powers.down[lo] + count.astype(np.uint64))
    return grams[at[lo]], whole, number[first], lo - starts[number[first]], count


def _texts(column) -> list[bytes]:
    return [(t or "").encode() for t in column.to_pylist()]


def _by_size(batches, column: int, size: int):
    for b in batches:
        at, c = 0, b.column(column)
        while at < b.num_rows:
            to, held = at, 0
            while to < b.num_rows and (to == at or held < size):
                held += len(c[to].as_py() or "")
                to += 1
            yield b.slice(at, to - at)
            at = to


def _anchors(texts: DataFrame, buckets: int, length: int, width: int) -> DataFrame:
    """(bucket, anchors): packed anchors of all texts (key, _text), dealt by anchor."""

    def run(batches):
        import pyarrow as pa

        def flush(parts):
            rows = np.concatenate(parts)
            # a text seen again in this task adds to its first occurrence
            order = np.lexsort((rows["first"], rows["text"], rows["anchor"]))
            rows = rows[order]
            same = np.concatenate([[False], (rows["anchor"][1:] == rows["anchor"][:-1]) & (rows["text"][1:] == rows["text"][:-1])
                                   & (rows["first"][1:] == rows["first"][:-1])])
            again = np.flatnonzero(same)
            head = np.maximum.accumulate(np.where(same, 0, np.arange(len(rows))))
            rows["more"][head[again]] = 1
            rows = rows[~same]
            at = ((rows["anchor"] >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(at, kind="stable")
            rows, at = rows[order], at[order]
            cut = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1], [True]]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(at[cut[:-1]], pa.int32()), pa.array([rows[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:])], pa.binary())],
                names=["bucket", "anchors"])

        parts, held = [], 0
        for b in _by_size(batches, 1, BATCH_BYTES):
            keys = b.column(0).to_numpy()
            anchor, whole, number, first, count = segments(_texts(b.column(1)), length, width)
            rows = np.zeros(len(anchor), _ANCHOR)
            rows["anchor"], rows["segment"], rows["text"], rows["first"], rows["n"] = anchor, whole, keys[number], first, count
            parts.append(rows)
            held += len(rows)
            if held >= FLUSH_ANCHORS:
                yield from flush(parts)
                parts, held = [], 0
        if held:
            yield from flush(parts)

    return texts.select("key", "_text").mapInArrow(run, "bucket int, anchors binary")


def _met(bucket):
    """What is known of a bucket's segments once its anchors meet: kind 0 - repeated
    as a whole; kind 1 - to be sorted with the others of its anchor (one copy of each content)."""
    import pandas as pd

    rows = np.concatenate([np.frombuffer(x, _ANCHOR) for x in bucket["anchors"]])
    rows = rows[np.lexsort((rows["first"], rows["text"], rows["segment"], rows["anchor"]))]
    new_anchor = np.concatenate([[True], rows["anchor"][1:] != rows["anchor"][:-1]])
    new_content = new_anchor | np.concatenate([[True], rows["segment"][1:] != rows["segment"][:-1]])
    content = np.cumsum(new_content) - 1
    group = np.cumsum(new_anchor) - 1
    occurs = np.bincount(content, weights=1 + rows["more"])
    contents = np.bincount(group[new_content])
    whole = occurs[content] > 1
    sort = new_content & (contents[group] > 1)
    out = []
    for kind, pick in ((0, whole), (1, sort)):
        r = rows[pick]
        out.append(pd.DataFrame({
            "kind": np.full(len(r), kind, np.int32), "key": r["text"], "first": r["first"].astype(np.int64), "n": r["n"].astype(np.int32),
            "anchor": r["anchor"].view(np.int64)}))
    return pd.concat(out)


def _sorted_shard(length: int):
    def run(shard):
        import pandas as pd

        shard = shard.drop_duplicates(["anchor", "key", "first"])
        data = np.frombuffer(b"".join(shard["content"]), np.uint8)
        size = shard["content"].map(len).to_numpy()
        start = np.cumsum(size) - size
        wanted = np.zeros(len(data) + 1, np.int32)
        np.add.at(wanted, start, 1)
        np.add.at(wanted, start + size - length + 1, -1)
        repeated = repeated_starts(data, np.cumsum(wanted)[:-1] > 0, length)
        # runs of repeated starts of each segment
        x = np.flatnonzero(repeated)
        number = np.searchsorted(start, x, side="right") - 1
        new = np.concatenate([[True], (x[1:] != x[:-1] + 1) | (number[1:] != number[:-1])]) if len(x) else np.zeros(0, bool)
        first = np.flatnonzero(new)
        count = np.diff(np.concatenate([first, [len(x)]])) if len(x) else np.zeros(0, np.int64)
        seg = number[first]
        return pd.DataFrame({"key": shard["key"].to_numpy()[seg], "first": shard["first"].to_numpy()[seg] + x[first] - start[seg], "n": count.astype(np.int32)})

    return run


def repeated(texts: DataFrame, length: int = LENGTH, width: int = ANCHOR) -> DataFrame:
    """(key, first, n): runs of string starts that are repeated, for texts (key, _text, n_bytes).

    Rows with the same key are the same text."""
    total = texts.where(F.col("n_bytes") >= length).agg(F.sum("n_bytes")).first()[0] or 0
    buckets = max(1, -(-total * 2 // ((length - width + 2) * BUCKET_ANCHORS)))
    met = stage(
        _anchors(texts, buckets, length, width).groupBy("bucket").applyInPandas(_met, "kind int, key bigint, first bigint, n int, anchor bigint"),
        "repeats-met")
    whole = met.where("kind = 0").select("key", "first", "n")
    sort = met.where("kind = 1").select("key", "first", "n", "anchor")
    held = sort.agg(F.sum(F.col("n") + (length - 1))).first()[0] or 0
    if not held:
        return whole
    shards = -(-held // SHARD_BYTES)
    # the contents: one copy of each text, cut at the segments that it lends
    lent = sort.groupBy("key").agg(F.collect_list(F.struct("first", "n", "anchor")).alias("lent"))  # bounded by the text
    copies = texts.where(F.col("n_bytes") >= length).groupBy("key").agg(F.first("_text").alias("_text"))

    def cut(batches):
        import pyarrow as pa

        for b in _by_size(batches, 1, BATCH_BYTES):
            keys, contents, firsts, anchors = [], [], [], []
            for k, t, parts in zip(b.column(0).to_pylist(), _texts(b.column(1)), b.column(2).to_pylist()):
                for p in parts:
                    keys.append(k)
                    firsts.append(p["first"])
                    anchors.append(p["anchor"])
                    contents.append(t[p["first"] : p["first"] + p["n"] + length - 1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(firsts, pa.int64()), pa.array(anchors, pa.int64()), pa.array(contents, pa.binary())],
                names=["key", "first", "anchor", "content"])

    contents = copies.join(lent, "key").select("key", "_text", "lent").mapInArrow(cut, "key bigint, first bigint, anchor bigint, content binary")
    found = contents.withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards))).groupBy("shard").applyInPandas(
        _sorted_shard(length), "key bigint, first bigint, n int")
    return whole.unionByName(stage(found, "repeats-found"))


def dedup(docs: DataFrame, length: int = LENGTH, width: int = ANCHOR, text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept (the bytes that stay)."""
    plain = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select("doc_id", plain.alias("_text"), F.xxhash64(plain).alias("key"), F.octet_length(plain).cast("bigint").alias("n_bytes"))
    marks = repeated(rows, length, width)
    per_text = marks.groupBy("key").agg(F.collect_list(F.struct("first", "n")).alias("marks"))  # bounded by the text
    known = rows.groupBy("key").agg(F.count(F.lit(1)).alias("copies"))
    groups = stage(known.join(per_text, "key", "left"), "repeats-marks")
    joined = attach_groups(rows, groups, "key", "copies", docs.count()).select("doc_id", "_text", "marks")

    def run(batches):
        import pyarrow as pa

        for b in _by_size(batches, 1, BATCH_BYTES):
            sizes, removed, spans, kept = [], [], [], []
            marks = b.column(2)
            for i, t in enumerate(_texts(b.column(1))):
                data = np.frombuffer(t, np.uint8)
                cover = np.zeros(len(data) + 1, np.int32)
                own = marks[i].values
                if own is not None and len(own):
                    first, n = (own.field(k).to_numpy() for k in (0, 1))
                    np.add.at(cover, first, 1)
                    np.add.at(cover, first + n + length - 1, -1)
                gone = np.cumsum(cover)[:-1] > 0
                sizes.append(len(data))
                removed.append(int(gone.sum()))
                spans.append(int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum()))
                kept.append(data[~gone].tobytes())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept, pa.binary())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return joined.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")


def op5(spark, sf_dir) -> DataFrame:
    return dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))

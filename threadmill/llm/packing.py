"""Best-fit-decreasing packing of tokenised documents into fixed-length sequences.

Only a document longer than a sequence is cut, into full pieces with the
shorter remainder first. Pieces of one length are alike, so the packing is
planned on the histogram of lengths (at most `capacity` counts, whatever the
input): lengths in decreasing order, each placed in the tightest open bin that
a segment tree over remaining capacities finds. The plan - runs of bins, a few
thousand rows, bounded by the capacity alone - is joined to the pieces, which
are numbered within their length by distributed ranks. The result is the
packing that best-fit decreasing gives piece by piece.

Defined results: a NULL or empty text is the end token alone; repeated rows are
packed each; an empty table gives no rows; columns to carry along are named,
others are ignored.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadmill.llm.byte_bpe import _sliced, byte_chars, codec, read_vocabulary
from threadmill.llm.common import numbered, stage, table, with_row_id, worker_state

CAPACITY = 1024
END_ID = 2


#: Runs of white space from this length on are left to the other library, whose matcher has no limit.
LONG_BLANK = 50_000


def encoder(vocabulary: bytes, pattern: str):
    """Text to packed ids, in this worker.

    A tokenizers file whose merges are in the order of their tokens' ids is
    byte-pair encoding by ranks, which the rank library does at three times
    the speed; any other vocabulary goes to `byte_bpe.Codec`. A text that spells
    one of the file's added tokens goes to the file's own tokenizer, which takes
    them as tokens.
    """
    kept = worker_state("bpe")
    added = [t["content"] for t in json.loads(vocabulary).get("added_tokens", [])] if vocabulary.lstrip()[:1] == b"{" else []
    plain = _plain_encoder(kept, vocabulary, pattern)

    def encode(text: str) -> bytes:
        if not any(t in text for t in added):
            return plain(text)
        if ("file", len(vocabulary)) not in kept:
            from tokenizers import Tokenizer

            kept["file", len(vocabulary)] = Tokenizer.from_str(vocabulary.decode())
        return array("I", kept["file", len(vocabulary)].encode(text, add_special_tokens=False).ids).tobytes()

    return encode


def _plain_encoder(kept: dict, vocabulary: bytes, pattern: str):
    """Encoding of texts without added tokens."""
    key = ("ranks", len(vocabulary), zlib.crc32(vocabulary), pattern)
    if key not in kept:
        kept[key] = _rank_encoding(vocabulary, pattern)
    ranks = kept[key]
    if ranks is None:
        return codec(vocabulary, pattern).encode
    blank = re.compile(rf"\s{{{LONG_BLANK}}}")

    def encode(text: str) -> bytes:
        if len(text) >= LONG_BLANK and blank.search(text):
            return codec(vocabulary, pattern).encode(text)
        return array("I", ranks.encode_ordinary(text)).tobytes()

    return encode


def _rank_encoding(vocabulary: bytes, pattern: str):
    if vocabulary.lstrip()[:1] != b"{":
        return None
    model = json.loads(vocabulary)["model"]
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    order = [model["vocab"].get(a + b) for a, b in merges]
    if None in order or order != sorted(order):
        return None
    import tiktoken

    back = {c: b for b, c in enumerate(byte_chars())}
    merged = set(order)
    ranks = {bytes(back[c] for c in t): i for t, i in model["vocab"].items() if all(c in back for c in t) and (len(t) == 1 or i in merged)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def cut(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of n ids."""
    first = n % capacity
    out = [(0, first)] if first else []
    return out + [(s, capacity) for s in range(first, n, capacity)]


def pieces(
    docs: DataFrame, vocabulary: bytes, pattern: str, capacity: int = CAPACITY, end_id: int = END_ID,
    text: str = "text", carry: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """Documents as pieces: the `carry` columns, piece, start, length, ids (packed as in `byte_bpe`)."""
    kept = docs.select(*carry, F.col(text).alias("_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1])

    def run(batches):
        import pyarrow as pa

        encode = encoder(vocabulary, pattern)
        end = end_id.to_bytes(4, "little")
        for b in _sliced(batches):
            row, number, start, length, ids = [], [], [], [], []
            for k, t in enumerate(b.column(b.num_columns - 1).to_pylist()):
                packed = encode(t or "") + end
                for i, (s, n) in enumerate(cut(len(packed) // 4, capacity)):
                    row.append(k)
                    number.append(i)
                    start.append(s)
                    length.append(n)
                    ids.append(packed[4 * s : 4 * (s + n)])
            at = pa.array(row, pa.int64())
            cols = [b.column(i).take(at) for i in range(b.num_columns - 1)]
            cols += [pa.array(number, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(ids, pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, names=[*b.schema.names[:-1], "piece", "start", "length", "ids"])

    return kept.mapInArrow(run, schema + ", piece int, start bigint, length bigint, ids binary")


class CapacityTree:
    """Segment tree over remaining capacities: how many open bins have each."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.open = [0] * (2 * self.leaves)

    def add(self, capacity: int, bins: int) -> None:
        at = self.leaves + capacity
        while at:
            self.open[at] += bins
            at >>= 1

    def tightest(self, least: int) -> int | None:
        """The smallest remaining capacity of an open bin that is at least `least`."""
        at = self.leaves + least
        if self.open[at]:
            return least
        while at > 1:  # up to the first subtree on the right with an open bin, then down its left edge
            if at % 2 == 0 and self.open[at + 1]:
                at += 1
                while at < self.leaves:
                    at = 2 * at if self.open[2 * at] else 2 * at + 1
                return at - self.leaves
            at >>= 1
        return None


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over a histogram of lengths.

    Rows (length, first, last, per_bin, bin, offset): the pieces of that length
    ranked first..last-1 go per_bin to a bin, from `bin` on, from `offset` in each.
    """
    tree = CapacityTree(capacity)
    runs: dict[int, list[tuple[int, int]]] = {}  # remaining capacity -> (first bin, bins)
    out, bins = [], 0

    def leave(first: int, n: int, remaining: int) -> None:
        if n and remaining:
            runs.setdefault(remaining, []).append((first, n))
            tree.add(remaining, n)

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            room = tree.tightest(length)
            if room is None:  # all that are left open new bins, a run of them
                room, first, n = capacity, bins, -(-left // (capacity // length))
                bins += n
            else:
                first, n = runs[room].pop()
                tree.add(room, -n)
            # like pieces go on filling the tightest bin, which is the one just used
            each = room // length
            full = min(n, left // each)
            if full:
                out.append((length, rank, rank + full * each, each, first, capacity - room))
                leave(first, full, room - each * length)
                rank, left = rank + full * each, left - full * each
            if full < n and left:
                out.append((length, rank, rank + left, left, first + full, capacity - room))
                leave(first + full, 1, room - left * length)
                leave(first + full + 1, n - full - 1, room)
                left = 0
            else:
                leave(first + full, n - full, room)
    return out


def pack(rows: DataFrame, order: list[str], capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to pieces (column `length`, at most `capacity`);
    `order` names columns that tell pieces apart."""
    counts = {r["length"]: r["n"] for r in rows.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most `capacity` rows
    schema = "length bigint, first bigint, last bigint, per_bin bigint, bin bigint, bin_offset bigint"
    placed = rows.sparkSession.createDataFrame(plan(counts, capacity), schema)
    ranked = numbered(rows, "length", counts, order, "_rank")
    inside = F.col("_rank") - F.col("first")
    return (
        ranked.join(F.broadcast(placed), (ranked["length"] == placed["length"]) & (F.col("_rank") >= F.col("first")) & (F.col("_rank") < F.col("last")))
        .withColumn("sequence_id", F.col("bin") + F.floor(inside / F.col("per_bin")))
        .withColumn("offset", F.col("bin_offset") + inside % F.col("per_bin") * ranked["length"])
        .select(*[ranked[c] for c in rows.columns], "sequence_id", "offset")
    )


def op8_rows(docs: DataFrame) -> DataFrame:
    import public_tokenizers

    cut_docs = pieces(docs, read_vocabulary(public_tokenizers.path("byte_bpe_50k.json")), public_tokenizers.PATTERN)
    rows = stage(cut_docs.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")), "pieces")
    return pack(with_row_id(rows, "row_id"), ["doc_id", "piece", "ids_crc32", "row_id"]).drop("row_id")


def op8(spark, sf_dir) -> DataFrame:
    return op8_rows(table(spark, sf_dir, "documents"))

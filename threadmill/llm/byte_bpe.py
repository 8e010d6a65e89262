"""Byte-level BPE: encoding with the tokenizers library over Arrow batches, decoding, offsets.

Every match of the split pattern is encoded by itself. Bytes become characters
by the byte table of byte-level BPE (printable Latin-1 bytes stand for
themselves, the others for code points from 256 on), which is what the
library's model works on; decoding reverses the table and joins bytes, so a
character split over several tokens comes out whole. A rank file (base64
token, rank) is turned into merges: all splits of a token into two tokens,
ordered by the token's rank; a match that is a token itself is that token.

Words repeat: each worker keeps the ids of the matches it has seen (at most
CACHE of them; a full cache is emptied, which changes no result).

Ids travel packed, as little-endian unsigned 32-bit integers in one binary
cell (`unpack` gives an array column).

Defined results: NULL text is empty; an empty text has no ids, an empty
decoding and no offsets; ids outside the vocabulary decode to U+FFFD;
repeated rows give repeated rows, an empty table none; columns to carry along
are named, others are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadmill.llm.common import table, worker_state

CACHE = 400_000
CACHED_CHARS = 64
#: Rows handled at a time inside a worker; long texts are cut at pattern matches.
SLICE_ROWS = 64
MATCHES_AT_ONCE = 500_000


def byte_chars() -> list[str]:
    """The character that stands for each byte."""
    plain = set(range(0x21, 0x7F)) | set(range(0xA1, 0xAD)) | set(range(0xAE, 0x100))
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


def read_ranks(data: bytes) -> dict[bytes, int]:
    """A rank file: one base64 token and its rank per line."""
    import base64

    return {base64.b64decode(t): int(r) for t, r in (line.split() for line in data.splitlines() if line)}


def _model_of_ranks(ranks: dict[bytes, int]):
    """The library's BPE model with the merges that the ranks imply."""
    from tokenizers.models import BPE

    chars = byte_chars()
    text = {t: "".join(map(chars.__getitem__, t)) for t in ranks}
    merges = []
    for token in sorted(ranks, key=ranks.get):
        cuts = [(token[:i], token[i:]) for i in range(1, len(token))]
        halves = [c for c in cuts if c[0] in ranks and c[1] in ranks]
        merges += [(text[a], text[b]) for a, b in sorted(halves, key=lambda c: (ranks[c[0]], ranks[c[1]]))]
    return BPE(vocab={text[t]: r for t, r in ranks.items()}, merges=merges, ignore_merges=True)


class Codec:
    """Encoder and decoder of one vocabulary, living in a worker."""

    def __init__(self, vocabulary: bytes, pattern: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers import Tokenizer, pre_tokenizers

        if vocabulary.lstrip()[:1] == b"{":
            self.tokenizer = Tokenizer.from_str(vocabulary.decode())
        else:
            self.tokenizer = Tokenizer(_model_of_ranks(read_ranks(vocabulary)))
        self.tokenizer.encode_special_tokens = True
        self.tokenizer.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.pattern = regex.compile(pattern)
        self.seen: dict[str, bytes] = {}
        back = {c: b for b, c in enumerate(byte_chars())}
        vocab = self.tokenizer.get_vocab(with_added_tokens=False)
        self.bytes = ["�".encode()] * (max(vocab.values(), default=-1) + 1)
        for t, i in vocab.items():
            # a special token of the vocabulary file is not spelled in byte characters
            self.bytes[i] = bytes(back[c] for c in t) if all(c in back for c in t) else t.encode()

    def _packed(self, matches: list[str]) -> bytes:
        from array import array

        seen = self.seen
        new = list({m for m in matches if m not in seen})
        if new:
            if len(seen) > CACHE:
                seen.clear()
                new = list(set(matches))
            ids = (array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(new, add_special_tokens=False))
            fresh = dict(zip(new, ids))
            seen.update((m, i) for m, i in fresh.items() if len(m) <= CACHED_CHARS)
            get = lambda m: seen[m] if m in seen else fresh[m]
            return b"".join(map(get, matches))
        return b"".join(map(seen.__getitem__, matches))

    def encode(self, text: str) -> bytes:
        """Packed ids of one text."""
        if len(text) <= MATCHES_AT_ONCE:
            return self._packed(self.pattern.findall(text))
        from itertools import batched

        found = (m.group() for m in self.pattern.finditer(text))
        return b"".join(self._packed(list(part)) for part in batched(found, MATCHES_AT_ONCE))

    def decode(self, packed: bytes) -> bytes:
        from array import array

        ids = array("I", packed)
        try:
            return b"".join(map(self.bytes.__getitem__, ids))
        except IndexError:
            unknown = "�".encode()
            return b"".join(self.bytes[i] if i < len(self.bytes) else unknown for i in ids)

    def offsets(self, packed: bytes) -> tuple[list[int], list[int]]:
        """For each id the first character its bytes touch and the one after the
        last, in code points of the decoded text: a token that holds part of a
        character covers all of it."""
        import numpy as np

        ids = np.frombuffer(packed, "<u4").tolist()
        lengths = np.array([len(self.bytes[i]) if i < len(self.bytes) else 3 for i in ids], dtype=np.int64)
        data = np.frombuffer(self.decode(packed), np.uint8)
        char = np.cumsum((data & 0xC0) != 0x80) - 1
        ends = np.cumsum(lengths)
        return char[ends - lengths].tolist(), (char[ends - 1] + 1).tolist()

    def pieces(self, packed: bytes) -> list[str]:
        """The text that each id completes: a character split over tokens comes with its last one."""
        from array import array
        from codecs import getincrementaldecoder

        decoder = getincrementaldecoder("utf-8")("replace")
        ids = array("I", packed)
        return [decoder.decode(self.bytes[i] if i < len(self.bytes) else b"\xef\xbf\xbd", final=n == len(ids) - 1) for n, i in enumerate(ids)]


def codec(vocabulary: bytes, pattern: str) -> Codec:
    """The worker's codec of this vocabulary."""
    import zlib

    kept = worker_state("bpe")
    key = ("codec", zlib.crc32(vocabulary), len(vocabulary), pattern)
    if key not in kept:
        kept[key] = Codec(vocabulary, pattern)
    return kept[key]


def read_vocabulary(path: str) -> bytes:
    """A vocabulary file (a few MB), read on the driver and sent with the tasks."""
    with open(path, "rb") as f:
        return f.read()


def _sliced(batches: Iterable, rows: int = SLICE_ROWS) -> Iterator:
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)


def encode(
    docs: DataFrame, vocabulary: bytes, pattern: str, text: str = "text", carry: tuple[str, ...] = ("doc_id",), offsets: bool = False,
) -> DataFrame:
    """The `carry` columns and `ids` (packed); with `offsets` also `starts` and
    `ends`, the code points that each token covers."""
    kept = docs.select(*carry, F.col(text).alias("_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1])
    extra = ", ids binary" + (", starts array<int>, ends array<int>" if offsets else "")

    def run(batches):
        import pyarrow as pa

        c = codec(vocabulary, pattern)
        for b in _sliced(batches):
            ids = [c.encode(t or "") for t in b.column(b.num_columns - 1).to_pylist()]
            cols = [b.column(i) for i in range(b.num_columns - 1)] + [pa.array(ids, pa.binary())]
            names = b.schema.names[:-1] + ["ids"]
            if offsets:
                spans = [c.offsets(x) for x in ids]
                cols += [pa.array([s[k] for s in spans], pa.list_(pa.int32())) for k in (0, 1)]
                names += ["starts", "ends"]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return kept.mapInArrow(run, schema + extra)


def decode(encoded: DataFrame, vocabulary: bytes, pattern: str, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The `carry` columns and `decoded` (the bytes that the packed `ids` stand for)."""
    kept = encoded.select(*carry, "ids")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1])

    def run(batches):
        import pyarrow as pa

        c = codec(vocabulary, pattern)
        for b in _sliced(batches):
            texts = [c.decode(x or b"") for x in b.column(b.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(i) for i in range(b.num_columns - 1)] + [pa.array(texts, pa.binary())], names=b.schema.names[:-1] + ["decoded"])

    return kept.mapInArrow(run, schema + ", decoded binary")


def unpack(packed: Column) -> Column:
    """Packed ids as an array of bigint."""
    h = F.hex(packed)
    at = lambda i, k: F.substring(h, i * 8 + 1 + 2 * k, F.lit(2))
    n = F.floor(F.octet_length(packed) / 4).cast("int")
    return F.when(n > 0, F.transform(
        F.sequence(F.lit(0), n - 1), lambda i: F.conv(F.concat(*[at(i, k) for k in (3, 2, 1, 0)]), 16, 10).cast("bigint"))).otherwise(F.array().cast("array<bigint>"))


def op2(spark, sf_dir) -> DataFrame:
    import public_tokenizers

    vocabulary = read_vocabulary(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    coded = encode(table(spark, sf_dir, "documents"), vocabulary, public_tokenizers.PATTERN)
    digests = coded.withColumns({"n_tokens": F.floor(F.octet_length("ids") / 4).cast("bigint"), "ids_sha256": F.sha2("ids", 256)})
    back = decode(digests, vocabulary, public_tokenizers.PATTERN, carry=("doc_id", "n_tokens", "ids_sha256"))
    return back.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))

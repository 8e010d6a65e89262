"""Encoding against tiktoken, decoding as an exact round trip, offsets by brute force."""

import array
import base64
import hashlib

import pytest

P = pytest.importorskip("public_tokenizers")

from threadmill.llm import byte_bpe as B  # noqa: E402
from tests.llm.cases import documents, odd_documents  # noqa: E402

RANKS = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def packed(ids):
    return array.array("I", ids).tobytes()


def test_query_equals_the_rank_library_on_every_document(spark, reference):
    rows = {r.doc_id: r for r in B.op2(spark, "/root/testdata/sf0.01").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()
    assert len(rows) == len(docs)
    for d in docs:
        ids = reference.encode_ordinary(d.text or "")
        r = rows[d.doc_id]
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(packed(ids)).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256((d.text or "").encode()).hexdigest()


def test_random_unicode_and_runs(reference):
    import random

    rng = random.Random(5)
    c = B.Codec(B.read_vocabulary(RANKS), P.PATTERN)
    alphabets = ["ab ", "aaa \n\t", "éüñ中文🤦🏼‍♂️‍   ", "0129.,'sSdD ", "กำ́\u0085　 x", "<|endoftext|>"]
    texts = ["".join(rng.choice(a) for _ in range(rng.randint(0, 60))) for a in alphabets for _ in range(300)]
    texts += ["a" * 3000, " " * 1001 + "x", "\n" * 77, "'s't're've'm'll'd", "ab" * 900, "<|endoftext|>", "\x00\x01", "ﬀⅣ²½"]
    for t in texts:
        ids = reference.encode_ordinary(t)
        assert c.encode(t) == packed(ids), t
        assert c.decode(packed(ids)) == t.encode()
        assert "".join(c.pieces(packed(ids))) == t
        starts, ends = c.offsets(packed(ids))
        at = 0
        for i, s, e in zip(ids, starts, ends):
            n = len(reference.decode_single_token_bytes(i))
            assert s == len(t.encode()[: at + 1].decode(errors="ignore")) - (len(t.encode()[: at + 1].decode(errors="ignore").encode()) == at + 1)
            assert t[s:e].encode().find(t.encode()[at : at + n]) >= 0
            at += n


def test_pattern_matches_every_code_point_like_the_rank_library(reference):
    c = B.Codec(B.read_vocabulary(RANKS), P.PATTERN)
    points = [chr(p) for p in range(0x110000) if not 0xD800 <= p < 0xE000]
    for i in range(0, len(points), 40000):
        t = " a1".join(points[i : i + 40000])
        assert c.encode(t) == packed(reference.encode_ordinary(t)), i


def test_long_text_in_parts_and_full_cache(reference, monkeypatch):
    monkeypatch.setattr(B, "MATCHES_AT_ONCE", 50)
    monkeypatch.setattr(B, "CACHE", 20)
    c = B.Codec(B.read_vocabulary(RANKS), P.PATTERN)
    t = " ".join(f"word{i} and  more\n" for i in range(400))
    assert c.encode(t) == packed(reference.encode_ordinary(t))


def test_defined_results(spark):
    v = B.read_vocabulary(RANKS)
    out = B.encode(odd_documents(spark), v, P.PATTERN, offsets=True)
    rows = out.select("*", B.unpack(out["ids"]).alias("array")).collect()
    assert len(rows) == odd_documents(spark).count()
    for r in rows:
        assert list(array.array("I", bytes(r.ids))) == r.array and len(r.starts) == len(r.ends) == len(r.array)
    back = B.decode(out, v, P.PATTERN)
    want = sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in odd_documents(spark).collect())
    assert sorted((r.doc_id is None, r.doc_id or 0, bytes(r.decoded).decode()) for r in back.collect()) == want
    assert B.encode(documents(spark, []), v, P.PATTERN).count() == 0


def test_unknown_ids_decode_to_the_replacement_character():
    c = B.Codec(B.read_vocabulary(RANKS), P.PATTERN)
    assert c.decode(packed([4_000_000])) == "�".encode()
    assert c.offsets(packed([4_000_000, 4_000_000])) == ([0, 1], [1, 2])

"""The planned packing against best-fit decreasing piece by piece."""

import random
import zlib
from collections import Counter

import pytest

P = pytest.importorskip("public_tokenizers")

from threadmill.llm import packing  # noqa: E402
from tests.llm.cases import documents, odd_documents  # noqa: E402


def brute_bins(lengths, capacity):
    """Best fit decreasing, one piece at a time over a list of bins."""
    bins = []
    for n in sorted(lengths, reverse=True):
        fit = [i for i, room in enumerate(bins) if room >= n]
        if fit:
            bins[min(fit, key=lambda i: bins[i])] -= n
        else:
            bins.append(capacity - n)
    return Counter(bins)


@pytest.mark.parametrize("seed", range(40))
def test_plan_equals_piecewise_best_fit(seed):
    rng = random.Random(seed)
    capacity = rng.choice([7, 16, 100, 1024])
    lengths = [rng.choice([rng.randint(1, capacity), rng.randint(1, max(1, capacity // 5)), 3]) for _ in range(rng.randint(0, 300))]
    lengths = [min(n, capacity) for n in lengths]
    used, seen = {}, Counter()
    for length, first, last, per_bin, bin_, offset in packing.plan(dict(Counter(lengths)), capacity):
        assert seen[length] == first
        seen[length] = last
        for r in range(first, last):
            b, o = bin_ + (r - first) // per_bin, offset + (r - first) % per_bin * length
            assert used.get(b, 0) == o  # gapless
            used[b] = o + length
    assert seen == Counter(lengths)
    assert Counter(capacity - u for u in used.values()) == brute_bins(lengths, capacity)


def test_tightest_against_a_scan():
    rng = random.Random(1)
    tree, have = packing.CapacityTree(1024), Counter()
    for _ in range(2000):
        c = rng.randint(0, 1024)
        tree.add(c, 1)
        have[c] += 1
        least = rng.randint(0, 1024)
        assert tree.tightest(least) == min((k for k in have if k >= least), default=None)


def check(docs, out):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    want = Counter()
    for d in docs:
        ids = t.encode(d.text or "", add_special_tokens=False).ids + [2]
        first = len(ids) % 1024
        starts = ([0] if first or len(ids) < 1024 else []) + list(range(first, len(ids), 1024))
        for i, (s, e) in enumerate(zip(starts, starts[1:] + [len(ids)])):
            want[(d.doc_id, i, s, e - s, zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids[s:e])))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out) == want
    bins = {}
    for r in out:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for b in bins.values():
        at = 0
        for o, n in sorted(b):
            assert o == at
            at += n
        assert at <= 1024
    assert Counter(1024 - sum(n for _, n in b) for b in bins.values()) == brute_bins([r.length for r in out], 1024)


def test_query(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    check(docs, packing.op8(spark, "/root/testdata/sf0.001").collect())


def test_defined_results(spark):
    docs = odd_documents(spark)
    check(docs.collect(), packing.op8_rows(docs).collect())
    assert packing.op8_rows(documents(spark, [])).count() == 0


def test_hot_length_is_numbered_in_buckets(spark, monkeypatch):
    from threadmill.llm import common

    monkeypatch.setattr(common, "NUMBER_ROWS", 10)
    rows = spark.range(500).selectExpr("id", "if(id % 5 = 0, id % 13 + 1, 7) as length")
    out = packing.pack(rows, ["id"], capacity=20).collect()
    assert len({(r.sequence_id, r.offset) for r in out}) == 500
    assert Counter(20 - s for s in Counter([x for r in out for x in [r.sequence_id] * r.length]).values()) == brute_bins([r.length for r in out], 20)


def test_both_libraries_give_the_same_ids():
    from threadmill.llm.byte_bpe import Codec, read_vocabulary

    v = read_vocabulary(P.path("byte_bpe_50k.json"))
    fast, other = packing.encoder(v, P.PATTERN), Codec(v, P.PATTERN)
    rng = random.Random(9)
    alphabets = ["abcdefgh ", "aaab \n\t", "éüñ中文🤦🏼‍♂️   ", "0129.,'sSdD ", "the on and ing er re ", "<|endoftext|>", "=-_#*/\\ "]
    texts = ["".join(rng.choice(a) for _ in range(rng.randint(0, 90))) for a in alphabets for _ in range(400)]
    texts += [" " * 60000 + "x", "a" * 5000, "ing" * 700, "<|endoftext|>"]
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(P.path("byte_bpe_50k.json"))  # takes the added token as one
    packed = lambda t: b"".join(i.to_bytes(4, "little") for i in whole.encode(t, add_special_tokens=False).ids)
    for t in texts:
        assert fast(t) == (packed(t) if "<|endoftext|>" in t else other.encode(t)), t


def test_added_tokens_are_tokens(spark):
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>y é", "<|endof text|>", "plain", None]
    df = documents(spark, list(enumerate(texts)))
    check(df.collect(), packing.op8_rows(df).collect())


def test_many_identical_rows(spark):
    df = documents(spark, [(None, "same text")] * 12000 + [(i, "word " * (i % 9)) for i in range(300)])
    rows = packing.op8_rows(df).collect()
    check(df.collect(), rows)
    assert len(rows) == 12300

"""Removed bytes against a table of all strings; the induced sort against plain sorting."""

import hashlib
import random

import numpy as np
import pytest

from threadmill.llm import induced_suffixes as I
from threadmill.llm import suffix_dedup as D
from tests.llm.cases import documents, odd_documents


def brute(rows, length):
    texts = [(d, (t or "").encode()) for d, t in rows]
    seen = {}
    for _, b in texts:
        for i in range(len(b) - length + 1):
            s = hash(b[i : i + length])
            seen[s] = seen.get(s, 0) + 1
    out = []
    for d, b in texts:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[hash(b[i : i + length])] > 1:
                gone[i : i + length] = b"\x01" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((d, len(b), sum(gone), spans, kept))
    return sorted(out, key=repr)


def result(df, *options):
    return sorted((tuple(r[:4]) + (bytes(r.kept),) for r in D.dedup(df, *options).collect()), key=repr)


def passages(rng, n=60):
    """Texts that share, repeat and overlap passages, with small changes."""
    words = ["ab", "c", "dd ", "e e", "é", "中", "xyzzy ", "\n"]
    make = lambda k: "".join(rng.choice(words) for _ in range(k))
    shared = [make(rng.randint(5, 60)) for _ in range(8)]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(rng.randint(0, 5)):
            p = rng.choice(shared) if rng.random() < 0.6 else make(rng.randint(1, 50))
            a = rng.randint(0, 5)
            parts.append(p[a : len(p) - rng.randint(0, 5)])
        rows.append((i, "".join(parts)))
        if rows and rng.random() < 0.1:
            rows.append((i + 1000, rng.choice(rows)[1]))
    return rows + [(5000, "ab" * 400), (5001, "z" * 300), (5002, "z" * 41 + "q" + "z" * 39)]


@pytest.mark.parametrize("seed", range(4))
def test_random_passages(spark, seed, monkeypatch):
    if seed % 2:
        for name, value in (("BUCKET_ANCHORS", 50), ("FLUSH_ANCHORS", 20), ("SHARD_BYTES", 500), ("BATCH_BYTES", 300)):
            monkeypatch.setattr(D, name, value)
    rows = passages(random.Random(seed))
    assert result(documents(spark, rows), 40, 12) == brute(rows, 40)


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    got = sorted(map(tuple, D.op5(spark, "/root/testdata/sf0.001").collect()), key=repr)
    want = sorted(((*r[:4], hashlib.sha256(r[4]).hexdigest()) for r in brute(rows, 200)), key=repr)
    assert got == want and sum(r[2] for r in got) > 0


def test_defined_results(spark):
    odd = odd_documents(spark)
    assert result(odd, 16, 5) == brute([(r.doc_id, r.text) for r in odd.collect()], 16)
    assert result(documents(spark, [])) == []


def test_segments_hold_every_string_once_and_equal_strings_agree():
    rng = random.Random(7)
    texts = [t.encode() for _, t in passages(rng, 30)]
    anchor, _, number, first, count = D.segments(texts, 40, 12)
    seen, of = {}, {}
    for a, k, f, c in zip(anchor, number, first, count):
        for x in range(f, f + c):
            assert (k, x) not in seen
            seen[k, x] = a
            assert of.setdefault(texts[k][x : x + 40], a) == a
    assert set(seen) == {(k, x) for k, t in enumerate(texts) for x in range(len(t) - 39)}


def test_induced_sort(monkeypatch):
    rng = random.Random(3)
    for k in range(1500):
        if k == 1000:
            monkeypatch.setattr(I, "MEMORY_ITEMS", 5)  # everything in files
        n, a = rng.randint(0, 60), rng.choice([1, 2, 3, 6, 250])
        t = [rng.randint(1, a) for _ in range(n)] * rng.choice([1, 1, 3]) + [0]
        assert I.sorted_suffixes(np.array(t)).tolist() == sorted(range(len(t)), key=lambda i: t[i:])


def test_repeated_starts():
    rng = random.Random(8)
    for _ in range(200):
        data = bytes(rng.choice(b"ab") for _ in range(rng.randint(9, 80)))
        wanted = np.zeros(len(data), bool)
        wanted[: len(data) - 8] = True
        got = I.repeated_starts(np.frombuffer(data, np.uint8), wanted, 9)
        strings = [data[i : i + 9] for i in range(len(data) - 8)]
        assert got[: len(strings)].tolist() == [strings.count(s) > 1 for s in strings]

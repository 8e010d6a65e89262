"""Components against all pairs by brute force; the sketch and pigeonhole bounds on random sets."""

import random
import re

import numpy as np
import pytest

from threadmill.llm import block_links as B
from threadmill.llm import parity_join as J
from threadmill.llm import shingles as S
from tests.llm.cases import documents, odd_documents

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute_set(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4)) if len(words) >= 5 else frozenset([tuple(words)])


def brute(rows):
    """(doc_id, n_shingles, component_id) by inverted lists and union-find."""
    sets = [brute_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    where = {}
    for i, s in enumerate(sets):
        for x in s:
            where.setdefault(x, []).append(i)
    for i, s in enumerate(sets):
        common = {}
        for x in s:
            for j in where[x]:
                if j < i:
                    common[j] = common.get(j, 0) + 1
        for j, c in common.items():
            if 100 * c >= 75 * (len(s) + len(sets[j]) - c):
                parent[find(i)] = find(j)
    ids = {}
    for i, (d, _) in enumerate(rows):
        if sets[i]:
            ids.setdefault(find(i), []).append(d)
    out = []
    for i, (d, _) in enumerate(rows):
        known = [x for x in ids.get(find(i), []) if x is not None] if sets[i] else [d]
        out.append((d, len(sets[i]), min(known) if known and known[0] is not None else None))
    return sorted(out, key=repr)


def result(df):
    return sorted(map(tuple, J.components(df).collect()), key=repr)


def near_copies(rng, n_docs=160):
    vocabulary = [f"w{i}" for i in range(300)]
    rows, passage = [], [rng.choice(vocabulary) for _ in range(30)]
    for i in range(n_docs):
        if rows and rng.random() < 0.7:
            words = rng.choice(rows)[1].split()
            for _ in range(rng.randint(0, 3)):
                k = rng.randrange(len(words) + 1)
                words[k : k + rng.randint(0, 1)] = [rng.choice(vocabulary)] if rng.random() < 0.8 else []
        else:
            words = [rng.choice(vocabulary) for _ in range(rng.choice([1, 3, 5, 8, 20, 60, 150]))]
            if rng.random() < 0.4:
                words += passage
        rows.append((1000 - i, " ".join(words)))
    return rows


@pytest.mark.parametrize("seed", range(4))
def test_random_documents(spark, seed, monkeypatch):
    if seed % 2:  # small limits: several buckets, flushes and blocks, no star rounds to speak of
        monkeypatch.setattr(J, "BUCKET_KEYS", 500)
        monkeypatch.setattr(J, "FLUSH_KEYS", 100)
        monkeypatch.setattr(J, "STAR_ROUNDS", 1)
    rows = near_copies(random.Random(seed))
    assert result(documents(spark, rows)) == brute(rows)


def test_a_group_larger_than_a_block(spark, monkeypatch):
    monkeypatch.setattr(J, "STAR_ROUNDS", 0)
    monkeypatch.setattr(B, "BLOCK_ROWS", 7)
    rng = random.Random(11)
    rows = near_copies(rng, 80)
    assert result(documents(spark, rows)) == brute(rows)


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    got = sorted(map(tuple, J.op6(spark, "/root/testdata/sf0.01").collect()), key=repr)
    assert got == brute(rows)
    assert sum(d != c for d, _, c in got) > 20


def test_defined_results(spark):
    odd = odd_documents(spark)
    assert result(odd) == brute([(r.doc_id, r.text) for r in odd.collect()])
    assert result(documents(spark, [])) == []


def test_sets_equal_plain_shingles():
    rng = random.Random(4)
    texts = ["", " ", "One", "one TWO\tthree\x0bfour", "a b c d e", "É é Ä x\xa0y z q r s t", "a b c d e a b c d e a"] + [
        " ".join(rng.choice("abAB") for _ in range(rng.randint(0, 40))) for _ in range(300)]
    sets = S.shingle_sets([t.encode() for t in texts])
    seen = {}
    for t, s in zip(texts, sets):
        want = brute_set(t)
        assert len(s) == len(want) and (np.diff(s.astype(object)) > 0).all()
        for x in want:
            seen.setdefault(x, set()).add(tuple(S.shingle_sets([" ".join(x).encode()])[0].tolist()))
    assert len({tuple(v) for v in seen.values()}) == len(seen)


def test_similar_sets_share_a_key_and_pass_the_sketch():
    rng = np.random.default_rng(0)
    for _ in range(3000):
        n = int(rng.integers(1, rng.choice([4, 10, 60, 700])))
        common = rng.integers(0, 2**64, n, dtype=np.uint64)
        free = int(n / 3)  # at J = 0.75 a third of the common shingles may be others'
        x, y = (int(v) for v in rng.multinomial(int(rng.integers(0, free + 1)), [0.5, 0.5]))
        a = np.unique(np.concatenate([common, rng.integers(0, 2**64, x, dtype=np.uint64)]))
        b = np.unique(np.concatenate([common, rng.integers(0, 2**64, y, dtype=np.uint64)]))
        assert 4 * n >= 3 * (n + x + y)
        assert len(np.intersect1d(J.keys_of(a), J.keys_of(b)))
        sketches = [np.frombuffer(J.bit_sketch(x), np.uint64)[None] for x in (a, b)]
        x, y = (J.folded(k, min(k.shape[1] for k in sketches)) for k in sketches)
        assert J.near_enough(np.array([len(a)]), np.array([len(b)]), x, y).all()

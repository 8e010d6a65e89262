"""Components against all pairs by brute force; the blocks' products and forests on small sets."""

import random
import re

import numpy as np

from tests.conftest import SF_SMALL
from tests.llm.cases import documents, odd_documents
from threadmill.llm import block_links as B
from threadmill.llm import chosen_path as C

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute_set(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 3]) for i in range(len(words) - 2)) if len(words) >= 3 else frozenset([tuple(words)])


def brute(rows):
    """(doc_id, n_shingles, component_id, kept) by inverted lists and union-find."""
    sets = [brute_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    where = {}
    for i, s in enumerate(sets):
        common = {}
        for x in s:
            for j in where.setdefault(x, []):
                common[j] = common.get(j, 0) + 1
            where[x].append(i)
        for j, c in common.items():
            if 100 * c >= 85 * (len(s) + len(sets[j]) - c):
                parent[find(i)] = find(j)
    ids = {}
    for i, (d, _) in enumerate(rows):
        if sets[i]:
            ids.setdefault(find(i), []).append(d)
    out = []
    for i, (d, _) in enumerate(rows):
        known = [x for x in (ids[find(i)] if sets[i] else [d]) if x is not None]
        least = min(known, default=None)
        out.append((d, len(sets[i]), least, d == least))
    return sorted(out, key=repr)


def result(df):
    return sorted(map(tuple, C.components(df).collect()), key=repr)


def near_copies(rng, n_docs, edits):
    vocabulary = [f"w{i}" for i in range(300)]
    rows, passage = [], [rng.choice(vocabulary) for _ in range(40)]
    for i in range(n_docs):
        if rows and rng.random() < 0.8:
            words = rng.choice(rows)[1].split()
            for _ in range(rng.randint(0, edits)):
                k = rng.randrange(len(words) + 1)
                words[k : k + rng.randint(0, 1)] = [rng.choice(vocabulary)] if rng.random() < 0.8 else []
        else:
            words = [rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 5, 20, 60, 150]))]
            if rng.random() < 0.5:
                words += passage
        rows.append((1000 - i, " ".join(words)))
    return rows


def test_random_documents_and_a_chain(spark, monkeypatch):
    """Small limits: branching on several levels, groups of several blocks. The chain is a
    large group that links only from neighbour to neighbour."""
    monkeypatch.setattr(C, "SMALL", 3)
    monkeypatch.setattr(B, "BLOCK_ROWS", 5)
    rows = near_copies(random.Random(3), 160, 3)
    words = [f"c{i}" for i in range(400)]
    rows += [(2000 + i, " ".join(words[2 * i : 2 * i + 60])) for i in range(100)] + [(5000 + i, " ".join(words[:50] + [f"x{i}", f"y{i}"])) for i in range(30)]
    got = result(documents(spark, rows))
    assert got == brute(rows)
    assert len({c for _, _, c, _ in got}) < len(got) - 40
    assert sum(c == 2000 for _, _, c, _ in got) >= 100


def test_defined_results(spark):
    odd = odd_documents(spark)
    assert result(odd) == brute([(r.doc_id, r.text) for r in odd.collect()])
    same = [(None, "a b c d e f"), (None, "A b c d e f"), (4, "x y z"), (4, "x y z"), (4, "q r s t u v w"), (9, "x y z")]
    assert result(documents(spark, same)) == brute(same)
    assert result(documents(spark, [])) == []


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    got = sorted(map(tuple, C.op12(spark, SF_SMALL).collect()), key=repr)
    assert got == brute(rows)
    assert sum(not k for *_, k in got) > 3


def test_intersections_and_forests():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 40, rng.integers(1, 30), dtype=np.uint64)) for _ in range(40)]
    got = B.intersections(sets[:25], sets[25:])
    assert (got == [[len(np.intersect1d(x, y)) for y in sets[25:]] for x in sets[:25]]).all()
    link = rng.random((25, 15)) < 0.1
    labels = rng.integers(0, 12, 40)
    pairs = B.forest(link, labels[:25], labels[25:])

    def classes(pairs):
        own = labels.copy()
        for i, j in pairs:
            own[own == own[25 + j]] = own[i]
        return [np.flatnonzero(own == x).tolist() for x in dict.fromkeys(own.tolist())]

    assert sorted(classes(pairs)) == sorted(classes(np.argwhere(link).tolist()))
    assert len(pairs) == len(set(labels.tolist())) - len(classes(pairs))


def test_sketches_keep_linked_sets():
    rng = np.random.default_rng(3)
    agree = []
    for _ in range(2000):
        n = int(rng.integers(17, 300))
        spare = n * 15 // 85
        a = rng.integers(0, 2**64, n + spare, dtype=np.uint64)
        x, y = np.unique(a[:n]), np.unique(a)
        agree.append((np.frombuffer(C.sketch(x), np.uint32) == np.frombuffer(C.sketch(y), np.uint32)).sum())
    assert min(agree) >= C.least_agreement()
    assert abs(np.mean(agree) / C.SKETCH - 0.855) < 0.01

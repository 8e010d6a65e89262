"""Operator 11 against brute force."""

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tests.llm.cases import documents, odd_documents
from threadmill.llm import trie_variants
from threadmill.llm.common import table

ASCII = str.maketrans(trie_variants.UPPER, trie_variants.LOWER)


def brute(rows):
    """{word: (form, root, n, n_near, form_n)} by the contract, neighbours through deletions."""
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(ASCII)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 5 and c >= 3}
    same = defaultdict(set)  # by a word with one place blanked or left out
    for w in n:
        for i in range(len(w)):
            same["s", w[:i] + "\0" + w[i + 1 :]].add(w)
            if w[:i] + w[i + 1 :] in n:
                same["d", w, i] |= {w, w[:i] + w[i + 1 :]}
    near = defaultdict(set)
    for group in same.values():
        for w in group:
            near[w] |= group - {w}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = {}
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None)
    return out


def check(df, rows):
    got = trie_variants.variants(df).collect()
    found = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in got}
    want = brute(rows)
    assert len(got) == len(found)
    assert found == want
    return found


def test_random_words_places_of_the_edit_and_chains(spark):
    rng = random.Random(5)
    base = ["".join(rng.choice("abé") for _ in range(rng.randint(4, 9))) for _ in range(100)]
    base += [w[: (k := rng.randrange(len(w)))] + rng.choice(["", "a", "b" + w[k]]) + w[k + 1 :] for w in base]
    rows = [(i, " ".join(rng.choices(base, [9] * 100 + [2] * 100, k=100))) for i in range(40)]
    words = {"mnopqrs": 40, "xmnopqrs": 9, "mnopqrsx": 9, "nopqrs": 8, "mnopqr": 7, "mnoxqrs": 6, "mnooopqrs": 3, "mmnopqrs": 4, "yyyyyy": 20, "yyyyy": 5, "yyyyyyy": 3, "mnopxqrsx": 3, "MNOPQRS": 2, "Émnopq": 3, "émnopq": 9}
    rows.append((-1, " ".join(w for w, c in words.items() for _ in range(c))))
    found = check(documents(spark, rows), rows)
    assert any(v[3] > 3 for v in found.values()) and any(v[0] for v in found.values())
    assert found["yyyyyyy"][0] == "yyyyyy" and found["Émnopq"][0] == "émnopq"


def test_long_words(spark, monkeypatch):
    monkeypatch.setattr(trie_variants, "LEVELS", 8)
    rng = random.Random(2)
    out = []
    for size in (6, 7, 8, 9, 10, 40):
        w = "".join(rng.choice("abcdefgh") for _ in range(size))
        out += [w] * 9 + [w[:-1]] * 3 + [w[1:]] * 4 + [w[: size // 2] + "z" + w[size // 2 :]] * 3 + ["z" + w[1:]] * 3
    rows = [(3, " ".join(out)), (4, "q" * 3000), (5, " ".join(["q" * 3000] * 6))]
    assert len(check(documents(spark, rows), rows)) >= 25


def test_odd_documents(spark):
    rows = [(None, "gamma gamma gamma gammo"), (None, "gamma"), (7, None), (8, ""), (9, "12 - 34"), (10, "gammo, gammo.gammo"), (10, "gammo, gammo.gammo")]
    df = documents(spark, rows).withColumn("word", F.lit(1)).withColumn("run", F.lit("x")).withColumn("root", F.lit(None).cast("string"))
    check(df, rows)
    df = odd_documents(spark)
    check(df, [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()])


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, "abcde")]])
def test_nothing_to_compare(spark, rows):
    assert check(documents(spark, rows), rows) == {}


def test_whole_table(spark):
    df = table(spark, SF_SMALL, "documents")
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    check(df, rows)

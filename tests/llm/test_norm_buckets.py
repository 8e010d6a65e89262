"""Operator 13 against scores of all pairs; the SQL is compared in test_query."""

import math
import random
import re
from collections import Counter

import duckdb
import pytest

from tests.conftest import SF_SMALL
from tests.llm.cases import documents, odd_documents
from threadmill.llm import norm_buckets as N

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute(docs, items):
    """(item_id, rank, doc_id, score), all pairs."""
    found = [(d, Counter(terms(t))) for d, t in docs]
    found = [(d, tf) for d, tf in found if tf]
    n_docs, n_terms = len(found), sum(sum(tf.values()) for _, tf in found)
    df = Counter(t for _, tf in found for t in tf)
    out = []
    for item, text in items:
        scores = []
        for d, tf in found:
            m = 75 + (25 * sum(tf.values()) * n_docs) // n_terms
            s = sum(
                c * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * tf[t]) // (1000 * tf[t] + 12 * m))
                for t, c in Counter(terms(text)).items() if t in tf)
            if s > 0:
                scores.append((-s, d is None, d or 0))
        out += [(item, k + 1, None if null else d, -s) for k, (s, null, d) in enumerate(sorted(scores)[:20])]
    return sorted(out, key=repr)


def result(spark, docs, items):
    df = docs if not isinstance(docs, list) else documents(spark, docs)
    held = spark.createDataFrame([(i, t, "x", 1) for i, t in items], "item_id long, text string, n string, rank int")
    got = N.search(df, held)
    assert dict(got.dtypes) == {"item_id": "bigint", "rank": "int", "doc_id": "bigint", "score": "bigint"}
    return sorted(map(tuple, got.collect()), key=repr)


@pytest.mark.parametrize("limits", [{}, {"FIRST_WAVE": 8, "WAVE_GROWTH": 2, "BUCKET_ROWS": 4, "BLOCK_TERMS": 40}])
def test_random_texts(spark, monkeypatch, limits):
    """With small limits: many waves and buckets, several blocks of items."""
    for k, v in limits.items():
        monkeypatch.setattr(N, k, v)
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(60)]
    weights = [1 / (i + 1) for i in range(60)]
    text = lambda n: " ".join(rng.choices(vocabulary, weights, k=n))
    docs = [(i, text(rng.choice([1, 3, 20, 200]))) for i in range(300)]
    docs += [(900 + i, docs[5][1]) for i in range(30)]  # ties
    items = [(i, text(rng.choice([1, 5, 30]))) for i in range(12)] + [(50, docs[5][1]), (51, "absent w3, W3; W4"), (52, "absent")]
    assert result(spark, docs, items) == brute(docs, items)


def test_defined_results(spark):
    odd = odd_documents(spark)
    items = [(1, "plain text"), (2, None), (3, ""), (None, "WORD id é"), (5, "中文 no id at all"), (6, " .,- "), (7, "x" * 20000)]
    assert result(spark, odd, items) == brute([(r.doc_id, r.text) for r in odd.collect()], items)
    assert result(spark, [], items) == result(spark, [(1, None), (2, "..")], items) == result(spark, [(1, "a")], []) == []


def test_rows_that_share_an_item_id(spark):
    docs = [(i, "a b" if i % 2 else "a c d") for i in range(9)]
    items = [(1, "b"), (1, "d")]
    assert result(spark, docs, items) == brute(docs, items)


def test_terms_fold_ascii_only():
    for text in ("AbC-dÉé_9 x y ſK", "ÀÉ中ab12", "a\x00b\x1cc\x7fd`e{f[g@h/i:j"):
        assert [t.decode() for t in N.terms(text.encode())] == terms(text)


def test_waves_hold_all_steps():
    steps = {5: 3000, 4: 3000, 3: 100_000, 1: 7}
    assert N.wave_steps(steps) == [4, 3, 1] and N.wave_steps({}) == []


def test_query(spark):
    got = sorted(map(tuple, N.op13(spark, SF_SMALL).select("item_id", "rank", "doc_id", "score").collect()), key=repr)
    with duckdb.connect() as db:
        for t in ("documents", "benchmark"):
            db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
        assert got == sorted(db.execute(N.OP13_SQL).fetchall(), key=repr)
    read = lambda t, k: [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/{t}.parquet").select(k, "text").collect()]
    assert got == brute(read("documents", "doc_id"), read("benchmark", "item_id"))

"""Counts kept up by changes, quantiles from merged sketches, cells as variants."""

import json
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from threadmill.operators import maintained as M
from threadmill.operators import sketches as K
from threadmill.operators import variants as V
from threadmill.operators.upsert import upsert_replace
from threadmill.operators.wordcount import word_counts

TEXTS = "thread long, id long, text string"


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def _texts(spark, rows):
    return spark.createDataFrame(rows, TEXTS)


def test_counts_equal_a_recount_after_ten_batches(spark):
    rng = random.Random(5)
    root = tempfile.mkdtemp(prefix="tm-counts-", dir="/tmp") + "/counts"
    stored: list[tuple] = []
    text = lambda: rng.choice([None, "", " ".join(rng.choice("abcdef") for _ in range(rng.randint(1, 6)))])
    for batch in range(1, 11):
        before = _texts(spark, stored)
        rows = {}
        for _ in range(12):
            i = rng.randint(0, 30)
            rows[i] = (i % 7, i, text())
        staged = _texts(spark, list(rows.values()))
        if batch % 3 == 0:
            changes, after = M.removed(before, staged, "id"), before.join(staged.select("id"), "id", "left_anti").select("thread", "id", "text")
        else:
            changes, after = M.replaced(before, staged, "id"), upsert_replace(before, staged, "id")
        M.refresh(changes, root, "thread", "text", 3, batch)
        if batch % 4 == 0:  # the batch once more: nothing changes
            M.refresh(changes, root, "thread", "text", 3, batch)
        stored = [tuple(r) for r in after.select("thread", "id", "text").collect()]
        assert _rows(M.stored_counts(spark, root).select("thread", "word", "n")) == _rows(word_counts(_texts(spark, stored), "thread", "text"))


def test_an_emptied_bucket_and_a_commit_cut_short(spark):
    root = tempfile.mkdtemp(prefix="tm-counts-", dir="/tmp") + "/counts"
    assert M.stored_counts(spark, root) is None
    none, some = _texts(spark, []), _texts(spark, [(1, 1, "a b"), (9, 2, "a a")])
    first = M.appended(none, some, "id")
    M.refresh(first, root, "thread", "text", 4, 1)
    M.refresh(M.removed(some, some.where("thread = 9"), "id"), root, "thread", "text", 4, 2)
    assert _rows(M.stored_counts(spark, root).select("thread", "word", "n")) == [(1, "a", 1), (1, "b", 1)]
    # batch 3 reaches both buckets; its first run stopped after one of them
    both = _texts(spark, [(1, 3, "c"), (9, 4, "c")])
    M.refresh(M.appended(some, both.where("thread = 1"), "id"), root, "thread", "text", 4, 3)
    M.refresh(M.appended(some, both, "id"), root, "thread", "text", 4, 3)
    assert _rows(M.stored_counts(spark, root).select("thread", "word", "n")) == [(1, "a", 1), (1, "b", 1), (1, "c", 1), (9, "c", 1)]


def test_changes_cancel_and_drift_fails(spark):
    rows = _texts(spark, [(1, 1, "a b"), (None, 2, "a")])
    assert _rows(M.count_changes(M.replaced(rows, rows.where("id = 1"), "id"), "thread", "text")) == []
    assert _rows(M.appended(rows, rows, "id")) == []
    counts = word_counts(rows, "thread", "text")
    assert _rows(M.merge_counts(counts, M.count_changes(M.removed(rows, rows, "id"), "thread", "text"), "thread")) == []
    wrong = M.count_changes(M.removed(_texts(spark, [(1, 1, "z")]), rows, "id"), "thread", "text")
    with pytest.raises(Exception, match="never been counted"):
        M.merge_counts(counts, wrong, "thread").collect()


def test_merged_sketches_against_exact_quantiles(spark):
    facts = spark.range(60000).select((F.col("id") % 50).alias("k"), (F.pow(F.rand(7), 3) * 1000).alias("v"))
    facts = facts.unionByName(spark.createDataFrame([(1, None), (2, float("nan"))], "k long, v double")).checkpoint()
    dims = spark.createDataFrame([(i, ["Red cat", "red", "blue cat", "", None][i % 5]) for i in range(50)], "k long, title string")
    runs = [K.keyword_sketches(facts.where(c), dims, "k", "title", "v") for c in ("v < 20", "v >= 20 or v is null")]
    both = K.merged(runs[0].unionByName(runs[1]), "word")
    for q in (0.05, 0.5, 0.95):
        errors = K.rank_errors(facts, dims, "k", "title", "v", both, q).collect()
        assert {r.word for r in errors} == {"red", "cat", "blue"}
        assert max(r.error for r in errors) < 0.015
    n = {r.word: r.n for r in both.select("word", K.n_values().alias("n")).collect()}
    assert n == {r.word: r.n_rows for r in errors}
    few = K.keyword_sketches(facts.where("v > 1").limit(0), dims, "k", "title", "v")
    assert few.count() == 0


def test_variants_keep_unknown_keys_and_tell_what_was_not_read(spark):
    cells = ['{"k": 1, "new": {"a": [1, "x"]}}', '{"k": "one"}', '{"k": null}', "{}", "{broken", None, "[1]", "7", '{"k": 1.5}']
    df = spark.createDataFrame([(i, c, "kept") for i, c in enumerate(cells)], "id int, cell string, k_extra string")
    got = V.with_fields(df, "cell", {"k": ("$.k", "bigint")}, keep="v")
    told = {r.id: (r.k, r.k_outcome) for r in got.select("id", "k", "k_outcome").collect()}
    assert told == {0: (1, V.READ), 1: (None, V.WRONG), 2: (None, V.NULL), 3: (None, V.MISSING), 4: (None, V.UNREADABLE), 5: (None, V.NULL),
                    6: (None, V.MISSING), 7: (None, V.MISSING), 8: (1, V.READ)}
    back = {r.id: r.t for r in got.select("id", V.back_to_text("v").alias("t")).collect()}
    assert json.loads(back[0]) == json.loads(cells[0]) and back[4] is None and back[5] is None
    shape = V.shape(df.where("id in (0, 3, 4, 5)"), "cell").first()
    assert "new" in shape["shape"] and (shape.n_cells, shape.n_unreadable) == (3, 1)
    empty = V.shape(df.limit(0), "cell").first()
    assert (empty.n_cells, empty.n_unreadable) == (0, 0)


def test_text_behind_a_cell_is_not_ignored(spark):
    bad = ['{"k":1}}', '{"k":1} x', "1 2", "[1] ]", '{"k":1},{"k":2}', "1]", "1}", "1,2", '1,"b":2', '1},{"a":2', "", "  ", "[1", '"a']
    good = ['{"k":1}', " [1] ", "null", '"]}"', "-1.5e3", "true", '{"v":{"v":[]}}', "[]", "{}"]
    df = spark.createDataFrame([(c,) for c in bad + good], "c string")
    got = {r.c: r.t for r in df.select("c", V.back_to_text(V.parsed("c")).alias("t")).collect()}
    assert all(got[c] is None for c in bad)
    assert all(json.loads(got[c]) == json.loads(c) for c in good)

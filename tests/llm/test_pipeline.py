"""Each stage of the pipeline against a plain version of itself on its own input, and the whole run."""

import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as C
from threadmill.llm import toxicity
from tests.llm.cases import documents, odd_documents
from tests.llm.test_packing import check
from tests.llm.test_parity_join import brute as brute_components
from tests.llm.test_pii import brute as brute_spans

SF = "/root/testdata/sf0.01"


def norm(t):
    return re.sub("[\x20\x09-\x0d]", "", t or "")


def plain_copies(rows):
    best = {}
    for r in rows:
        k = norm(r.text)
        if k not in best or (-len(r.text or ""), r.doc_id) < (-len(best[k].text or ""), best[k].doc_id):
            best[k] = r
    return sorted(best.values(), key=lambda r: r.doc_id)


def test_stages_follow_each_other(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in C.STAGES]
    assert names == ["toxicity", "exact_dedup", "ngram_jaccard_join", "pii", "best_fit_packing"]
    rows = {}
    for name, step in C.STAGES:
        before = docs
        docs = C.stage(step(spark, docs, SF), "test")
        rows[name] = docs.collect()
        if name != names[-1]:
            assert docs.schema.simpleString() == before.schema.simpleString()
    scores = {r.doc_id: r.predicted for r in toxicity.op7(spark, SF).collect()}
    original = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert sorted(rows["toxicity"], key=lambda r: r.doc_id) == sorted((r for r in original if not scores[r.doc_id]), key=lambda r: r.doc_id)
    assert sorted(rows["exact_dedup"], key=lambda r: r.doc_id) == plain_copies(rows["toxicity"])
    component = brute_components([(r.doc_id, r.text) for r in rows["exact_dedup"]])
    assert {r.doc_id for r in rows["ngram_jaccard_join"]} == {d for d, _, c in component if c == d}
    by_id = {r.doc_id: r for r in rows["pii"]}
    assert len(by_id) == len(rows["ngram_jaccard_join"])
    for r in rows["ngram_jaccard_join"]:
        after = by_id[r.doc_id]
        assert not brute_spans(after.text) and after.n_chars == len(after.text)
        if not brute_spans(r.text) and "password" not in r.text.lower() and "AKIA" not in r.text:
            assert after == r
    check(rows["pii"], rows["best_fit_packing"])
    whole = C.run(spark, SF).collect()
    key = lambda r: (r.doc_id, r.piece, r.length, r.ids_crc32)
    assert sorted(map(key, whole)) == sorted(map(key, rows["best_fit_packing"]))


def test_odd_documents(spark):
    odd = odd_documents(spark)
    kept = C.drop_copies(spark, odd, None)
    got = sorted(((r.doc_id is None, r.doc_id, r.text) for r in kept.collect()), key=repr)
    texts = {norm(r.text) for r in odd.collect()}
    assert sorted(norm(t) for _, _, t in got) == sorted(texts) and (False, 3, " \t\n\x0b\x0c\r") in got
    near = C.drop_near_copies(spark, C.stage(kept, "test"), None)
    assert near.columns == odd.columns and near.count() == kept.count()
    assert C.redact_pii(spark, near, None).columns == odd.columns
    assert C.pack(spark, C.redact_pii(spark, C.stage(near, "test"), None), None).count() > 0


def test_empty(spark):
    none = documents(spark, [])
    for step in (C.drop_copies, C.drop_near_copies, C.redact_pii, C.pack):
        assert step(spark, none, None).count() == 0


def test_repeated_rows_leave_one(spark):
    rows = documents(spark, [(1, "same text here"), (1, "same text here"), (2, "same  text here"), (3, "other"), (None, "alone"), (None, "alone")])
    got = sorted((r.doc_id or 0, r.text) for r in C.drop_copies(spark, rows, None).collect())
    assert got == [(0, "alone"), (2, "same  text here"), (3, "other")]


A = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen"
B = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi"


@pytest.mark.parametrize(("rows", "left"), [
    ([(5, A), (9, A + " more"), (5, B), (3, B + " more")], {(5, A), (3, B + " more")}),  # ids shared by different texts
    ([(None, A), (None, A + " more")], 1),
    ([(None, A), (7, A + " more"), (None, B)], {(7, A + " more"), (None, B)}),
    ([(4, A), (4, A + " more"), (4, A), (2, None), (2, ""), (2, " ")], 4),
])
def test_near_copies_are_decided_per_row(spark, rows, left):
    got = [(r.doc_id, r.text) for r in C.drop_near_copies(spark, documents(spark, rows), None).collect()]
    assert len(got) == left if isinstance(left, int) else set(got) == left and len(got) == len(left)


CLASHES = ["_sha", "_points", "_n", "kept_id", "kept_sha", "sha", "points", "given", "row", "node", "kept_node", "first_doc", "n_shingles", "score", "_text", "keep_id"]


def test_extra_columns_of_any_name(spark, tmp_path):
    df = odd_documents(spark).withColumns({c: F.lit(c) for c in CLASHES})
    labels = spark.createDataFrame([(4, 1), (9, 0), (10, 0), (8, 0), (2, 1), (1, None), (None, 1)], "doc_id long, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    for step in (C.drop_toxic, C.drop_copies, C.drop_near_copies, C.redact_pii):
        out = step(spark, df, str(tmp_path)).collect()
        assert out and all(r[c] == c for r in out for c in CLASHES) and list(out[0].asDict()) == df.columns


def test_toxicity_stage_on_empty_tables_and_without_labels(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    odd = odd_documents(spark)
    assert C.drop_toxic(spark, odd, str(tmp_path)).count() == odd.count()
    assert C.drop_toxic(spark, documents(spark, []), str(tmp_path)).count() == 0

"""Shares of bytes, gapless slots, copies together, and the defined cases."""

import zlib

from threadmill.llm import kd_sharding as K
from tests.llm.cases import documents, odd_documents


def check(rows, want_rows):
    assert len(rows) == want_rows
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return {s: sum(r.size for r in rows if r.shard == s) for s in slots}


def test_query(spark):
    rows = K.op10(spark, "/root/testdata/sf0.1").collect()
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet("/root/testdata/sf0.1/documents.parquet").collect()}
    sizes = check(rows, len(docs))
    assert set(sizes) == set(range(40)) and {r.law for r in rows} == {"bytes"}
    assert all(r.size == len(docs[r.doc_id].encode()) + 16 and r.text_crc32 == zlib.crc32(docs[r.doc_id].encode()) and r.grown_shard is None for r in rows)
    mean, largest = sum(sizes.values()) / 40, max(r.size for r in rows)
    assert all(abs(s - mean) <= max(0.05 * mean, largest) for s in sizes.values())
    where, weight = {}, {}
    for r in rows:
        where.setdefault(docs[r.doc_id], set()).add(r.shard)
        weight[docs[r.doc_id]] = weight.get(docs[r.doc_id], 0) + r.size
    assert all(len(s) == 1 for t, s in where.items() if weight[t] <= mean / K.UNITS_PER_SHARD)


def test_a_hot_text_is_dealt_over_shards(spark):
    rows = spark.range(3000).selectExpr("id as doc_id", "if(id % 3 = 0, repeat('h', 90), repeat('x', cast(id % 150 as int))) as text",
                                        "if(id % 3 = 0, 'en', 'de') as lang", "'src0' as source", "id % 150 as n_chars")
    sizes = check(K.shard(rows, 8).collect(), 3000)
    mean = sum(sizes.values()) / 8
    assert len(sizes) == 8 and all(abs(s - mean) < 0.1 * mean for s in sizes.values())


def test_half_of_the_rows_alike(spark):
    df = documents(spark, [(None, "h" * 60)] * 2000 + [(i, "x" * (20 + i % 80)) for i in range(2000)])
    rows = K.shard(df, 40).collect()
    sizes = check(rows, 4000)
    mean = sum(sizes.values()) / 40
    assert len(sizes) == 40 and all(abs(s - mean) < 0.1 * mean for s in sizes.values())


def test_thresholds_against_a_sorted_list(spark):
    """Each cut of the tree is a weighted median along the node's widest dimension."""
    df = documents(spark, [(i, "w" * (i * 7919 % 900)) for i in range(600)])
    units = K._coordinates(df.selectExpr("xxhash64(text) key", "0 part", "cast(length(text) + 16 as bigint) weight", "lang", "source", "n_chars"))
    rows = units.withColumn("leaf", K.kd_tree(units, 8)).collect()

    def split(some, leaves):
        if leaves == 1:
            assert len({r.leaf for r in some}) == 1
            return
        widths = {d: max(r[d] for r in rows) - min(r[d] for r in rows) or 1 for d in K.DIMENSIONS}
        dim = max(K.DIMENSIONS, key=lambda d: (max(r[d] for r in some) - min(r[d] for r in some)) / widths[d])
        some = sorted(some, key=lambda r: r[dim])
        first = min(r.leaf for r in some)
        left = [r for r in some if r.leaf < first + leaves // 2]
        assert {r[dim] for r in left} == {r[dim] for r in some[: len(left)]}  # a cut along that dimension
        goal, weight = sum(r.weight for r in some) * (leaves // 2) / leaves, sum(r.weight for r in left)
        assert abs(weight - goal) <= max(r.weight for r in some) * 2
        split(left, leaves // 2)
        split(some[len(left) :], leaves - leaves // 2)

    split(rows, 8)


def test_defined_results(spark):
    odd = odd_documents(spark)
    rows = K.shard(odd, 3).collect()
    check(rows, odd.count())
    assert {(r.size, r.text_crc32) for r in rows if r.doc_id == 1} == {(16, 0)}
    assert K.shard(documents(spark, [])).collect() == []
    assert check(K.shard(odd, 1).collect(), odd.count()).keys() == {0}


def test_plan_has_no_python(spark):
    plan = K.op10(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan

"""Components against union-find, hot groups against a plain join, gapless numbers."""

import random

import pytest
from pyspark.sql import functions as F

from threadmill.llm import common


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(20)] + [(200, 200 + i) for i in range(1, 30)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    want = {x: find(x) for a, b in edges if a != b for x in (a, b)}
    got = common.connected_components(spark.createDataFrame(edges + edges[:5], "a long, b long")).collect()
    assert {r["node"]: r["comp"] for r in got} == want and len(got) == len(want)


def test_no_links(spark):
    assert common.connected_components(spark.createDataFrame([(1, 1)], "a long, b long")).count() == 0


def test_hot_groups(spark):
    rows = spark.range(5000).select("id", F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id") % 700).alias("k"))
    groups = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("top"))
    got = common.attach_groups(rows, groups, "k", "n", 5000)
    assert sorted(map(tuple, got.select("id", "top").collect())) == sorted(map(tuple, rows.join(groups, "k").select("id", "top").collect()))
    assert "BroadcastHashJoin" in got._jdf.queryExecution().executedPlan().toString()


def test_numbers(spark, monkeypatch):
    monkeypatch.setattr(common, "NUMBER_ROWS", 10)
    rows = spark.range(300).selectExpr("id", "if(id % 3 = 0, 0, id % 5) as g")
    sizes = {r["g"]: r["n"] for r in rows.groupBy("g").agg(F.count(F.lit(1)).alias("n")).collect()}
    by: dict = {}
    for r in common.numbered(rows, "g", sizes, ["id"], "at").collect():
        by.setdefault(r["g"], []).append(r["at"])
    assert all(sorted(x) == list(range(sizes[g])) for g, x in by.items())

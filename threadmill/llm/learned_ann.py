"""Approximate nearest neighbours by learned partitions.

On a bounded sample: build the neighbour graph, partition it into balanced
parts with few edges between them, and train a small classifier to predict,
from a vector alone, how its neighbours are spread over the parts. Every row
of the table is then put into its most probable part; a query is routed to
the most probable parts until they hold `coverage` of the predicted
neighbours, and is compared exactly with all rows of those parts, in blocks.

Nearness is the inner product in double precision; ties go to the smaller id.
Rows with the same vector are one candidate with the ids that can matter (of
one vector, no list of k can hold more than its k + 1 smallest ids), so a
vector that a third of the rows share costs one comparison.

Bounds: the fit sees `Settings.sample` distinct vectors, the smallest by hash;
parts grow with the square root of the table, up to `most_parts` (one for every
64 sampled vectors), as parts visited and rows compared both cost; a part is compared in blocks of
`block_rows` rows and `block_queries` queries whatever its size.

Defined results: vectors that are NULL, zero, of another length than most of
the sample, or hold NULL or non-finite components take no part; a NULL id
takes no part; a repeated row (same id and vector) is one row; of an id with
several vectors, each is a candidate and a query; fewer than k candidates
give all of them; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from threadmill.llm.common import attach_groups, stage, table

QUERY_EVERY = 20


@dataclass(frozen=True)
class Settings:
    sample: int = 8192
    graph_neighbours: int = 16
    per_part: float = 25.0  # the table has sqrt(rows) / per_part parts,
    most_parts: int = 128  # so many at most
    slack: float = 1.1  # a part's largest share of the sample, of the mean
    hidden: int = 96
    epochs: int = 40
    coverage: float = 0.92
    block_rows: int = 4096
    block_queries: int = 1024
    seed: int = 7


# ------------------------------------------------------------------ fitting, on the sample


def neighbour_graph(x: np.ndarray, k: int, block: int = 1024) -> np.ndarray:
    """Indices of the k largest inner products of each row, itself left out."""
    k = min(k, len(x) - 1)
    out = np.empty((len(x), k), np.int64)
    for at in range(0, len(x), block):
        score = x[at : at + block] @ x.T
        score[np.arange(len(score)), np.arange(at, at + len(score))] = -np.inf
        out[at : at + block] = np.argpartition(-score, k - 1, axis=1)[:, :k] if k else 0
    return out


def _balanced(gains: np.ndarray, order: np.ndarray, capacity: int) -> np.ndarray:
    """Each row, in `order`, goes to its best part that has room."""
    room = np.full(gains.shape[1], capacity)
    out = np.empty(len(gains), np.int64)
    best = np.argsort(-gains, axis=1)
    for i in order:
        for p in best[i]:
            if room[p]:
                room[p] -= 1
                out[i] = p
                break
    return out


def balanced_parts(x: np.ndarray, near: np.ndarray, parts: int, s: Settings) -> np.ndarray:
    """Parts of near equal size with few neighbour edges between them: balanced
    k-means to begin with, then moves along the graph under the size limit."""
    rng = np.random.default_rng(s.seed)
    capacity = int(np.ceil(len(x) / parts * s.slack))
    centre = x[rng.choice(len(x), parts, replace=False)]
    label = None
    for _ in range(10):
        d = 2 * x @ centre.T - (centre**2).sum(1)
        top = np.sort(d, axis=1)
        label = _balanced(d, np.argsort(top[:, -2] - top[:, -1]) if parts > 1 else np.arange(len(x)), capacity)
        for p in range(parts):
            if (label == p).any():
                centre[p] = x[label == p].mean(0)
    rows = np.repeat(np.arange(len(x)), near.shape[1])
    for _ in range(12):
        votes = np.zeros((len(x), parts))
        np.add.at(votes, (rows, label[near].ravel()), 1)
        np.add.at(votes, (near.ravel(), label[rows]), 1)
        own = votes[np.arange(len(x)), label]
        goal = votes.argmax(1)
        gain = votes[np.arange(len(x)), goal] - own
        size = np.bincount(label, minlength=parts)
        moved = 0
        for i in np.argsort(-gain):
            if gain[i] <= 0:
                break
            if size[goal[i]] < capacity:
                size[goal[i]] += 1
                size[label[i]] -= 1
                label[i] = goal[i]
                moved += 1
        if moved < len(x) // 1000 + 1:
            break
    return label


def train(x: np.ndarray, target: np.ndarray, s: Settings) -> dict:
    """One hidden layer, softmax over the parts, cross entropy with soft targets (Adam)."""
    rng = np.random.default_rng(s.seed)
    mean, scale = x.mean(0), x.std() + 1e-12
    z = (x - mean) / scale
    dims = [x.shape[1], s.hidden, target.shape[1]]
    w = [rng.normal(0, np.sqrt(2 / a), (a, b)) for a, b in zip(dims, dims[1:])] + [np.zeros(b) for b in dims[1:]]
    m, v = [np.zeros_like(p) for p in w], [np.zeros_like(p) for p in w]
    t = 0
    for epoch in range(s.epochs):
        rate = 3e-3 * (1 - epoch / s.epochs) + 1e-4
        order = rng.permutation(len(z))
        for at in range(0, len(z), 256):
            i = order[at : at + 256]
            h = np.maximum(z[i] @ w[0] + w[2], 0)
            p = _softmax(h @ w[1] + w[3])
            g = (p - target[i]) / len(i)
            gh = (g @ w[1].T) * (h > 0)
            t += 1
            for q, grad in enumerate([z[i].T @ gh + 1e-5 * w[0], h.T @ g + 1e-5 * w[1], gh.sum(0), g.sum(0)]):
                m[q] = 0.9 * m[q] + 0.1 * grad
                v[q] = 0.999 * v[q] + 0.001 * grad**2
                w[q] -= rate * (m[q] / (1 - 0.9**t)) / (np.sqrt(v[q] / (1 - 0.999**t)) + 1e-8)
    return {"mean": mean, "scale": scale, "w": w}


def _softmax(a: np.ndarray) -> np.ndarray:
    e = np.exp(a - a.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def probabilities(model: dict, x: np.ndarray) -> np.ndarray:
    """How the neighbours of each row are expected to be spread over the parts."""
    w = model["w"]
    h = np.maximum((x - model["mean"]) / model["scale"] @ w[0] + w[2], 0)
    return _softmax(h @ w[1] + w[3])


def fit(x: np.ndarray, rows: int, s: Settings = Settings()) -> dict:
    """The router for a table of `rows` rows from a sample of its vectors."""
    parts = int(max(1, min(s.most_parts, rows**0.5 / s.per_part, len(x) // 64)))
    near = neighbour_graph(x, s.graph_neighbours)
    label = balanced_parts(x, near, parts, s) if parts > 1 else np.zeros(len(x), np.int64)
    target = np.zeros((len(x), parts))
    if near.shape[1]:
        np.add.at(target, (np.repeat(np.arange(len(x)), near.shape[1]), label[near].ravel()), 1)
    np.add.at(target, (np.arange(len(x)), label), 1)  # a vector is its own neighbour: the part it is stored in
    model = train(x, target / target.sum(1, keepdims=True), s)
    return model | {"parts": parts, "coverage": s.coverage}


def routes(model: dict, p: np.ndarray) -> list[np.ndarray]:
    """For each row of probabilities the most probable parts that hold `coverage` of them."""
    order = np.argsort(-p, axis=1, kind="stable")
    total = np.cumsum(np.take_along_axis(p, order, 1), axis=1)
    n = (total < model["coverage"]).sum(1) + 1
    return [order[i, : n[i]] for i in range(len(p))]


# ------------------------------------------------------------------ search, over the whole table


def usable(vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, v): distinct rows with a finite vector other than zero."""
    v = F.col(vector).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return (
        vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), v.alias("v"), (fine & F.exists(v, lambda x: x != 0)).alias("fine"))
        .where(F.col("fine") & F.col("vec_id").isNotNull()).select("vec_id", "v").dropDuplicates(["vec_id", "v"])
    )


def _routed(rows: DataFrame, model: dict, several: bool) -> DataFrame:
    """(part, node, x): rows (node, v) in their most probable part, or in all parts that a query of them visits."""

    def run(batches):
        import pyarrow as pa

        for b in batches:
            v = b.column(1)
            x = np.asarray(v.values.slice(v.offsets[0].as_py()), np.float64)[: len(v) * len(model["mean"])].reshape(len(v), -1)
            if not len(x):
                continue
            p = probabilities(model, x)
            parts = routes(model, p) if several else list(p.argmax(1)[:, None])
            at = np.repeat(np.arange(len(x)), [len(r) for r in parts])
            packed = [r.tobytes() for r in x]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(parts), pa.int32()), b.column(0).take(pa.array(at)), pa.array([packed[i] for i in at], pa.binary())],
                names=["part", "node", "x"])

    return rows.select("node", "v").mapInArrow(run, "part int, node bigint, x binary")


def _compare(keep: int):
    """Of a block of rows and a block of queries: each query's `keep` nearest rows."""

    def run(rows, queries):
        import pandas as pd

        if not len(rows) or not len(queries):
            return pd.DataFrame({"query": np.zeros(0, np.int64), "node": np.zeros(0, np.int64), "score": np.zeros(0)})
        x = np.frombuffer(b"".join(rows["x"]), np.float64).reshape(len(rows), -1)
        q = np.frombuffer(b"".join(queries["x"]), np.float64).reshape(len(queries), -1)
        node = rows["node"].to_numpy()
        order = np.argsort(node, kind="stable")  # of equal products the smaller ids come first
        x, node = x[order], node[order]
        score = q @ x.T
        n = min(keep, len(node))
        if n < len(node):
            # all that reach the n-th product, but for rounding; then the exact measure decides
            least = np.partition(score, len(node) - n, axis=1)[:, len(node) - n]
            least = least - 1e-9 * (1 + np.abs(least))
            at, to = np.nonzero(score >= least[:, None])
        else:
            at, to = np.nonzero(np.ones_like(score, bool))
        exact = (q[at] * x[to]).sum(axis=1)  # the same order of additions for every pair
        order = np.lexsort((node[to], -exact, at))
        at, to, exact = at[order], to[order], exact[order]
        place = np.arange(len(at)) - np.searchsorted(at, at)
        near = place < keep
        return pd.DataFrame({"query": queries["node"].to_numpy()[at[near]], "node": node[to[near]], "score": exact[near]})

    return run


def search(vectors: DataFrame, k: int = 20, every: int = QUERY_EVERY, s: Settings = Settings()) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k nearest found of each row whose id is divisible by `every`."""
    rows = stage(usable(vectors), "ann-rows")
    first = rows.withColumn("_n", F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))).where(F.col("_n") <= k + 1)
    all_ids = first.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))  # at most k + 1
    candidates = stage(all_ids.withColumn("node", F.xxhash64("v")), "ann-candidates")
    sample = [r["v"] for r in candidates.orderBy("node").limit(s.sample).select("v").collect()]  # bounded
    if not sample:
        return rows.select(F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id", F.lit(0.0).alias("score")).limit(0)
    lengths = [len(v) for v in sample]
    width = max(set(lengths), key=lambda n: (lengths.count(n), n))
    x = np.array([v for v in sample if len(v) == width])
    candidates = candidates.where(F.size("v") == width)
    rows = rows.where(F.size("v") == width)
    model = fit(x, candidates.count(), s)

    queries = rows.where(F.col("vec_id") % every == 0)
    asked = stage(
        queries.groupBy("v").agg(F.count(F.lit(1)).alias("n_queries")).withColumn("node", F.xxhash64("v")), "ann-asked")
    stored = stage(_routed(candidates, model, several=False), "ann-index")
    visits = stage(_routed(asked, model, several=True), "ann-visits")

    def blocks(df, size):  # one row per part
        n = {r["part"]: -(-r["count"] // size) for r in df.groupBy("part").count().collect()}
        out = F.lit(1)
        for part, b in n.items():
            if b > 1:
                out = F.when(F.col("part") == part, b).otherwise(out)
        return out

    row_blocks, query_blocks = blocks(stored, s.block_rows), blocks(visits, s.block_queries)
    spread = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    left = stored.withColumn("rb", F.pmod(F.xxhash64("node"), row_blocks).cast("int")).withColumn("qb", spread(query_blocks))
    right = visits.withColumn("qb", F.pmod(F.xxhash64("node"), query_blocks).cast("int")).withColumn("rb", spread(row_blocks))
    found = left.groupBy("part", "rb", "qb").cogroup(right.groupBy("part", "rb", "qb")).applyInPandas(
        _compare(k + 1), "query bigint, node bigint, score double")
    ids = candidates.select("node", "ids")
    # nodes by score, then smallest id: k + 1 of them hold every id that can be among the k nearest
    ranked = found.join(ids, "node").withColumn(
        "_n", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), F.col("ids")[0], "node"))).where(F.col("_n") <= k + 1)
    lists = (
        ranked.select("query", F.explode("ids").alias("id"), (-F.col("score")).alias("minus"))
        .groupBy("query").agg(F.slice(F.sort_array(F.collect_set(F.struct("minus", "id"))), 1, k + 1).alias("near"))  # at most (k + 1) squared
    )
    answers = stage(asked.join(lists.withColumnRenamed("query", "node"), "node").select("v", "n_queries", "near"), "ann-answers")
    own = attach_groups(queries, answers, "v", "n_queries", rows.count())
    others = F.slice(F.filter("near", lambda c: c["id"] != F.col("vec_id")), 1, k)
    return (
        own.select(F.col("vec_id").alias("query_id"), F.posexplode(others).alias("pos", "c"))
        .select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("c.id").alias("vec_id"), (-F.col("c.minus")).alias("score"))
    )


def op1(spark, sf_dir) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"))

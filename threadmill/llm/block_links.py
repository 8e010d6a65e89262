"""Links inside large groups of sets, without all their pairs.

Groups come with the components known so far. Only members of different
components have to meet: those outside a group's main component (the one with
at least half of its members, if there is one) meet each other and the main
one's members, block by block. A block pair is one task's unit of work:

1. on sketches: which members have a possible partner of another component;
2. on the sets of those members: exact intersections, and of all links in a
   block pair a spanning forest over components.

So rows grow with members and blocks, never with pairs, no link between
components is lost, and no candidate needs a second round.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadmill.llm.common import stage

#: Members and set elements of a block.
BLOCK_ROWS = 1024
BLOCK_ELEMENTS = 1 << 20
#: Distinct elements that one matrix product covers.
PRODUCT_COLUMNS = 4096


def by_groups(batches, keys: int):
    """(key, rows) of consecutive rows with equal first `keys` columns, over Arrow batches."""
    key, rows = None, []
    for b in batches:
        for r in zip(*[c.to_pylist() for c in b.columns]):
            if r[:keys] != key:
                if rows:
                    yield key, rows
                key, rows = r[:keys], []
            rows.append(r[keys:])
    if rows:
        yield key, rows


def intersections(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of each left with each right set (arrays of distinct values)."""
    sizes = np.array([len(x) for x in left + right])
    at = np.repeat(np.arange(len(sizes)), sizes)
    values, place, n = np.unique(np.concatenate(left + right), return_inverse=True, return_counts=True)
    shared = np.cumsum(n > 1) - 1  # columns of values that more than one set holds
    keep = n[place] > 1
    column, at = shared[place[keep]], at[keep]
    order = np.argsort(column, kind="stable")
    column, at = column[order], at[order]
    out = np.zeros((len(left), len(right)), np.int64)
    columns = int(column[-1]) + 1 if len(column) else 0
    for low in range(0, columns, PRODUCT_COLUMNS):
        a, b = np.searchsorted(column, (low, low + PRODUCT_COLUMNS))
        held = np.zeros((len(sizes), min(PRODUCT_COLUMNS, columns - low)), np.float32)
        held[at[a:b], column[a:b] - low] = 1
        out += (held[: len(left)] @ held[len(left) :].T).astype(np.int64)
    return out


def forest(link: np.ndarray, left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """Of the links (rows: left, columns: right) enough to join all components (labels of both sides) that they join."""
    out = []
    left, right = left.copy(), right.copy()
    for i in np.flatnonzero(link.any(axis=1)):
        at = np.flatnonzero(link[i] & (right != left[i]))
        while len(at):
            j = at[0]
            out.append((int(i), int(j)))
            gone = right[j]
            left[left == gone] = left[i]
            right[right == gone] = left[i]
            at = at[right[at] != left[i]]
    return out


def _dealt(groups: DataFrame, nodes: DataFrame) -> DataFrame:
    """gid, p, q, left, node, comp: members dealt to block pairs; `left` where a member's own block is p."""
    sized = groups.join(nodes.select("node", "n_shingles"), "node")
    parts = sized.groupBy("gid", "comp").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("w"))
    per = parts.groupBy("gid").agg(F.sum("n").alias("n"), F.sum("w").alias("w"), F.max(F.struct("n", "comp", "w")).alias("top"))
    main = F.col("top.n") * 2 >= F.col("n")
    per = per.select(
        "gid", F.when(main, F.col("top.comp")).alias("main"),
        F.when(main, F.col("top.n")).otherwise(0).alias("n_m"), F.when(main, F.col("top.w")).otherwise(0).alias("w_m"), "n", "w")
    count = lambda n, w: F.greatest(F.ceil(n / BLOCK_ROWS), F.ceil(w / BLOCK_ELEMENTS)).cast("int")
    per = stage(per.select("gid", "main", count(F.col("n") - F.col("n_m"), F.col("w") - F.col("w_m")).alias("others"), count(F.col("n_m"), F.col("w_m")).alias("mains")), "link-blocks")
    rows = groups.join(per, "gid").withColumn("h", F.xxhash64("node", "gid"))
    inside = F.coalesce(F.col("comp") == F.col("main"), F.lit(False))
    own = F.when(inside, -1 - F.pmod("h", "mains")).otherwise(F.pmod("h", "others")).cast("int")
    span = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    with_others = F.transform(span("others"), lambda j: F.when(inside, F.struct(j.alias("p"), F.col("own").alias("q"))).otherwise(
        F.struct(F.least("own", j).alias("p"), F.greatest("own", j).alias("q"))))
    with_mains = F.when(inside | (F.col("mains") == 0), F.array().cast("array<struct<p:int,q:int>>")).otherwise(
        F.transform(span("mains"), lambda k: F.struct(F.col("own").alias("p"), (-1 - k).alias("q"))))
    return rows.withColumn("own", own).withColumn("to", F.explode(F.concat(with_others, with_mains))).select(
        "gid", F.col("to.p").alias("p"), F.col("to.q").alias("q"), (F.col("own") == F.col("to.p")).alias("left"), "node", "comp")


def _together(rows: DataFrame) -> DataFrame:
    width = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return rows.repartition(width, "gid", "p", "q").sortWithinPartitions("gid", "p", "q", F.desc("left"))


def _labels(comp: list) -> np.ndarray:
    return np.unique(np.array(comp, object), return_inverse=True)[1]


def links_in_groups(groups: DataFrame, nodes: DataFrame, sets: Callable[[DataFrame], DataFrame], sketches: type, part: int, whole: int) -> DataFrame:
    """Verified links (a, b) that join the components of each group as far as its members' links do.

    groups: gid, node, comp (staged); nodes: node, n_shingles, sketch; `sets`
    gives (node, members: packed distinct 64-bit hashes) of a table of nodes;
    `sketches(n, sketch)` holds some members and its near(i, at) tells which of
    the members `at` member i can be similar to. Similar: part / whole or more.
    """
    kind = dict(groups.dtypes)
    dealt = _dealt(groups, nodes).join(nodes.select("node", "n_shingles", "sketch"), "node")

    def possible(batches):
        import pyarrow as pa

        for key, rows in by_groups(batches, 3):
            left = np.array([r[0] for r in rows])
            comp = _labels([r[2] for r in rows])
            held = sketches(np.array([r[3] for r in rows]), [r[4] for r in rows])
            rest = np.arange(len(rows)) if key[1] == key[2] else np.flatnonzero(~left)
            hit = np.zeros(len(rows), bool)
            for i in np.flatnonzero(left):
                at = rest[(comp[rest] != comp[i]) & ((rest > i) | (key[1] != key[2]))]
                if len(at):
                    near = at[held.near(i, at)]
                    hit[near] = True
                    hit[i] |= len(near) > 0
            some = [rows[i] for i in np.flatnonzero(hit)]
            if some:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k] * len(some), t) for k, t in zip(key, types[:3])] + [pa.array([r[c] for r in some], t) for c, t in enumerate(types[3:])],
                    names=["gid", "p", "q", "left", "node", "comp"])

    import pyarrow as pa

    arrow = {"bigint": pa.int64(), "binary": pa.binary()}
    types = [arrow[kind["gid"]], pa.int32(), pa.int32(), pa.bool_(), arrow[kind["node"]], arrow[kind["comp"]]]
    schema = f"gid {kind['gid']}, p int, q int, left boolean, node {kind['node']}, comp {kind['comp']}"
    hits = stage(_together(dealt.select("gid", "p", "q", "left", "node", "comp", "n_shingles", "sketch")).mapInArrow(possible, schema), "link-possible")
    full = hits.join(sets(hits.select("node").distinct()), "node")

    def verified(batches):
        for key, rows in by_groups(batches, 3):
            side = np.array([r[0] for r in rows])
            comp = _labels([r[2] for r in rows])
            members = [np.frombuffer(r[3], np.uint64) for r in rows]
            n = np.array([len(m) for m in members])
            a = np.flatnonzero(side)
            b = a if key[1] == key[2] else np.flatnonzero(~side)
            if len(a) and len(b):
                common = intersections([members[i] for i in a], [members[j] for j in b])
                link = whole * common >= part * (n[a][:, None] + n[b][None, :] - common)
                pairs = forest(link, comp[a], comp[b])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([rows[a[i]][1] for i, _ in pairs], types[4]), pa.array([rows[b[j]][1] for _, j in pairs], types[4])], names=["a", "b"])

    return _together(full.select("gid", "p", "q", "left", "node", "comp", "members")).mapInArrow(verified, f"a {kind['node']}, b {kind['node']}").distinct()

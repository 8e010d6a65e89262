"""Byte-balanced sharding by a k-d tree over metadata (DataFrame functions only).

The tree splits at weighted medians along the widest metadata dimension until
each leaf holds its share of the bytes; with 40 shards a node of k leaves
splits k//2 : k - k//2. Medians are found by distributed histograms: one
aggregation per refinement covers all nodes of a level, and the driver only
sees `nodes x BINS` sums, whatever the input.

What is placed is a unit: all rows of one text, so copies share a shard. A
text whose rows weigh more than 1/16 of a shard is dealt over as many units as
it takes (fewer than 16 x shards texts can be that heavy, so that list is
broadcast), by a hash of the row's place in the staged table, so identical rows
part as well. Dimensions: language, source (as hashes: same value, same place)
and length (logarithm); the unit's own hash breaks ties, so a dimension with
one value for most rows still splits at the right weight.

Law `bytes`: the sizes of the shards are near equal; the row counts need not be.

Defined results: NULL text weighs 16 bytes and has crc 0; NULL metadata is a
value of its own; NULL doc_ids and repeated rows are placed like any others,
one row out for each row in; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadmill.llm.common import numbered, stage, with_row_id

SHARDS = 40
ROW_BYTES = 16  # fixed value: bytes that each row weighs besides its text
BIN_BITS = 12
BINS = 1 << BIN_BITS
TIE_BITS = 36  # of the unit's hash below the 24 bits of a dimension's value
COORD_BITS = 24 + TIE_BITS
UNITS_PER_SHARD = 16

DIMENSIONS = ["by_lang", "by_source", "by_length"]


def _coordinates(units: DataFrame) -> DataFrame:
    """Adds one bigint per dimension: 24 bits of its value, then the tie-breaking hash."""
    tie = F.shiftrightunsigned(F.xxhash64("key", "part", F.lit("tie")), 64 - TIE_BITS)
    place = lambda v: F.shiftleft(v.cast("bigint"), TIE_BITS).bitwiseOR(tie)
    hashed = lambda c: F.shiftrightunsigned(F.xxhash64(c), 40)
    length = F.least(F.floor(F.log2(F.greatest(F.coalesce("n_chars", F.lit(0)), F.lit(0)) + F.lit(1.0)) * F.lit(1 << 18)), F.lit((1 << 24) - 1))
    return units.withColumns({"by_lang": place(hashed("lang")), "by_source": place(hashed("source")), "by_length": place(length)})


class _Node:
    """A node of the tree: its leaves [first, first + leaves) and, once split, its threshold."""

    def __init__(self, first: int, leaves: int):
        self.first, self.leaves = first, leaves
        self.dim: str | None = None
        self.at = 0
        self.left: _Node | None = None
        self.right: _Node | None = None

    def expr(self) -> Column:
        """The first leaf of the deepest node that a unit belongs to."""
        if self.left is None:
            return F.lit(self.first)
        return F.when(F.col(self.dim) < F.lit(self.at), self.left.expr()).otherwise(self.right.expr())


def _thresholds(units: DataFrame, node: Column, goals: dict[int, tuple[str, float]]) -> dict[int, int]:
    """For each node the coordinate along its dimension below which its goal of weight lies."""
    base = {k: 0 for k in goals}  # the prefix of the threshold that is known
    below = {k: 0.0 for k in goals}
    coord = F.lit(None).cast("bigint")
    for k, (dim, _) in goals.items():
        coord = F.when(node == k, F.col(dim)).otherwise(coord)
    shift = COORD_BITS
    open_nodes = set(goals)
    while shift > 0 and open_nodes:
        shift -= BIN_BITS
        prefix = F.lit(None).cast("bigint")
        for k in open_nodes:
            prefix = F.when(node == k, F.lit(base[k])).otherwise(prefix)
        sums = (
            units.select(node.alias("node"), coord.alias("c"), prefix.alias("p"), "weight")
            .where(F.col("p").isNotNull() & (F.shiftright("c", shift + BIN_BITS) == F.col("p")))
            .groupBy("node", F.shiftright("c", shift).alias("bin")).agg(F.sum("weight").alias("w"), F.count(F.lit(1)).alias("n"))
            .collect()  # at most open nodes x BINS rows
        )
        by: dict[int, list] = {k: [] for k in open_nodes}
        for r in sums:
            by[r["node"]].append((r["bin"], r["w"], r["n"]))
        for k in list(open_nodes):
            goal = goals[k][1]
            base[k] <<= BIN_BITS
            bins = sorted(by[k])
            if not bins:
                open_nodes.discard(k)
                base[k] <<= shift
                continue
            for b, w, n in bins:
                base[k] = b
                if below[k] + w >= goal or b == bins[-1][0]:
                    break
                below[k] += w
            # one unit, or so little that cutting on the cell's nearer edge is as good
            if shift == 0 or n == 1 or w <= goal * 1e-4:
                if goal - below[k] > below[k] + w - goal:
                    base[k] += 1
                open_nodes.discard(k)
                base[k] <<= shift
    return base


def kd_tree(units: DataFrame, leaves: int) -> Column:
    """The leaf number of each unit (columns: weight and DIMENSIONS)."""
    root = _Node(0, leaves)
    level = [root] if leaves > 1 else []
    ranges = units.agg(*[F.max(d).alias(f"hi_{d}") for d in DIMENSIONS], *[F.min(d).alias(f"lo_{d}") for d in DIMENSIONS]).first()
    width = {d: max(1, (ranges[f"hi_{d}"] or 0) - (ranges[f"lo_{d}"] or 0)) for d in DIMENSIONS}
    while level:
        node = root.expr()
        stats = {
            r["node"]: r
            for r in units.groupBy(node.alias("node")).agg(
                F.sum("weight").alias("w"), *[((F.max(d) - F.min(d)) / F.lit(float(width[d]))).alias(d) for d in DIMENSIONS]).collect()
        }  # at most `leaves` rows
        goals = {}
        for n in level:
            if n.first in stats:
                s = stats[n.first]
                n.dim = max(DIMENSIONS, key=lambda d: s[d])
                goals[n.first] = (n.dim, float(s["w"]) * (n.leaves // 2) / n.leaves)
        cut = _thresholds(units, node, goals) if goals else {}
        below = []
        for n in level:
            half = n.leaves // 2
            n.dim, n.at = n.dim or DIMENSIONS[0], cut.get(n.first, 0)
            n.left, n.right = _Node(n.first, half), _Node(n.first + half, n.leaves - half)
            below += [c for c in (n.left, n.right) if c.leaves > 1]
        level = below
    return root.expr()


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, shard, slot."""
    text = F.coalesce("text", F.lit(""))
    rows = stage(
        docs.select(
            "doc_id", (F.octet_length(text) + ROW_BYTES).cast("bigint").alias("size"), F.crc32(text).alias("text_crc32"),
            F.xxhash64(text).alias("key"), "lang", "source", F.col("n_chars").cast("bigint").alias("n_chars")),
        "shard-rows",
    )
    rows = with_row_id(rows, "row_id")
    n_rows, total = rows.agg(F.count(F.lit(1)), F.sum("size")).first()
    if not n_rows:
        return rows.select("doc_id", "size", "text_crc32", F.lit(0).alias("shard"), F.lit(0).cast("bigint").alias("slot"))
    most = max(1, total // (shards * UNITS_PER_SHARD))
    heavy = rows.groupBy("key").agg(F.sum("size").alias("bytes")).where(F.col("bytes") > most)  # fewer than total / most keys
    parts = heavy.select("key", F.ceil(F.col("bytes") / most).alias("parts"))
    dealt = rows.join(F.broadcast(parts), "key", "left").withColumn(
        "part", F.when(F.col("parts").isNull(), 0).otherwise(F.pmod("row_id", F.col("parts"))).cast("int"))
    units = stage(
        _coordinates(dealt.groupBy("key", "part").agg(
            F.sum("size").alias("weight"), F.min("lang").alias("lang"), F.min("source").alias("source"), F.max("n_chars").alias("n_chars"))
        ).select("key", "part", "weight", *DIMENSIONS),
        "shard-units",
    )
    placed = units.select("key", "part", kd_tree(units, shards).alias("shard"))
    out = dealt.join(placed, ["key", "part"]).select("doc_id", "size", "text_crc32", "row_id", "shard")
    sizes = {r["shard"]: r["n"] for r in out.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row per shard
    return numbered(out, "shard", sizes, ["doc_id", "text_crc32", "size", "row_id"], "slot").drop("row_id")


def op10(spark, sf_dir) -> DataFrame:
    from threadmill.llm.common import table

    return shard(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))

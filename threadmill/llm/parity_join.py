"""N-gram Jaccard join by parity sketches.

A document is its set of distinct word shingles. XOR-hashing shingles into the
blocks of a sketch makes blocks equal unless one of the shingles in which two
sets differ falls into them, so sets that differ in D shingles differ in at
most D blocks. Per size band the number of blocks exceeds the largest D that
the similarity allows, so linked sets share a block that is not empty
(pigeonhole); blocks are the join keys. What shares a key is tested by the
Hamming distance of bit parity sketches - it never exceeds the symmetric
difference - and what passes is verified on the sets themselves.

Bands: sizes up to U, for a growing list of U; a pair belongs to the band of
its larger set, and a set takes part in its own band and in the next one if a
partner there can be similar. A set with so few non-empty blocks that the
pigeonhole could fail (small sets) also joins by its prefix of shingles in
hash order; two such sets that are similar share one of them.

Copies are one node: nodes are distinct sets. Groups that share a key are not
expanded into pairs: their members are tested against one centre, connected
components are built from the verified links, and only groups that are not
inside one component by then have their members of different components
tested, in blocks (`block_links`), of which only links that join components
come back. So no link between different components is missed, and a
group of near copies costs as much as its size.

Defined results: NULL, empty and white texts have the empty set and are linked
with nothing (component_id is their own doc_id); fewer words than a shingle
are one shingle; a NULL doc_id takes part, and is never a component_id unless
its component has no other; repeated rows are copies; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadmill.llm.block_links import links_in_groups
from threadmill.llm.common import attach_groups, connected_components, stage, table
from threadmill.llm.shingles import mix, shingle_sets

#: Similarity at least PART / WHOLE.
PART, WHOLE = 75, 100
#: Keys that one task compares.
BUCKET_KEYS = 1_000_000
#: Keys that a map task gathers before it hands them on.
FLUSH_KEYS = 1_000_000
STAR_ROUNDS = 2
#: Values of a hash of ids that is broadcast before texts are joined by id.
ID_SLOTS = 1 << 18


def bands() -> list[int]:
    """Largest set size of each band, each at most WHOLE / PART times the one before."""
    out = [1]
    while out[-1] < 1 << 40:
        out.append(max(out[-1] + 1, out[-1] * WHOLE // PART))
    return out


BANDS = bands()


def blocks_of(upper: int) -> int:
    """Blocks of a sketch of the band up to `upper`: with so many, sets of the band
    have more non-empty blocks than shingles to differ in, with a few spare deviations."""
    return int(np.ceil(0.33 * upper + np.sqrt(upper) + 1))


def most_difference(n: int, upper: int) -> int:
    """Largest symmetric difference of a set of size n and a similar one that is no larger than `upper`."""
    partner = min(upper, n * WHOLE // PART)
    # |A xor B| <= (|A| + |B|) (1 - J) / (1 + J)
    return (n + partner) * (WHOLE - PART) // (WHOLE + PART)


def fingerprint(s: np.ndarray) -> int:
    """A number for a set of shingles."""
    total = np.cumsum(np.concatenate([mix(s ^ np.uint64(0x5BD1E995)), np.array([len(s)], np.uint64)]))[-1:]
    return int(mix(total).view(np.int64)[0])


def bit_sketch(s: np.ndarray) -> bytes:
    """Parity of the shingles that fall on each bit; a power of two of bits, at least two to a shingle."""
    bits = 64
    while bits < 2 * len(s):
        bits *= 2
    at = (s & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=bits) & 1).astype(np.uint8), bitorder="little").tobytes()


def folded(sketches: np.ndarray, words: int) -> np.ndarray:
    """Sketches (rows) of fewer bits: XOR of their halves, again and again."""
    while sketches.shape[1] > words:
        half = sketches.shape[1] // 2
        sketches = sketches[:, :half] ^ sketches[:, half:]
    return sketches


def near_enough(n: np.ndarray, m: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which pairs of sets, by their sizes and sketches (rows of equal width), can be similar."""
    d = np.bitwise_count(a ^ b).sum(axis=1, dtype=np.int64)
    return (np.minimum(n, m) * WHOLE >= np.maximum(n, m) * PART) & (d * (WHOLE + PART) <= (n + m) * (WHOLE - PART))


def keys_of(s: np.ndarray) -> np.ndarray:
    """Join keys of one set (sorted distinct hashes)."""
    n = len(s)
    if not n:
        return s
    k = bisect_left(BANDS, n)
    out, weak = [], False
    value = mix(s + np.uint64(0x9E3779B97F4A7C15))
    for band in (k, k + 1):
        if band > k and BANDS[k] + 1 > n * WHOLE // PART:
            continue
        count = blocks_of(BANDS[band])
        block = ((s >> np.uint64(32)) * np.uint64(count)) >> np.uint64(32)  # sorted like s
        first = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
        parity = np.bitwise_xor.reduceat(value, first)
        out.append(mix(parity ^ mix(block[first] + np.uint64(band << 40))))
        weak |= len(first) <= most_difference(n, BANDS[band])
    if weak:
        out.append(mix(s[: n - -(-n * PART // WHOLE) + 1] ^ np.uint64(0xD6E8FEB86659FD93)))
    return np.concatenate(out)


def _texts(column) -> list[bytes]:
    return [(t or "").encode() for t in column.to_pylist()]


def _by_size(batches, size: int = 1 << 20):
    """Slices of Arrow batches whose last column holds about `size` bytes of text."""
    for b in batches:
        at, column = 0, b.column(b.num_columns - 1)
        while at < b.num_rows:
            to, held = at, 0
            while to < b.num_rows and (to == at or held < size):
                held += len(column[to].as_py() or "")
                to += 1
            yield b.slice(at, to - at)
            at = to


def described(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, node (fingerprint of the set), n_shingles, sketch."""

    def run(batches):
        import pyarrow as pa

        for b in _by_size(batches):
            sets = shingle_sets(_texts(b.column(1)))
            yield pa.RecordBatch.from_arrays([
                b.column(0), pa.array([fingerprint(s) for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([bit_sketch(s) if len(s) else b"" for s in sets], pa.binary()),
            ], names=["doc_id", "node", "n_shingles", "sketch"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(text).alias("_text")).mapInArrow(
        run, "doc_id bigint, node bigint, n_shingles bigint, sketch binary")


def described_rows(docs: DataFrame, text: str = "text") -> DataFrame:
    """row (all columns of a document in one struct), node, n_shingles."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(text).alias("_text"))

    def run(batches):
        import pyarrow as pa

        for b in _by_size(batches):
            sets = shingle_sets(_texts(b.column(1)))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([fingerprint(s) for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int64())], names=["row", "node", "n_shingles"])

    return rows.mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}, node bigint, n_shingles bigint")


def _packed_keys(docs: DataFrame, buckets: int, text: str) -> DataFrame:
    """(bucket, keys, nodes, counts): packed join keys dealt by their upper half; of
    each run of `counts` keys, the lower halves and the node they belong to. Keys
    that only share the lower half in a bucket cost a test, no more."""

    def run(batches):
        import pyarrow as pa

        def flush(keys, nodes):
            k = np.concatenate(keys)
            v = np.repeat(np.array([x for x, _ in nodes], np.int64), [c for _, c in nodes])
            at = ((k >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(at, kind="stable")
            k, v, at = k[order], v[order], at[order]
            cut = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1], [True]]))
            lower = k.astype(np.uint32)
            packed = []
            for a, b in zip(cut[:-1], cut[1:]):
                own = v[a:b]
                run_at = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1], [True]]))
                packed.append((int(at[a]), lower[a:b].tobytes(), own[run_at[:-1]].tobytes(), np.diff(run_at).astype(np.uint32).tobytes()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[c] for x in packed], t) for c, t in enumerate((pa.int32(), pa.binary(), pa.binary(), pa.binary()))],
                names=["bucket", "keys", "nodes", "counts"])

        keys, nodes, held, seen = [], [], 0, set()
        for b in _by_size(batches):
            for s in shingle_sets(_texts(b.column(0))):
                node = fingerprint(s)
                if not len(s) or node in seen:  # a copy has the same keys
                    continue
                seen.add(node)
                keys.append(keys_of(s))
                nodes.append((node, len(keys[-1])))
                held += len(keys[-1])
                if held >= FLUSH_KEYS:
                    yield from flush(keys, nodes)
                    keys, nodes, held, seen = [], [], 0, set()
        if keys:
            yield from flush(keys, nodes)

    return docs.select(F.col(text).alias("_text")).mapInArrow(run, "bucket int, keys binary, nodes binary, counts binary")


def _shared(bucket):
    """The groups of nodes that share a key in one bucket, those with the same
    least member (by hash) as one: near copies share many keys, and their pairs
    then meet in a few groups and not once for each key."""
    import pandas as pd

    k = np.concatenate([np.frombuffer(x, np.uint32) for x in bucket["keys"]])
    v = np.concatenate([np.repeat(np.frombuffer(x, np.int64), np.frombuffer(c, np.uint32)) for x, c in zip(bucket["nodes"], bucket["counts"])])
    order = np.lexsort((mix(v.view(np.uint64)), k))  # the least member of a key comes first
    k, v = k[order], v[order]
    new = np.concatenate([[True], (k[1:] != k[:-1]) | (v[1:] != v[:-1])])
    k, v = k[new], v[new]
    same = np.concatenate([[False], k[1:] == k[:-1]])
    multi = same | np.concatenate([same[1:], [False]])
    k, v = k[multi], v[multi]
    if not len(k):
        return pd.DataFrame({"gid": np.zeros(0, np.int64), "node": np.zeros(0, np.int64)})
    first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
    least = np.repeat(v[first], np.diff(np.concatenate([first, [len(k)]])))
    order = np.lexsort((v, least))
    least, v = least[order], v[order]
    new = np.concatenate([[True], (least[1:] != least[:-1]) | (v[1:] != v[:-1])])
    return pd.DataFrame({"gid": least[new], "node": v[new]})


def _filtered(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes whose sizes and sketches allow a link."""
    side = lambda x: nodes.select(F.col("node").alias(x), F.col("n_shingles").alias(f"n_{x}"), F.col("sketch").alias(f"s_{x}"))
    sized = pairs.join(side("a"), "a").join(side("b"), "b").where(
        F.least("n_a", "n_b") * WHOLE >= F.greatest("n_a", "n_b") * PART)

    def run(batches):
        import pyarrow as pa

        for b in batches:
            n_a, n_b = b.column(2).to_numpy(), b.column(4).to_numpy()
            s_a, s_b = b.column(3).to_pylist(), b.column(5).to_pylist()
            width_a, width_b = (np.array([len(x) // 8 for x in s]) for s in (s_a, s_b))
            keep = np.zeros(b.num_rows, bool)
            for wa, wb in set(zip(width_a.tolist(), width_b.tolist())):
                at = np.flatnonzero((width_a == wa) & (width_b == wb))
                words = min(wa, wb)
                x, y = (folded(np.frombuffer(b"".join([s[i] for i in at]), np.uint64).reshape(len(at), w), words) for s, w in ((s_a, wa), (s_b, wb)))
                keep[at] = near_enough(n_a[at], n_b[at], x, y)
            pick = pa.array(keep)
            yield pa.RecordBatch.from_arrays([b.column(0).filter(pick), b.column(1).filter(pick)], names=["a", "b"])

    return sized.select("a", "b", "n_a", "s_a", "n_b", "s_b").mapInArrow(run, "a bigint, b bigint")


def _sets(wanted: DataFrame, docs: DataFrame, nodes: DataFrame, text: str) -> DataFrame:
    """node, members (packed) of the `wanted` nodes, rebuilt from one text each."""
    wanted = stage(wanted, "join-wanted")
    picked = stage(nodes.join(wanted, "node", "left_semi").where("first_doc is not null").select(F.col("first_doc").alias("doc_id")), "join-ids")
    sources = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(text).alias("_text"))
    # texts move only if the hash of their id is that of a picked one: at most ID_SLOTS values, broadcast
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(ID_SLOTS)).cast("int")
    slots = picked.select(slot.alias("slot")).distinct()
    likely = sources.withColumn("slot", slot).join(F.broadcast(slots), "slot", "left_semi").drop("slot")
    texts = likely.join(picked, "doc_id", "left_semi").unionByName(sources.where("doc_id is null")).select("_text")

    def run(batches):
        import pyarrow as pa

        for b in _by_size(batches):
            sets = [s for s in shingle_sets(_texts(b.column(0))) if len(s)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([fingerprint(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], names=["node", "members"])

    return stage(texts.mapInArrow(run, "node bigint, members binary").join(wanted, "node", "left_semi").dropDuplicates(["node"]), "join-sets")


def _verified(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, text: str) -> DataFrame:
    """Of staged pairs of nodes, those whose sets are similar."""
    sets = _sets(pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct(), docs, nodes, text)
    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("members").alias("m_a")), "a").join(
        sets.select(F.col("node").alias("b"), F.col("members").alias("m_b")), "b").select("a", "b", "m_a", "m_b")

    def test(batches):
        import pyarrow as pa

        for b in batches:
            keep = []
            for i in range(b.num_rows):
                x, y = (np.frombuffer(b.column(c)[i].as_buffer(), np.uint64) for c in (2, 3))
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(WHOLE * common >= PART * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays([b.column(0).filter(pa.array(keep)), b.column(1).filter(pa.array(keep))], names=["a", "b"])

    return both.mapInArrow(test, "a bigint, b bigint")


class Sketches:
    """Bit sketches and set sizes of some documents, as `block_links` asks for them."""

    def __init__(self, n: np.ndarray, packed: list[bytes]):
        self.n, self.width = n, np.array([len(s) // 8 for s in packed])
        self.row, self.by_width = np.zeros(len(n), np.int64), {}
        for w in np.unique(self.width):
            own = np.flatnonzero(self.width == w)
            self.row[own] = np.arange(len(own))
            self.by_width[int(w)] = np.frombuffer(b"".join([packed[i] for i in own]), np.uint64).reshape(len(own), w)

    def near(self, i: int, at: np.ndarray) -> np.ndarray:
        out = np.zeros(len(at), bool)
        mine = self.by_width[int(self.width[i])][self.row[i]][None]
        for w, held in self.by_width.items():  # the wider one of a pair is folded to the other's width
            own = np.flatnonzero(self.width[at] == w)
            if len(own):
                words, j = min(w, mine.shape[1]), at[own]
                out[own] = near_enough(self.n[i], self.n[j], folded(mine, words), folded(held[self.row[j]], words))
        return out


def _linked(docs: DataFrame, text: str) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """Staged documents (doc_id, node, n_shingles, sketch), nodes (node, first_doc, copies, ...) and labels
    (node, comp; None without links)."""
    info = stage(described(docs, text), "join-info")
    nodes = stage(
        info.where("n_shingles > 0").groupBy("node").agg(
            F.min("doc_id").alias("first_doc"), F.count(F.lit(1)).alias("copies"), F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch")),
        "join-nodes",
    )
    total = nodes.agg(F.sum("n_shingles")).first()[0] or 0
    buckets = max(1, -(-total // BUCKET_KEYS))  # a set has about 0.7 keys to a shingle
    groups = stage(
        _packed_keys(docs, buckets, text).groupBy("bucket").applyInPandas(_shared, "gid bigint, node bigint").distinct(),
        "join-groups",
    )
    labels = None
    for step in range(STAR_ROUNDS + 1):
        open_groups = groups.withColumn("comp", F.col("node"))
        if step == 1:  # of two, the members have met; larger groups are open while they span components
            groups = stage(groups.join(groups.groupBy("gid").agg(F.count(F.lit(1)).alias("n")).where("n > 2"), "gid", "left_semi"), "join-groups")
        if step:
            placed = groups.withColumn("comp", F.col("node")) if labels is None else (
                groups.join(labels, "node", "left").withColumn("comp", F.coalesce("comp", "node")))
            parted = placed.groupBy("gid").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("gid")
            open_groups = stage(placed.join(parted, "gid", "left_semi"), "join-open")
            if open_groups.isEmpty():
                break
        if step == STAR_ROUNDS:
            # what is left meets in blocks, and only links that join components come back
            more = stage(links_in_groups(open_groups.select("gid", "node", "comp"), nodes, lambda wanted: _sets(wanted, docs, nodes, text), Sketches, PART, WHOLE), "join-links")
        else:
            if step:
                centre = open_groups.groupBy("gid").agg(F.min_by(F.struct("node", "comp"), F.xxhash64("node", "gid", F.lit(step))).alias("c"))
                met = open_groups.join(centre, "gid").where(F.col("comp") != F.col("c.comp")).select("node", F.col("c.node").alias("centre"))
            else:  # the member that a group is named after
                met = groups.where("node <> gid").select("node", F.col("gid").alias("centre"))
            pairs = met.select(F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b")).distinct()
            pairs = stage(_filtered(pairs, nodes), "join-pairs")
            if pairs.isEmpty():
                continue
            more = stage(_verified(pairs, docs, nodes, text), "join-links")
        if not more.isEmpty():
            # what is known goes on as a star for each component
            known = [] if labels is None else [labels.where("node <> comp").select(F.col("node").alias("a"), F.col("comp").alias("b"))]
            labels = stage(connected_components(reduce(DataFrame.unionByName, known, more)), "join-labels")
    return info, nodes, labels


def representatives(docs: DataFrame, text: str = "text") -> DataFrame:
    """node, first_doc: of each component of distinct sets, the one with the smallest doc_id (NULL
    last; then the smallest node), and that doc_id."""
    _, nodes, labels = _linked(docs, text)
    placed = nodes.select("node", "first_doc")
    placed = placed.withColumn("comp", F.col("node")) if labels is None else placed.join(labels, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    least = F.min(F.struct(F.col("first_doc").isNull().alias("unnamed"), "first_doc", "node")).alias("least")
    return placed.groupBy("comp").agg(least).select("least.node", "least.first_doc")


def components(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest doc_id reachable by links)."""
    info, nodes, labels = _linked(docs, text)
    placed = nodes.select("node", "first_doc", "copies")
    if labels is None:
        named = placed.withColumnRenamed("first_doc", "component_id")
    else:
        placed = stage(placed.join(labels, "node", "left").withColumn("comp", F.coalesce("comp", "node")), "join-placed")
        sized = placed.groupBy("comp").agg(F.min("first_doc").alias("component_id"), F.count(F.lit(1)).alias("n_nodes"))
        named = attach_groups(placed, sized, "comp", "n_nodes", placed.count()).select("node", "component_id", "copies")
    full = info.where("n_shingles > 0").select("doc_id", "n_shingles", "node")
    linked = attach_groups(full, stage(named, "join-named"), "node", "copies", info.count())
    empty = info.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.select("doc_id", "n_shingles", "component_id").unionByName(empty)


def op6(spark, sf_dir) -> DataFrame:
    return components(table(spark, sf_dir, "documents"))

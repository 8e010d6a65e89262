"""Set similarity join along chosen paths.

A document is its set of distinct word shingles, of which a sketch keeps
SKETCH minwise tokens: the least hash of the set under each of SKETCH hash
functions. TREES independent trees branch the documents: a root hands each
document to the node of one minwise token, a node that holds too many
documents hands each of its own to BRANCHES children, by the tokens at
positions that the path chooses. Similar documents share most positions, so
they stay together on some path with high probability; others part.

Nodes of at most SMALL documents are compared exhaustively. At the roots all
members of a node are first compared with one of them (the same in all trees),
and the verified links joined to components; a node within one component is
finished, one that is dense (half of it in one component) is not branched, and
all that are left, small, dense or still large at LEVELS, are compared in
blocks (`block_links`): members of different components meet, on sketches
first and on whole sets after that, and only links that join components are
handed on. So groups of near copies cost their size, and no
node is expanded into pairs or gathered in one task.

Recall: a pair with similarity J shares a root's token with probability J, and
within a large node some child's with 1 - (1 - J)**2 a level; at J = 0.85 a
pair misses all trees with a probability of about (0.15 + 0.85 * 0.1)**8, one
in 100,000, and more similar ones far less. Sketches drop a pair that agrees
on fewer than least_agreement() positions, five deviations below its expected
agreement. Links are confirmed on the full sets.

Defined results: NULL, empty and white texts have the empty set and are linked
with nothing (component_id is their own doc_id); fewer words than a shingle
are one shingle; copies are one set, whose documents share a component; a NULL
doc_id takes part, is never a component_id unless its component has no other,
and is kept only then; rows that share a doc_id share `kept` if they share a
component; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadmill.llm.block_links import links_in_groups
from threadmill.llm.common import attach_groups, connected_components, stage, table
from threadmill.llm.shingles import mix, shingle_sets

WORDS = 3
#: Similarity at least PART / WHOLE.
PART, WHOLE = 85, 100
#: Minwise tokens of a sketch, trees, children of a large node, levels below the roots.
SKETCH, TREES, BRANCHES, LEVELS = 64, 8, 2, 4
#: Documents of a node that is compared without further branching.
SMALL = 512
#: Values of a hash of ids that is broadcast before texts are joined by id.
ID_SLOTS = 1 << 18
#: Bytes of text that a task turns into sets at a time.
SLICE_BYTES = 1 << 20

_rng = np.random.default_rng(20250712)
_FLIP = _rng.integers(1, 2**63, SKETCH, dtype=np.uint64)
_ODD = _rng.integers(1, 2**63, SKETCH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def least_agreement() -> int:
    """Positions on which sketches of linked sets agree at least, but for five deviations."""
    share = PART / WHOLE
    return int(SKETCH * share - 5 * np.sqrt(SKETCH * share * (1 - share)))


def fingerprint(s: np.ndarray) -> bytes:
    """128 bits for a set of shingles (sorted hashes)."""
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def sketch(s: np.ndarray) -> bytes:
    """The minwise tokens of a set, 32 bits each."""
    least = np.full(SKETCH, np.iinfo(np.uint64).max)
    for at in range(0, len(s), 2048):
        np.minimum(least, (((s[at : at + 2048, None] ^ _FLIP) * _ODD)).min(axis=0), out=least)
    return (mix(least) >> np.uint64(32)).astype(np.uint32).tobytes() if len(s) else b""


class Sketches:
    """Sketches and set sizes of some documents."""

    def __init__(self, n: np.ndarray, packed: list[bytes]):
        self.n, self.rows = n, np.frombuffer(b"".join(packed), np.uint32).reshape(len(packed), SKETCH)

    def near(self, i: int, at: np.ndarray) -> np.ndarray:
        agree = (self.rows[at] == self.rows[i]).sum(axis=1)
        n = self.n[at]
        return (agree >= least_agreement()) & (np.minimum(n, self.n[i]) * WHOLE >= np.maximum(n, self.n[i]) * PART)


def _slices(batches):
    """Parts of Arrow batches whose last column holds about SLICE_BYTES of text."""
    for b in batches:
        at, column = 0, b.column(b.num_columns - 1)
        while at < b.num_rows:
            to, held = at, 0
            while to < b.num_rows and (to == at or held < SLICE_BYTES):
                held += len(column[to].as_py() or "")
                to += 1
            yield b.slice(at, to - at)
            at = to


def described(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, node (the set's fingerprint), n_shingles, sketch."""

    def run(batches):
        import pyarrow as pa

        for b in _slices(batches):
            sets = shingle_sets([(t or "").encode() for t in b.column(1).to_pylist()], WORDS)
            yield pa.RecordBatch.from_arrays([
                b.column(0), pa.array([fingerprint(s) for s in sets], pa.binary()), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([sketch(s) for s in sets], pa.binary()),
            ], names=["doc_id", "node", "n_shingles", "sketch"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(text).alias("_text")).mapInArrow(
        run, "doc_id bigint, node binary, n_shingles bigint, sketch binary")


def sets_of(wanted: DataFrame, docs: DataFrame, nodes: DataFrame, text: str = "text") -> DataFrame:
    """node, members (packed): the sets of `wanted` nodes, rebuilt from one text each."""
    wanted = stage(wanted, "path-wanted")
    picked = stage(nodes.join(wanted, "node", "left_semi").where("first_doc is not null").select(F.col("first_doc").alias("doc_id")), "path-ids")
    sources = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(text).alias("_text"))
    # texts move only if the hash of their id is that of a picked one: at most ID_SLOTS values, broadcast
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(ID_SLOTS)).cast("int")
    likely = sources.withColumn("slot", slot).join(F.broadcast(picked.select(slot.alias("slot")).distinct()), "slot", "left_semi").drop("slot")
    texts = likely.join(picked, "doc_id", "left_semi").unionByName(sources.where("doc_id is null")).select("_text")

    def run(batches):
        import pyarrow as pa

        for b in _slices(batches):
            sets = [s for s in shingle_sets([(t or "").encode() for t in b.column(0).to_pylist()], WORDS) if len(s)]
            yield pa.RecordBatch.from_arrays([pa.array([fingerprint(s) for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())], names=["node", "members"])

    return stage(texts.mapInArrow(run, "node binary, members binary").join(wanted, "node", "left_semi").dropDuplicates(["node"]), "path-sets")


def _near_pairs(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes whose sizes and sketches allow a link."""
    side = lambda x: nodes.select(F.col("node").alias(x), F.col("n_shingles").alias(f"n_{x}"), F.col("sketch").alias(f"s_{x}"))
    sized = pairs.join(side("a"), "a").join(side("b"), "b").where(F.least("n_a", "n_b") * WHOLE >= F.greatest("n_a", "n_b") * PART)

    def run(batches):
        import pyarrow as pa

        for b in batches:
            x, y = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint32).reshape(b.num_rows, SKETCH) for c in (2, 3))
            pick = pa.array((x == y).sum(axis=1) >= least_agreement())
            yield pa.RecordBatch.from_arrays([b.column(0).filter(pick), b.column(1).filter(pick)], names=["a", "b"])

    return sized.select("a", "b", "s_a", "s_b").mapInArrow(run, "a binary, b binary")


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose sets are similar."""
    side = lambda x: sets.select(F.col("node").alias(x), F.col("members").alias(f"m_{x}"))

    def run(batches):
        import pyarrow as pa

        for b in batches:
            keep = []
            for i in range(b.num_rows):
                x, y = (np.frombuffer(b.column(c)[i].as_buffer(), np.uint64) for c in (2, 3))
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(WHOLE * common >= PART * (len(x) + len(y) - common))
            pick = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column(0).filter(pick), b.column(1).filter(pick)], names=["a", "b"])

    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "m_a", "m_b").mapInArrow(run, "a binary, b binary")


def _token(position) -> F.Column:
    """The minwise token at a position of the sketch."""
    return F.substring("sketch", position * 4 + 1, F.lit(4))


def roots(nodes: DataFrame) -> DataFrame:
    """path, node: the node of each tree's root that a document goes to."""
    places = F.array(*[F.lit(t * (SKETCH // TREES)) for t in range(TREES)])
    return nodes.select("node", "sketch", F.explode(places).alias("at")).select(F.xxhash64("at", _token(F.col("at"))).alias("path"), "node")


def children(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """path, node: the children of (path, node) that each document is handed to."""
    branch = F.explode(F.sequence(F.lit(1), F.lit(BRANCHES))).alias("branch")
    at = F.pmod(F.xxhash64("path", "branch"), F.lit(SKETCH)).cast("int")
    return rows.join(nodes.select("node", "sketch"), "node").select("path", "node", "sketch", branch).select(
        F.xxhash64("path", "branch", _token(at)).alias("path"), "node")


def _placed(rows: DataFrame, n_rows: int) -> DataFrame:
    """path, node, n, centre: the rows of nodes with company; the centre is the member with the least hash."""
    rows = stage(rows, "path-rows")
    groups = rows.groupBy("path").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(F.xxhash64("node").alias("h"), "node")).alias("least"))
    groups = stage(groups.where("n > 1").select("path", "n", F.col("least.node").alias("centre")), "path-groups")
    return stage(attach_groups(rows, groups, "path", "n", n_rows), "path-placed")


def _labelled(rows: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return rows.withColumn("comp", F.col("node"))
    return rows.join(labels, "node", "left").withColumn("comp", F.coalesce("comp", "node"))


def _joined(links: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Components after further links; what is known goes on as a star for each component."""
    known = [] if labels is None else [labels.where("node <> comp").select(F.col("node").alias("a"), F.col("comp").alias("b"))]
    return stage(connected_components(reduce(DataFrame.unionByName, known, links)), "path-labels")


def link_classes(docs: DataFrame, nodes: DataFrame, text: str = "text") -> DataFrame | None:
    """node, comp of the linked ones among the staged nodes (node, first_doc, n_shingles, sketch); None without links."""
    n_rows = nodes.count() * TREES
    placed = _placed(roots(nodes), n_rows)
    met = placed.where("node <> centre").select(F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b")).distinct()
    pairs = stage(_near_pairs(met, nodes), "path-pairs")
    labels, compared = None, []
    if not pairs.isEmpty():
        wanted = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
        labels = _joined(stage(_verified(pairs, sets_of(wanted, docs, nodes, text)), "path-links"), None)
    for level in range(LEVELS + 1):
        small = F.col("n") <= SMALL if level < LEVELS else F.lit(True)
        compared.append(placed.where(small).select("centre", "node"))
        large = placed.where(~small)
        if large.isEmpty():
            break
        parts = _labelled(large.select("path", "node"), labels).groupBy("path", "comp").agg(F.count(F.lit(1)).alias("n"))
        kinds = stage(parts.groupBy("path").agg(F.count(F.lit(1)).alias("parts"), F.max("n").alias("most"), F.sum("n").alias("n")), "path-kinds")
        dense = F.col("most") * 2 >= F.col("n")
        told = attach_groups(large.select("path", "centre", "node"), kinds, "path", "n", n_rows)
        compared.append(told.where(dense & (F.col("parts") > 1)).select("centre", "node"))
        placed = _placed(children(told.where(~dense).select("path", "node"), nodes), n_rows)
    # nodes of several trees that have one centre are compared as one
    groups = _labelled(reduce(DataFrame.unionByName, compared).select(F.col("centre").alias("gid"), "node").distinct(), labels)
    groups = stage(groups, "path-compared")
    parted = groups.groupBy("gid").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("n")).where("lo <> hi and n > 2").select("gid")
    still = stage(groups.join(parted, "gid", "left_semi"), "path-open")
    if still.isEmpty():
        return labels
    links = stage(links_in_groups(still, nodes, lambda wanted: sets_of(wanted, docs, nodes, text), Sketches, PART, WHOLE), "path-links")
    return labels if links.isEmpty() else _joined(links, labels)


def components(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest doc_id reachable by links), kept."""
    info = stage(described(docs, text), "path-info")
    full = info.where("n_shingles > 0")
    nodes = stage(
        full.groupBy("node").agg(F.min("doc_id").alias("first_doc"), F.count(F.lit(1)).alias("copies"), F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch")),
        "path-nodes")
    labels = link_classes(docs, nodes, text)
    placed = stage(_labelled(nodes.select("node", "first_doc", "copies"), labels), "path-classes")
    sized = placed.groupBy("comp").agg(F.min("first_doc").alias("component_id"), F.count(F.lit(1)).alias("n_nodes"))
    named = attach_groups(placed, sized, "comp", "n_nodes", placed.count()).select("node", "component_id", "copies")
    linked = attach_groups(full.select("doc_id", "n_shingles", "node"), stage(named, "path-named"), "node", "copies", info.count())
    empty = info.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.select("doc_id", "n_shingles", "component_id").unionByName(empty).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def op12(spark, sf_dir) -> DataFrame:
    return components(table(spark, sf_dir, "documents"))

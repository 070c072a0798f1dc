"""Merkle manifest of a dataset: a tree of three-way nodes per source, and one over the sources' roots.

A leaf is the hash of a row's fields, each as its length and value.  While a level has several nodes, every three
consecutive ones (the last run may have fewer, even one) become their hash.

Builders take aligned runs of ``3 ** LEVELS`` nodes of one tree and append what they make in the order in
which nodes are completed, which is postorder.  Where a node stands in such a log follows from the sizes of subtrees
alone (``position``), so siblings are read by their address and no pointers are stored.  Roots of builders' runs are the
input of the next stratum; a tree of n leaves has about log3(n) / LEVELS strata.  Proofs go the other way: the path of
a run's root is made once and handed down to what lies below it.  A task holds one run of one stratum at a time, whatever
a source's share of the rows.

The log is a table in the shared folder (``manifest``): tree, stratum, block, first (place of the run's first node in the
tree's whole postorder, for stratum 0), n_leaves, last (whether the run's root is the tree's) and nodes, 32 bytes each.
``proof`` reads from it the siblings of one leaf, a run per stratum.

Nulls in any field are a value of their own.  Rows without an id come first in their source and aren't tampered with; rows
of one id follow each other in the order of their leaves, and repeated rows each have a leaf and a row of the result.
Empty texts are values of length 0, long ones are hashed whole.  An empty table has no nodes and gives no rows.  Columns
besides the five are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import new_folder, stored, tasks_for

ARITY = 3

#: Levels that a builder makes of its run of ARITY ** LEVELS nodes.
LEVELS = 6

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


# Places.


def height(n: int) -> int:
    """Levels above n leaves."""
    h = 0
    while n > 1:
        n, h = -(-n // ARITY), h + 1
    return h


def position(level: int, index, n: int, top: int):
    """Places of nodes ``index`` of ``level`` in the postorder of a tree with n leaves and ``top`` levels above them: the
    nodes that are complete with the node's last leaf, its own level and those below counted to that leaf, those above
    to the leaf before."""
    end = np.minimum((np.asarray(index, dtype=np.int64) + 1) * ARITY**level, n)
    below = sum(-(-end // ARITY**m) for m in range(level + 1))
    return below + sum((end - 1) // ARITY**m for m in range(level + 1, top + 1)) - 1


def size(n: int, top: int) -> int:
    """Nodes of such a tree, leaves included."""
    return sum(-(-n // ARITY**m) for m in range(top + 1))


# Nodes and paths.


def node_hash(parts: list[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def grow(leaves: list[str], top: int) -> bytes:
    """The nodes over leaves in the order of their completion."""
    n, level = len(leaves), leaves
    out = np.empty((size(n, top), 32), dtype=np.uint8)
    for m in range(top + 1):
        out[position(m, np.arange(len(level)), n, top)] = np.frombuffer(bytes.fromhex("".join(level)), dtype=np.uint8).reshape(-1, 32)
        if m < top:
            level = [node_hash(level[a : a + ARITY]) for a in range(0, len(level), ARITY)]
    return out.tobytes()


def levels_of(nodes: bytes, n: int, top: int) -> list[list[str]]:
    """The levels of a log below its root, read by address."""
    table = np.frombuffer(nodes, dtype=np.uint8).reshape(-1, 32)
    out = []
    for m in range(top):
        text = table[position(m, np.arange(-(-n // ARITY**m)), n, top)].tobytes().hex()
        out.append([text[a : a + 64] for a in range(0, len(text), 64)])
    return out


def siblings(level: list[str], j: int) -> tuple[list[str], list[str]]:
    """The others of a node's run, left and right of it."""
    a = j - j % ARITY
    return level[a:j], level[j + 1 : a + ARITY]


def pack(steps: list[tuple[list[str], list[str]]]) -> bytes:
    """A path, a byte (how many siblings are left and right) and the siblings for each level."""
    return b"".join(bytes([len(left) * 16 + len(right)]) + bytes.fromhex("".join(left + right)) for left, right in steps)


def unpack(path: bytes) -> list[tuple[str, str]]:
    """The siblings' digests left and right, joined, for each level."""
    out, at = [], 0
    while at < len(path):
        left, right = divmod(path[at], 16)
        text = path[at + 1 : at + 1 + 32 * (left + right)].hex()
        out.append((text[: 64 * left], text[64 * left :]))
        at += 1 + 32 * (left + right)
    return out


def fold(leaf: str, path: list[tuple[str, str]]) -> str:
    """The root that a leaf and its path give."""
    for left, right in path:
        leaf = hashlib.sha256((left + leaf + right).encode()).hexdigest()
    return leaf


# Leaves in order.


def _field(c: Column) -> Column:
    c = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-"))


def leaf_hash(text: Column) -> Column:
    """The digest of a row with the given text."""
    return F.unhex(F.sha2(F.concat(*[_field(F.col(c)) for c in FIELDS[:-1]], _field(text)), 256))


def _tree(source: Column) -> Column:
    """A tree's name: sorts as sources do, null first."""
    return F.coalesce(F.concat(F.lit("="), source), F.lit(""))


def leaves_of(docs: DataFrame, tampered: Column, tampered_text: Column) -> DataFrame:
    """(tree, doc_id, leaf, other): other is the leaf of a tampered row whose text has changed, else null."""
    other = F.when(tampered & ~F.col("text").eqNullSafe(tampered_text), leaf_hash(tampered_text))
    return docs.select(_tree(F.col("source")).alias("tree"), "doc_id", leaf_hash(F.col("text")).alias("leaf"), other.alias("other"))


def numbered(rows: DataFrame, order: list[str], label: str, n_bytes: int) -> DataFrame:
    """Rows with ``index``, their place in their tree from 0 in the given order.

    Rows are dealt out by ranges of tree and order and counted per range and tree; what earlier ranges have of a tree is
    added to the place in the range.  Rows with equal keys are told apart by where they stand in the table, so that
    copies of one row aren't all in one range."""
    spark = rows.sparkSession
    keys = ["tree", *order, "_tie"]
    ranged = rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(tasks_for(spark, n_bytes, 16 << 20), *keys).sortWithinPartitions(*keys)
    # The place within the range, in steps of one: monotonically_increasing_id has the range in its upper bits.
    ranged = ranged.withColumn("_place", F.monotonically_increasing_id())
    ranged = stored(ranged.withColumn("_range", F.shiftright("_place", 33).cast("int")).withColumn("_place", F.col("_place").bitwiseAND((1 << 33) - 1)).drop("_tie"), label)
    parts = ranged.groupBy("_range", "tree").agg(F.min("_place").alias("_from"), F.count("*").alias("_n"))
    before = F.coalesce(F.expr("sum(_n) OVER (PARTITION BY tree ORDER BY _range ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"), F.lit(0))
    parts = stored(parts.select("_range", "tree", (before - F.col("_from")).alias("_shift")), label + "-ranges")  # so that its size is known before the join
    return ranged.join(parts, ["_range", "tree"]).withColumn("index", F.col("_place") + F.col("_shift")).drop("_range", "_place", "_shift")


# Builders.

_LOG = "tree string, block bigint, first bigint, n_leaves int, last boolean, nodes binary"


def _top(n: int, last: bool, levels: int) -> int:
    """Levels above a run of n nodes: a tree's last run ends with its root."""
    return height(n) if last else levels


def _builder(stratum: int, levels: int):
    """A builder's run: nodes (index, leaf, n: nodes of the whole tree in this stratum) to a segment of the log."""

    def run(key: tuple, nodes: pa.Table) -> pa.Table:
        nodes = nodes.sort_by("index")
        n, of_tree, block = nodes.num_rows, nodes.column("n")[0].as_py(), key[1].as_py()
        last, begin = of_tree <= ARITY**levels, block * ARITY**levels
        log = grow([x.hex() for x in nodes.column("leaf").to_pylist()], _top(n, last, levels))
        # Nodes that are complete before the run's first leaf.
        first = sum(begin // ARITY**m for m in range(height(of_tree) + 1)) if stratum == 0 else None
        return pa.table({"tree": [key[0].as_py()], "block": [block], "first": pa.array([first], pa.int64()), "n_leaves": pa.array([n], pa.int32()), "last": [last], "nodes": [log]})

    return run


@dataclass
class Manifest:
    """The log's folder, the strata that it has and the levels of a run."""

    spark: SparkSession
    folder: str
    strata: int
    levels: int

    def log(self, stratum: int) -> DataFrame:
        return self.spark.read.schema(_LOG).parquet(f"{self.folder}/stratum={stratum}")

    def roots(self) -> DataFrame:
        """(tree, root)."""
        every = [self.log(s).where("last").select("tree", F.expr("substring(nodes, -32, 32)").alias("root")) for s in range(self.strata)]
        out = every[0]
        for more in every[1:]:
            out = out.unionByName(more)
        return out


def build(leaves: DataFrame, counts: DataFrame, label: str, levels: int = LEVELS) -> Manifest:
    """The log of trees.  ``leaves`` has tree, index and leaf, ``counts`` the number of leaves (n) per tree."""
    spark, folder, stratum, block = leaves.sparkSession, new_folder(leaves.sparkSession, label), 0, ARITY**levels
    most = counts.agg(F.max("n")).first()[0] or 0
    nodes = leaves.select("tree", "index", "leaf").join(counts, "tree")
    while True:
        runs = nodes.groupBy("tree", F.expr(f"index div {block}").alias("block"))
        runs.applyInArrow(_builder(stratum, levels), _LOG).write.parquet(f"{folder}/stratum={stratum}")
        stratum += 1
        manifest = Manifest(spark, folder, stratum, levels)
        if most <= block:
            return manifest
        most = -(-most // block)
        roots = manifest.log(stratum - 1).where("not last").select("tree", F.col("block").alias("index"), F.expr("substring(nodes, -32, 32)").alias("leaf"))
        nodes = roots.join(counts.select("tree", F.expr(f"(n + {block**stratum - 1}) div {block**stratum}").alias("n")), "tree")


def _paths_of(nodes: bytes, n: int, top: int) -> list[bytes]:
    """Packed paths of a run's nodes to its root."""
    levels = levels_of(nodes, n, top)
    return [pack([siblings(level, i // ARITY**m) for m, level in enumerate(levels)]) for i in range(n)]


def _hand_down(levels: int):
    """Segments with their root's path to a path for each node of the run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                paths = [p + (r["path"] or b"") for p in _paths_of(r["nodes"], r["n_leaves"], _top(r["n_leaves"], r["last"], levels))]
                begin = r["block"] * ARITY**levels
                yield pa.RecordBatch.from_pydict({"tree": [r["tree"]] * len(paths), "block": list(range(begin, begin + len(paths))), "path": paths})

    return run


def block_paths(manifest: Manifest, above: DataFrame | None) -> DataFrame:
    """(tree, block, path): the path from the root of each run of stratum 0 upwards.  ``above`` has the tree and the path
    of the tree's own root, if that isn't the end."""
    spark, schema = manifest.spark, "tree string, block bigint, path binary"
    down = spark.createDataFrame([], schema)
    for s in range(manifest.strata - 1, -1, -1):
        log = manifest.log(s)
        ends = log.where("last").select("tree", "block")
        ends = ends.join(above, "tree", "left") if above is not None else ends.withColumn("path", F.lit(b""))
        down = down.unionByName(ends.select("tree", "block", "path"))
        if s:
            down = stored(log.join(down, ["tree", "block"], "left").mapInArrow(_hand_down(manifest.levels), schema), "merkle-paths")
    return down


_PROVEN = "tree string, doc_id {id}, leaf string, proof_sha256 string, folded_root string"


def _prover(levels: int):
    """Paths and folded roots of the leaves of one run of stratum 0."""

    def run(key: tuple, leaves: pa.Table, logs: pa.Table) -> pa.Table:
        leaves, log = leaves.sort_by("index"), logs.to_pylist()[0]
        n, top = log["n_leaves"], _top(log["n_leaves"], log["last"], levels)
        steps = [[("".join(a), "".join(b)) for a, b in (siblings(level, j) for j in range(len(level)))] for level in levels_of(log["nodes"], n, top)]
        rest = unpack(log["path"] or b"")
        tail = "".join(a + b for a, b in rest)
        proofs, folded, names = [], [], [x.hex() for x in leaves.column("leaf").to_pylist()]
        for i, (own, other) in enumerate(zip(names, leaves.column("other").to_pylist(), strict=True)):
            path = [step[i // ARITY**m] for m, step in enumerate(steps)]
            proofs.append(hashlib.sha256(("".join(a + b for a, b in path) + tail).encode()).hexdigest())
            folded.append(fold(other.hex() if other is not None else own, path + rest))
        return pa.table({"tree": leaves.column("tree"), "doc_id": leaves.column("doc_id"), "leaf": names, "proof_sha256": proofs, "folded_root": folded})

    return run


def merkle_manifest(docs: DataFrame, tampered: Column | None = None, tampered_text: Column | None = None, levels: int = LEVELS) -> tuple[DataFrame, Manifest, Manifest]:
    """(rows, the sources' log, the log over them).  A row per document: doc_id, leaf, subroot, root, proof_sha256 (digest of
    the siblings from leaf to root), folded_root (from the leaf, where ``tampered`` is true that of ``tampered_text``, and
    the original siblings) and verified."""
    spark = docs.sparkSession
    docs = docs.select(*FIELDS)
    leaves = stored(leaves_of(docs, F.lit(False) if tampered is None else F.coalesce(tampered, F.lit(False)), F.col("text") if tampered_text is None else tampered_text), "merkle-leaves")
    leaves = stored(numbered(leaves, ["doc_id", "leaf"], "merkle-order", 100 * leaves.count()), "merkle-numbered")
    counts = stored(leaves.groupBy("tree").agg(F.count("*").alias("n")), "merkle-trees")
    low = build(leaves, counts, "merkle-log", levels)
    subroots = stored(low.roots(), "merkle-subroots")
    # The sources' roots are the leaves of one more tree.
    trees = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("root").alias("leaf"))
    trees = stored(numbered(trees, ["name"], "merkle-sources", 100 * subroots.count()), "merkle-tops")
    high = build(trees, stored(trees.groupBy("tree").agg(F.count("*").alias("n")), "merkle-tops-count"), "merkle-top-log", levels)
    root = high.roots().select(F.lower(F.hex("root")).alias("root")).first()  # a row, or none
    runs = high.log(0).join(block_paths(high, None), ["tree", "block"], "left").mapInArrow(_hand_down(levels), "tree string, block bigint, path binary")
    above = stored(trees.join(runs.select(F.col("block").alias("index"), "path"), "index").select(F.col("name").alias("tree"), "path"), "merkle-source-paths")
    logs = low.log(0).join(block_paths(low, above), ["tree", "block"], "left")
    schema = _PROVEN.format(id=leaves.schema["doc_id"].dataType.simpleString())
    proven = leaves.withColumn("block", F.expr(f"index div {ARITY**levels}")).groupBy("tree", "block").cogroup(logs.groupBy("tree", "block")).applyInArrow(_prover(levels), schema)
    out = proven.join(subroots.select("tree", F.lower(F.hex("root")).alias("subroot")), "tree").withColumn("root", F.lit(root.root if root else None).cast("string"))
    return out.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified")), low, high


def proof(manifest: Manifest, tree: str, index: int) -> list[tuple[str, str]]:
    """The siblings (left and right) of one leaf up to its tree's root: a run of the log is read for each stratum."""
    out = []
    for s in range(manifest.strata):
        block, inside = divmod(index, ARITY**manifest.levels)
        rows = manifest.log(s).where((F.col("tree") == tree) & (F.col("block") == block)).collect()  # one run
        if not rows:
            raise KeyError(f"no leaf {index} in the tree {tree!r}")
        r = rows[0]
        out += unpack(_paths_of(bytes(r.nodes), r.n_leaves, _top(r.n_leaves, r.last, manifest.levels))[inside])
        if r.last:
            break
        index = block
    return out

"""Merkle manifest of a table of documents, kept as a postorder append log.

Every row is a leaf; the leaves of a language, in order, are the tree of that
language, and the subroots of all languages are the leaves of one more tree.
A tree is cut into aligned blocks of ``FAN ** LEVELS`` leaves. One builder
takes each block and appends nodes to its log in the order in which they are
completed: a leaf when it comes, a parent right after its last child. So a
node's place in the log follows from the sizes of the subtrees before it
(``position``), and the siblings that a proof needs are read from their
places, without a search. The builders' topmost nodes are the leaves of the
next round's builders, until a tree has one builder left. Proofs go the other
way: each builder gets the path above its topmost node and hands to each of
its leaves that path with its own part in front.

Spark orders the leaves (a range partitioning, ranks within partitions, sums
of counts before them), groups them by block, and cogroups logs with the
paths above. A task holds one block at a time, however large a tree is.

Defined results: nulls in any column are ``-`` in a leaf. Leaves of a language
ascend by doc_id, null last, then by digest, so repeated rows are leaves of
their own, next to each other. A null language is a language of its own and
the first. A null doc_id has no checksum, so nothing is tampered with there.
Empty text is a value of 0 bytes; texts of any length are hashed whole. Other
columns don't matter. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenmill.llm.scratch import LAST_ID, materialise

FAN = 8
LEVELS = 3  # levels that a builder adds; it takes FAN ** LEVELS leaves
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_PATH = "array<struct<before:string,after:string>>"


# the log of one builder -------------------------------------------------------

def parent(children: list[str]) -> str:
    return hashlib.sha256("".join(children).encode()).hexdigest()


def height(n: int) -> int:
    """Levels above the n leaves of a tree."""
    levels = 0
    while FAN ** levels < n:
        levels += 1
    return levels


def append_log(leaves: list[str], levels: int) -> list[str]:
    """All nodes of up to FAN ** levels leaves, in the order of completion."""
    log: list[str] = []
    waiting: list[list[str]] = [[] for _ in range(levels + 1)]

    def append(level: int, node: str) -> None:
        log.append(node)
        waiting[level].append(node)
        if level < levels and len(waiting[level]) == FAN:
            complete(level)

    def complete(level: int) -> None:
        run, waiting[level] = waiting[level], []
        append(level + 1, parent(run))

    for leaf in leaves:
        append(0, leaf)
    for level in range(levels):
        if waiting[level]:
            complete(level)
    return log


def position(n: int, levels: int, level: int, index: int) -> int:
    """Where the log of n leaves has node ``index`` of a level: after all that
    was complete when its first leaf came, at the end of its own subtree."""
    first = index * FAN ** level
    own = min(FAN ** level, n - first)
    before = sum(first // FAN ** k for k in range(levels + 1))
    return before + sum(-(-own // FAN ** k) for k in range(level + 1)) - 1


def sibling_pairs(log: list[str], n: int, levels: int) -> list[list[tuple[str, str]]]:
    """For each level and node: its siblings to the left and to the right."""
    out = []
    for level in range(levels):
        nodes = [log[position(n, levels, level, j)] for j in range(-(-n // FAN ** level))]
        pairs = []
        for j in range(len(nodes)):
            lo = j - j % FAN
            pairs.append(("".join(nodes[lo:j]), "".join(nodes[j + 1:lo + FAN])))
        out.append(pairs)
    return out


def fold(node: str, path: list[tuple[str, str]]) -> str:
    """The root that a leaf and its siblings, level by level, lead to."""
    for before, after in path:
        node = hashlib.sha256((before + node + after).encode()).hexdigest()
    return node


# order ------------------------------------------------------------------------

def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``at``, the place (from 0) within their ``tree`` in the
    given order, and ``n``, the tree's size. One range partitioning; ranks
    come from the sorted partitions and the counts of those before."""
    keys = ["tree", *order]
    ranked = materialise(rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_rank", F.monotonically_increasing_id()), "merkle-order")
    ranked = ranked.withColumn("_part", F.shiftright("_rank", 33))
    counts = ranked.groupBy("tree", "_part").agg(F.min("_rank").alias("_first"), F.count("*").alias("_n"))
    tree = Window.partitionBy("tree")
    before = tree.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).withColumn("n", F.sum("_n").over(tree))
    return (ranked.join(offsets, ["tree", "_part"])
            .withColumn("at", F.col("_rank") - F.col("_first") + F.col("_before")).select(*rows.columns, "at", "n"))


# builders ---------------------------------------------------------------------

def _builders(rows: DataFrame, extra: list[str], levels: int) -> DataFrame:
    """One row per aligned block of (tree, at, n, node, *extra): its log, its
    topmost node, and the extra columns as lists in the order of the leaves."""
    types = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    fields = "tree string, builder long, n long, log array<string>, top string" + "".join(f", {c} array<{types[c]}>" for c in extra)

    def run(key, block):
        block = block.take(pc.sort_indices(block, sort_keys=[("at", "ascending")]))
        n = block["n"][0].as_py()
        log = append_log(block["node"].to_pylist(), min(levels, height(n)))
        lists = [pa.array([block[c].to_pylist()], pa.list_(block.schema.field(c).type)) for c in extra]
        return pa.Table.from_arrays(
            [pa.array([key[0].as_py()], pa.string()), pa.array([key[1].as_py()], pa.int64()), pa.array([n], pa.int64()), pa.array([log], pa.list_(pa.string())),
             pa.array([log[-1]], pa.string()), *lists], names=["tree", "builder", "n", "log", "top", *extra])

    blocks = rows.select("tree", F.floor(F.col("at") / FAN ** levels).alias("builder"), "at", "n", "node", *extra)
    return blocks.groupBy("tree", "builder").applyInArrow(run, fields)


def build(rows: DataFrame, extra: list[str], levels: int = LEVELS) -> list[DataFrame]:
    """The written logs, round by round. A tree's last round is the one where
    it has one builder (its ``n`` is at most a block); there ``top`` is its root."""
    block = FAN ** levels
    rounds: list[DataFrame] = []
    while True:
        logs = materialise(_builders(rows, [] if rounds else extra, levels), "merkle-log")
        rounds.append(logs)
        if (logs.agg(F.max("n")).first()[0] or 0) <= block:
            return rounds
        rows = logs.where(F.col("n") > block).select(
            "tree", F.col("builder").alias("at"), F.ceil(F.col("n") / block).alias("n"), F.col("top").alias("node"))


def roots(rounds: list[DataFrame], levels: int = LEVELS) -> DataFrame:
    """(tree, node): the root of every tree."""
    found = [logs.where(F.col("n") <= FAN ** levels).select("tree", F.col("top").alias("node")) for logs in rounds]
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out


# proofs -----------------------------------------------------------------------

def _block_paths(logs: pa.Table, above: pa.Table, most: int):
    """The log's leaves, and for each its path up to the root."""
    n, builder = logs["n"][0].as_py(), logs["builder"][0].as_py()
    levels = min(most, height(n))
    m = min(FAN ** most, n - builder * FAN ** most)
    log = logs["log"][0].as_py()
    pairs = sibling_pairs(log, m, levels)
    upper = [(p["before"], p["after"]) for p in above["path"][0].as_py()]
    leaves = [log[position(m, levels, 0, i)] for i in range(m)]
    paths = [[pairs[level][i // FAN ** level] for level in range(levels)] + upper for i in range(m)]
    return leaves, paths, builder


def _down(logs: DataFrame, above: DataFrame, levels: int) -> DataFrame:
    """(tree, builder, path, subroot, root) for the builders one round below:
    the leaves of ``logs``, whose builders' own paths are ``above``."""
    def run(key, left, right):
        if not left.num_rows:
            paths, first = [], 0
        else:
            _, paths, builder = _block_paths(left, right, levels)
            first = builder * FAN ** levels
        m = len(paths)
        path_type = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))
        ends = [right[c][0].as_py() if m else None for c in ("subroot", "root")]
        return pa.Table.from_arrays(
            [pa.array([key[0].as_py()] * m, pa.string()), pa.array(range(first, first + m), pa.int64()),
             pa.array([[{"before": b, "after": a} for b, a in p] for p in paths], path_type), *(pa.array([e] * m, pa.string()) for e in ends)],
            names=["tree", "builder", "path", "subroot", "root"])

    return (logs.groupBy("tree", "builder").cogroup(above.groupBy("tree", "builder"))
            .applyInArrow(run, f"tree string, builder long, path {_PATH}, subroot string, root string"))


def _paths_of_builders(rounds: list[DataFrame], ends: DataFrame, levels: int) -> DataFrame:
    """(tree, builder, path, subroot, root) for the builders of the first
    round; ``ends`` has path, subroot and root of each whole tree."""
    below = None
    for logs in reversed(rounds):
        last = logs.where(F.col("n") <= FAN ** levels).select("tree", "builder").join(ends, "tree").select("tree", "builder", "path", "subroot", "root")
        above = materialise(last if below is None else last.unionByName(below), "merkle-above")
        if logs is rounds[0]:
            return above
        below = materialise(_down(logs, above, levels), "merkle-paths")
    raise AssertionError("a manifest has a first round")


def _proofs(logs: DataFrame, above: DataFrame, levels: int) -> DataFrame:
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]

    def run(key, left, right):
        rows = []
        if left.num_rows:
            leaves, paths, _ = _block_paths(left, right, levels)
            subroot, root = right["subroot"][0].as_py(), right["root"][0].as_py()
            for doc_id, leaf, changed, path in zip(left["ord"][0].as_py(), leaves, left["changed"][0].as_py(), paths, strict=True):
                proof = hashlib.sha256("".join([s for pair in path for s in pair]).encode()).hexdigest()
                folded = fold(changed or leaf, path)
                rows.append((None if doc_id == LAST_ID else doc_id, leaf, subroot, root, proof, folded, folded == root))
        types = [pa.int64(), *[pa.string()] * 5, pa.bool_()]
        return pa.Table.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=names)

    return (logs.groupBy("tree", "builder").cogroup(above.groupBy("tree", "builder"))
            .applyInArrow(run, "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"))


# the manifest -----------------------------------------------------------------

def leaf_digest(columns: dict[str, Column]) -> Column:
    """sha256 of the fields, each ``-`` if null, else bytes, colon, value."""
    parts = []
    for name in FIELDS:
        value = columns[name].cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def _leaves(docs: DataFrame) -> DataFrame:
    """(tree, ord, node, changed): ``changed`` is the leaf after tampering,
    null where nothing is tampered with."""
    own = {c: F.col(c) for c in FIELDS}
    hit = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) == 0
    lowered = leaf_digest({**own, "text": F.translate("text", UPPER, UPPER.lower())})
    # '' < '=...': the null language first, the others by their bytes
    return docs.select(F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit("")).alias("tree"), F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("ord"),
                       leaf_digest(own).alias("node"), F.when(hit, lowered).alias("changed"))


def manifest(docs: DataFrame, levels: int = LEVELS) -> tuple[list[DataFrame], list[DataFrame], DataFrame]:
    """The logs of the languages' trees, those of the tree of subroots, and
    (tree, name, node, at, n) of the subroots. A builder takes
    ``FAN ** levels`` leaves; that changes no digest."""
    leaves = materialise(_leaves(docs).withColumn("row_id", F.monotonically_increasing_id()), "merkle-leaves")
    rounds = build(numbered(leaves, ["ord", "node", "row_id"]), ["ord", "changed"], levels)
    top = roots(rounds, levels).select(F.lit("").alias("tree"), F.col("tree").alias("name"), "node")
    subroots = numbered(top, ["name"])
    return rounds, build(subroots, [], levels), subroots


def prove(docs: DataFrame, levels: int = LEVELS) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified."""
    rounds, top_rounds, subroots = manifest(docs, levels)
    whole = roots(top_rounds, levels).select("tree", F.array().cast(_PATH).alias("path"), F.lit("").alias("subroot"), F.col("node").alias("root"))
    top_paths = _down(top_rounds[0], _paths_of_builders(top_rounds, whole, levels), levels)
    ends = (subroots.select("at", F.col("name").alias("tree"), F.col("node").alias("sub"))
            .join(top_paths.select(F.col("builder").alias("at"), "path", "root"), "at").select("tree", "path", F.col("sub").alias("subroot"), "root"))
    return _proofs(rounds[0], _paths_of_builders(rounds, materialise(ends, "merkle-ends"), levels), levels)

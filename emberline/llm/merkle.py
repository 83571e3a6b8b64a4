"""Merkle manifest of a table: a tree of hashes per group of rows, a tree over the groups, and a proof for every row.

Rows become leaves, numbered in their group; blocks of FANOUT ** LEVELS consecutive leaves are whole subtrees and are
worked out each by itself. From there on blocks swap roots in a butterfly: in each round, FANOUT neighbouring nodes
come together once for every slot (a block's place within its node), so that each block of a node meets one block of
each sibling, learns their roots, and hashes the parent again for itself. After the last round every block holds the
root and the siblings on its way to it: nothing has to be handed down. No meeting has more than FANOUT members; a
smaller node at the edge sends its root to the slots that it has no blocks for.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emberline.functions.storage import materialize
from emberline.llm.common import arrow_schema
from emberline.llm.ranks import ranked

FANOUT = 8
#: Levels within a block: 512 leaves.
LEVELS = 3

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_STEPS = "array<struct<left:string,right:string>>"


def leaf_hash(*values: Column) -> Column:
    """SHA-256 of the values' texts: ``-`` for NULL, else the number of UTF-8 bytes, a colon and the text."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-"))
                             for t in texts]), 256)


def _hash(nodes: list[str]) -> str:
    return hashlib.sha256("".join(nodes).encode()).hexdigest()


def _subtree(leaves: list[str], levels: int) -> list[list[str]]:
    """The nodes of each level, the leaves first."""
    tree = [leaves]
    for _ in range(levels):
        tree.append([_hash(tree[-1][i:i + FANOUT]) for i in range(0, len(tree[-1]), FANOUT)])
    return tree


def _height(n: int, most: int) -> int:
    """Levels above n leaves up to the root of their block, ``most`` at most."""
    levels = 0
    while n > 1 and levels < most:
        n, levels = -(-n // FANOUT), levels + 1
    return levels


def _block_roots(blocks: DataFrame, levels: int) -> DataFrame:
    """(tree, block, root) of each block (tree, block, n_leaves, leaves)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tree, block, n, leaves = (c.to_pylist() for c in batch.columns)
            roots = [_subtree(own, _height(total, levels))[-1][0] for own, total in zip(leaves, n)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(roots, pa.string())],
                                             ["tree", "block", "root"])

    leaves = F.transform("rows", lambda r: r["leaf"])
    return blocks.select("tree", "block", "n_leaves", leaves.alias("leaves")).mapInArrow(
        run, "tree long, block long, root string")


def _swap(blocks: DataFrame, groups: list[str]) -> DataFrame:
    """One round: (``groups``, node, slot, slots, root, steps, own) with ``node`` now that of the parent.

    ``slots`` are the blocks of the node, ``most`` (of the input only) those of its largest sibling.
    """
    parent = F.floor(F.col("node") / FANOUT).cast("long")
    # A block fills its own slot and, where its node is small, those that its node has no block for.
    sent = blocks.withColumn("parent", parent).withColumn("to", F.explode(F.sequence("slot", F.col("most") - 1, "slots")))
    member = F.struct("node", "root", "slots", "slot", "steps", "own")
    met = sent.groupBy(*groups, "parent", "to").agg(F.sort_array(F.collect_list(member)).alias("met"))  # FANOUT at most
    at_home = met.select("*", F.posexplode("met").alias("place", "me")).filter(F.col("me.slot") == F.col("to"))
    roots = F.transform("met", lambda m: m["root"])
    place, me = F.col("place"), F.col("me")
    step = F.struct(F.array_join(F.slice(roots, F.lit(1), place), "").alias("left"),
                    F.array_join(F.slice(roots, place + 2, F.lit(FANOUT)), "").alias("right"))
    earlier = F.aggregate(F.slice("met", F.lit(1), place), F.lit(0).cast("long"), lambda n, m: n + m["slots"])
    return at_home.select(
        *groups, F.col("parent").alias("node"), (earlier + me["slot"]).alias("slot"),
        F.aggregate("met", F.lit(0).cast("long"), lambda n, m: n + m["slots"]).alias("slots"),
        F.sha2(F.array_join(roots, ""), 256).alias("root"), F.concat(me["steps"], F.array(step)).alias("steps"), me["own"].alias("own"))


def _group_tree(trees: DataFrame, n_trees: int) -> tuple[DataFrame, int]:
    """(tree, widths): the blocks of the largest sibling of the tree's node, in each round above the trees."""
    rounds, nodes, found = 0, n_trees, trees.select("tree", F.array().cast("array<bigint>").alias("widths"))
    widths = trees.select(F.col("tree").alias("node"), F.col("n_blocks").alias("slots"))
    while nodes > 1:
        above = widths.groupBy(F.floor(F.col("node") / FANOUT).cast("long").alias("node")).agg(
            F.max("slots").alias("most"), F.sum("slots").alias("slots"))
        up = F.floor(F.col("tree") / FANOUT ** (rounds + 1)).cast("long")
        found = found.join(above.select("node", "most"), up == F.col("node")).select(
            "tree", F.concat("widths", F.array("most")).alias("widths"))
        widths, nodes, rounds = above.select("node", "slots"), -(-nodes // FANOUT), rounds + 1
    return found, rounds


def _upper(roots: DataFrame, trees: DataFrame, n_trees: int, longest: int) -> DataFrame:
    """(tree, block, subroot, root, steps) for every block: all rounds from the block's root up."""
    widths, rounds = _group_tree(trees, n_trees)
    at = materialize(roots.join(trees, "tree").select(
        "tree", F.col("block").alias("node"), F.lit(0).cast("long").alias("slot"), F.lit(1).cast("long").alias("slots"), "root",
        F.array().cast(_STEPS).alias("steps"), F.struct("tree", "block", "n_blocks", F.lit(None).cast("string").alias("subroot")).alias("own")),
        "merkle-round")
    size = 1
    while size < longest:
        first = F.floor(F.col("node") / FANOUT) * FANOUT * size  # the run's first node is its largest
        most = F.least(F.lit(size), F.col("own.n_blocks") - first).cast("long")
        done = F.col("own.n_blocks") <= size
        swapped = _swap(at.filter(~done).withColumn("most", most), ["tree"])
        at = materialize(at.filter(done).select(swapped.columns).unionByName(swapped), "merkle-round")
        size *= FANOUT
    at = at.join(widths, "tree").select(
        F.lit(0).alias("all"), F.col("tree").alias("node"), F.col("slot"), "slots", "root", "steps",
        F.struct("tree", "own.block", F.col("root").alias("subroot"), "widths").alias("own"))
    for r in range(rounds):
        at = materialize(_swap(at.withColumn("most", F.col("own.widths")[r]), ["all"]), "merkle-round")
    return at.select("own.tree", "own.block", "own.subroot", "root", "steps")


_RESULT = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def _prove(blocks: DataFrame, levels: int) -> DataFrame:
    """The result rows of blocks that hold their leaves and their way up."""
    out = arrow_schema(T._parse_datatype_string(_RESULT))

    def proved(n: int, rows: list[dict], subroot: str, root: str, steps: list[dict]) -> Iterator[tuple]:
        tree = _subtree([r["leaf"] for r in rows], _height(n, levels))
        upper = [(s["left"], s["right"]) for s in steps]
        for i, row in enumerate(rows):
            way = []
            for nodes in tree[:-1]:
                run = i // FANOUT * FANOUT
                way.append(("".join(nodes[run:i]), "".join(nodes[i + 1:run + FANOUT])))
                i //= FANOUT
            way += upper
            folded = row["leaf"] if row["tampered"] is None else row["tampered"]
            for left, right in way:
                folded = _hash([left, folded, right])
            yield (row["doc_id"], row["leaf"], subroot, root, _hash([part for step in way for part in step]), folded, folded == root)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(batch.num_rows):  # one block at a time
                n, rows, subroot, root, steps = (c[start].as_py() for c in batch.columns)
                columns = zip(*proved(n, rows, subroot, root, steps))
                yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(columns, out)], schema=out)

    return blocks.select("n_leaves", "rows", "subroot", "root", "steps").mapInArrow(run, _RESULT)


def manifest(docs: DataFrame, tampered: Column | None = None, levels: int = LEVELS) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified for every row of ``docs``.

    ``docs`` has doc_id, source, lang, n_chars and text, whose values, NULLs included, make up the leaf. ``tampered``
    says which rows are checked with A-Z of their text in lower case (none by default). Each lang is a tree whose leaves
    ascend by doc_id: NULL ids come first, rows with equal ids follow the order of their hashes, and repeated rows are
    leaves of their own. Empty texts are values like any other, very long ones are hashed whole. The NULL lang is the
    first tree. An empty table gives an empty result; other columns are ignored. ``levels`` of a tree are worked out
    within a block; they don't change the result.
    """
    block = FANOUT ** levels
    forged = F.when(tampered & F.col("text").isNotNull(), leaf_hash(
        F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), F.translate("text", _UPPER, _LOWER))) \
        if tampered is not None else F.lit(None).cast("string")
    leaves = materialize(docs.select(
        "lang", "doc_id", leaf_hash(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), F.col("text")).alias("leaf"),
        forged.alias("tampered")), "merkle-leaves")
    sizes = leaves.groupBy("lang").agg(F.count("*").alias("n_leaves")).withColumn("all", F.lit(0))
    trees = ranked(sizes, ["all"], [F.col("lang").asc_nulls_first()], "merkle-trees")
    trees = materialize(trees.select("lang", F.col("rank").alias("tree"), "n_leaves",
                                     F.ceil(F.col("n_leaves") / block).cast("long").alias("n_blocks")), "merkle-trees")
    n_trees, longest = trees.agg(F.count("*"), F.max("n_blocks")).first()
    placed = ranked(leaves, ["lang"], [F.col("doc_id").asc_nulls_first(), F.col("leaf")], "merkle-sorted")
    placed = placed.withColumn("block", F.floor(F.col("rank") / block).cast("long")).withColumnRenamed("lang", "of")
    grouped = placed.groupBy("of", "block").agg(
        F.sort_array(F.collect_list(F.struct("rank", "doc_id", "leaf", "tampered"))).alias("rows"))  # a block's rows at most
    blocks = materialize(grouped.join(trees, F.col("of").eqNullSafe(F.col("lang"))).select(
        "tree", "block", "n_leaves", "rows"), "merkle-blocks")
    upper = _upper(_block_roots(blocks, levels), trees.select("tree", "n_blocks"), n_trees, longest or 0)
    return _prove(blocks.join(upper, ["tree", "block"]), levels)

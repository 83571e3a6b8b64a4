"""The trie of all prefixes of conversations, by digests of blocks of turns.

A conversation is cut into blocks of BLOCK turns. Conversations are first grouped block by block: by the digest of all
blocks before, and that of the block itself. Where every conversation that comes out of a prefix goes on with the same
block, the nodes inside that block have the members of its end. Only where siblings diverge are blocks cut into turns,
and their prefixes grouped.

A prefix is named by the exclusive or of hashes of (depth, turn), twice 64 bits: it can be taken block by block, and
of a very long conversation part by part. Sums over a subtree are sums over its members: each node's own value is laid
to the smallest member of the node, so that a second grouping of the same blocks adds them up, at any depth at once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberline.functions.storage import materialize
from emberline.llm.ranks import ranked, running
from emberline.llm.source_mix import n_words

#: Turns in a block.
BLOCK = 4
#: Ids that are put into one text at a time.
_IDS = 128

_KEY = ["depth", "fa", "fb"]


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, rank, digest, words): turns of each conversation in order; equal turn numbers follow their digests."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256))
    turns = conversations.filter("conv_id IS NOT NULL").select("conv_id", "turn", digest.alias("digest"), n_words(text).alias("words"))
    return ranked(turns, ["conv_id"], [F.col("turn").asc_nulls_first(), F.col("digest")], "trie-turns").drop("turn")


def rebuilt(turns: DataFrame, group: int, lend: Column, longest_loan: int) -> tuple[DataFrame, DataFrame]:
    """(conv_id, length) and (conv_id, depth, digest, words), depth from 1, of conversations with borrowed starts.

    Conversation c takes the first h = ``lend`` turns (``longest_loan`` at most) of conversation c - c % ``group`` in
    place of its own first h; fewer where that has fewer, none where it is absent.
    """
    sizes = materialize(turns.groupBy("conv_id").agg(F.count("*").alias("n")), "trie-sizes")
    plan = sizes.select("conv_id", "n", lend.cast("long").alias("h"), (F.col("conv_id") - F.col("conv_id") % group).alias("base"))
    lenders = sizes.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    plan = materialize(plan.join(lenders, "base", "left").withColumn(
        "lent", F.least("h", F.coalesce("base_n", F.lit(0)))).drop("base_n"), "trie-plan")
    starts = turns.filter(F.col("rank") < longest_loan).withColumnRenamed("conv_id", "base").join(
        plan.filter("lent > 0").select("base", "conv_id", "lent"), "base").filter("rank < lent")
    own = turns.join(plan.select("conv_id", "h", "lent"), "conv_id").filter("rank >= h")
    rows = starts.select("conv_id", (F.col("rank") + 1).alias("depth"), "digest", "words").union(
        own.select("conv_id", (F.col("rank") - F.col("h") + F.col("lent") + 1).alias("depth"), "digest", "words"))
    return plan.select("conv_id", (F.col("lent") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length")), rows


def _xor(turns: Column, lane: str, start: Column) -> Column:
    return F.aggregate(turns, start, lambda x, t: x.bitwiseXOR(t[lane]))


def block_rows(turns: DataFrame) -> DataFrame:
    """(conv_id, block, pa, pb, oa, ob, turns): each block's turns, its own digest and that of all blocks before."""
    depth = F.col("depth")
    lanes = turns.select("conv_id", F.floor((depth - 1) / BLOCK).cast("long").alias("block"), F.struct(
        "depth", F.xxhash64("depth", "digest").alias("a"), F.xxhash64(F.lit("second"), "digest", "depth").alias("b"), "words").alias("turn"))
    blocks = lanes.groupBy("conv_id", "block").agg(F.sort_array(F.collect_list("turn")).alias("turns"))  # BLOCK turns
    zero = F.lit(0).cast("long")
    blocks = blocks.select("*", _xor(F.col("turns"), "a", zero).alias("oa"), _xor(F.col("turns"), "b", zero).alias("ob"))
    blocks = running(blocks, ["conv_id"], "block", ["oa", "ob"], F.bit_xor, Column.bitwiseXOR)
    return blocks.select("conv_id", "block", F.col("before_oa").alias("pa"), F.col("before_ob").alias("pb"), "oa", "ob", "turns")


def prefix_groups(blocks: DataFrame, sums: list[str]) -> DataFrame:
    """(depth, fa, fb, ga, gb, conv_id, words, ...): every prefix of a turn or more, once.

    fa, fb name the prefix and ga, gb the one shorter by a turn; conv_id is the smallest member, words those of the
    last turn, ``sums`` are added up over the members' blocks.
    """
    prefix = ["block", "pa", "pb"]
    segments = blocks.groupBy(*prefix, "oa", "ob").agg(
        F.min("conv_id").alias("conv_id"), F.first("turns").alias("turns"), *[F.sum(s).alias(s) for s in sums])
    segments = materialize(segments, "trie-segments")
    diverging = materialize(segments.groupBy(*prefix).agg(F.count("*").alias("siblings")), "trie-siblings")
    at = segments.join(diverging, prefix).select(
        "siblings", "pa", "pb", "turns", "conv_id", *sums, F.posexplode("turns").alias("pos", "turn"))
    upto = F.slice("turns", F.lit(1), F.col("pos") + 1)
    nodes = at.select(
        "siblings", F.col("turn.depth").alias("depth"), _xor(upto, "a", F.col("pa")).alias("fa"), _xor(upto, "b", F.col("pb")).alias("fb"),
        F.col("turn.a").alias("a"), F.col("turn.b").alias("b"), "conv_id", F.col("turn.words").alias("words"), *sums)
    nodes = nodes.select("siblings", *_KEY, F.col("fa").bitwiseXOR(F.col("a")).alias("ga"), F.col("fb").bitwiseXOR(F.col("b")).alias("gb"),
                         "conv_id", "words", *sums)
    cut = nodes.filter("siblings > 1").groupBy(*_KEY).agg(
        *[F.first(c).alias(c) for c in ("ga", "gb")], F.min("conv_id").alias("conv_id"), F.first("words").alias("words"),
        *[F.sum(s).alias(s) for s in sums])
    return nodes.filter("siblings = 1").drop("siblings").unionByName(cut)


def _ends(lengths: DataFrame, blocks: DataFrame) -> DataFrame:
    """(depth, fa, fb, n_ends, ends_sha256): members that end at a node, and the hash of their ids in order."""
    whole = blocks.groupBy("conv_id").agg(F.bit_xor("oa").alias("fa"), F.bit_xor("ob").alias("fb"))
    zero = F.lit(0).cast("long")
    ends = lengths.join(whole, "conv_id", "left").select(
        "conv_id", F.col("length").alias("depth"), F.coalesce("fa", zero).alias("fa"), F.coalesce("fb", zero).alias("fb"))
    lists = ranked(ends, _KEY, [F.col("conv_id")], "trie-ends").withColumn("part", F.floor(F.col("rank") / _IDS).cast("long"))
    parts = lists.groupBy(*_KEY, "part").agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))  # _IDS at most
    parts = parts.select(*_KEY, "part", F.size("ids").cast("long").alias("n"), F.array_join(F.transform("ids", lambda i: i.cast("string")), ",").alias("ids"))
    names = [*_KEY, "n_ends", "ends_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, n, state = None, 0, None
        for batch in batches:
            rows = []
            for *now, _, count, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if now != key:
                    if key is not None:
                        rows.append((*key, n, state.hexdigest()))
                    key, n, state = now, 0, hashlib.sha256()
                state.update((b"," if n else b"") + ids.encode())
                n += count
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names)
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (*key, n, state.hexdigest())], names)

    # A hash is taken from the first id to the last: the parts of a node pass through one task, one after another.
    return parts.repartition(*_KEY).sortWithinPartitions(*_KEY, "part").mapInArrow(
        run, "depth long, fa long, fb long, n_ends long, ends_sha256 string")


def prefix_trie(conversations: DataFrame, group: int, lend: Column, longest_loan: int) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of every node.

    ``conversations`` has conv_id, turn, role and text; ``rebuilt`` says what ``group``, ``lend`` and ``longest_loan``
    are. Turns ascend by number, NULL first, and by a digest of role and text where numbers are equal; repeated rows
    are turns of their own. NULL roles and texts count as empty ones, empty and very long texts are turns like any
    other. Rows with a NULL conv_id belong to no conversation and take no part. An empty table gives an empty result;
    other columns are ignored.
    """
    lengths, turns = rebuilt(numbered_turns(conversations), group, lend, longest_loan)
    blocks = materialize(block_rows(turns), "trie-blocks")
    zero = F.lit(0).cast("long")
    root = [F.lit(0).cast("long").alias(c) for c in ("depth", "fa", "fb")]
    top = lengths.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).filter("n_convs > 0").select(
        *root, zero.alias("ga"), zero.alias("gb"), "conv_id", zero.alias("words"), "n_convs")
    nodes = prefix_groups(blocks.withColumn("n_convs", F.lit(1).cast("long")), ["n_convs"]).unionByName(top)
    nodes = nodes.join(_ends(lengths, blocks), _KEY, "left").withColumn("n_ends", F.coalesce("n_ends", zero))
    nodes = materialize(nodes.withColumn("value", (F.col("n_convs") - 1) * F.col("words")), "trie-nodes")

    shares = nodes.groupBy("conv_id").agg(
        F.sum("value").alias("saved"), F.sum((F.col("n_ends") == F.col("n_convs")).cast("long")).alias("leaves"))
    shares = materialize(shares, "trie-shares")
    sums = prefix_groups(blocks.join(shares, "conv_id"), ["saved", "leaves"]).select(*_KEY, "saved", "leaves").unionByName(
        shares.agg(F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves")).filter("leaves IS NOT NULL").select(*root, "saved", "leaves"))
    # A node's smallest member has its share from above the node, too.
    nodes = running(nodes, ["conv_id"], "depth", ["value"], F.sum, Column.__add__)
    children = nodes.filter("depth > 0").groupBy(
        (F.col("depth") - 1).alias("depth"), F.col("ga").alias("fa"), F.col("gb").alias("fb")).agg(F.count("*").alias("n_children"))
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("fa").alias("ga"), F.col("fb").alias("gb"),
                           F.col("conv_id").alias("parent_conv_id"))
    return nodes.join(sums, _KEY).join(children, _KEY, "left").join(
        parents, ["depth", "ga", "gb"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", zero).alias("n_children"),
        F.col("leaves").alias("n_leaves"), (F.col("saved") - F.col("before_value")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))

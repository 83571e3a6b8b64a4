"""Mixing sources to target weights by hash thresholds, with built-in functions only.

A source's target is a number of words; whole documents are taken until it is met. A target of r times the source's
size and a rest takes every document r times, and once more those whose hash lies below a threshold, at which the
words below it make up the rest. Thresholds of further copies are nested in this way: whoever is taken r + 1 times is
taken r times.

Thresholds come from histograms: words are summed by source and bucket of the hash, the bucket in which the rest is
used up is cut into finer buckets, and so on until one document stands at the border. Only the boundary bucket's
documents are looked at again, and nothing is sorted. What the document at the border leaves open is met by another
threshold over the documents that fit into the gap, FILLS times, and last by the one document whose size is nearest to
what is left, if it is nearer than none. So a source is off by at most half its longest document, and usually by a few words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emberline.functions.storage import materialize
from emberline.llm.ranks import ranked

#: Fixed values of the result contract: weights of the sources in order, the share of all words, copies at most.
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2

#: Thresholds after the first one, each for the gap that the one before leaves.
FILLS = 1
BUCKET_BITS = 12
#: The hash has 60 bits; documents with equal hashes are told apart by their row's number.
_SHIFTS = [("hash", s) for s in (48, 36, 24, 12, 0)] + [("row", s) for s in (60, 48, 36, 24, 12, 0)]


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(key, source_size, ...) with ``target``, ``repeats`` (copies of every document) and ``rest`` (words beyond them).

    Sources weigh as their order by code point says, NULL last. Targets are by weight; one that is above ``most``
    times its source's size stops there, and what is left is shared by weight again, until none is above. The
    rounds read sums only, and each closes at least one source.
    """
    order = [F.col("source").isNull(), F.col("source")]
    numbered = ranked(sources.withColumn("_all", F.lit(0)), ["_all"], order, "mix-sources").drop("_all")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    numbered = materialize(numbered.select("key", "source", "source_size", weight.cast("long").alias("weight")), "mix-weights")
    total = numbered.agg(F.sum("source_size")).first()[0] or 0
    closed, budget = F.lit(False), share * total
    while True:
        capped, open_weight = numbered.agg(F.sum(F.when(closed, most * F.col("source_size")).otherwise(0)),
                                           F.sum(F.when(closed, 0).otherwise(F.col("weight")))).first()
        fair = F.lit(float(budget - (capped or 0))) * F.col("weight") / F.lit(open_weight or 1)
        before, closed = closed, fair > most * F.col("source_size")
        if not numbered.filter(closed & ~before).limit(1).count():
            break
    target = F.when(before, (most * F.col("source_size")).cast("double")).otherwise(fair)
    repeats = F.least(F.coalesce(F.try_divide(target, F.col("source_size")).cast("long"), F.lit(0)), F.lit(most))
    return numbered.select("key", "source_size", target.alias("target"), repeats.alias("repeats")).withColumn(
        "rest", F.when(F.col("repeats") < most, F.floor(F.col("target") - F.col("repeats") * F.col("source_size")))
        .otherwise(0).cast("long"))


def _below(bound: Column) -> Column:
    """Whether a row comes before a threshold (struct of gap, hash and row; no hash: all documents that fit)."""
    hash_, row = bound["hash"], bound["row"]
    return (F.col("size") <= bound["gap"]) & (
        hash_.isNull() | (F.col("hash") < hash_) | ((F.col("hash") == hash_) & (F.col("row") < row)))


def _threshold(rows: DataFrame, gaps: DataFrame) -> DataFrame:
    """(key, bounds, gap): the threshold of each key's gap is added to ``bounds``, and what it leaves is the new gap.

    ``rows``: (key, size, hash, row). ``gaps``: (key, bounds, gap).
    """
    rows = rows.join(gaps, "key").filter((F.col("size") > 0) & (F.col("size") <= F.col("gap")) & ~F.exists("bounds", _below))
    rows = rows.select("key", "size", "hash", "row")
    state = gaps.select("key", "bounds", "gap", F.col("gap").alias("left"), F.lit(None).cast("long").alias("hash"),
                        F.lit(0).cast("long").alias("row"), F.lit(2).cast("long").alias("inside"))
    for n, (word, shift) in enumerate(_SHIFTS):
        bucket = F.shiftright(word, shift).bitwiseAND((1 << BUCKET_BITS) - 1).alias("bucket")
        sums = rows.groupBy("key", bucket).agg(F.sum("size").alias("words"), F.count("*").alias("n"))
        upto = F.sum("words").over(Window.partitionBy("key").orderBy("bucket"))  # 4096 rows a key at most
        sums = sums.withColumn("before", upto - F.col("words"))
        open_ = state.filter("inside > 1").join(sums, "key")
        at = open_.filter((F.col("before") <= F.col("left")) & (F.col("left") < F.col("before") + F.col("words"))).select(
            "key", F.col("before").alias("used"), "n",
            F.shiftleft("bucket", shift).alias("start"))
        start = F.coalesce(F.col(word), F.lit(0)) + F.col("start")
        found = state.join(at, "key", "left")
        if n == 0:  # where all documents fit, none stands at the border
            fitting = rows.groupBy("key").agg(F.sum("size").alias("words"))
            found = found.join(fitting, "key", "left").withColumn("used", F.coalesce("used", "words", F.lit(0)))
        state = materialize(found.select(
            "key", "bounds", "gap", (F.col("left") - F.coalesce("used", F.lit(0))).alias("left"),
            *[(F.when(F.col("n").isNotNull(), start).otherwise(F.col(c)) if c == word else F.col(c)).alias(c) for c in ("hash", "row")],
            F.coalesce("n", F.lit(0) if n == 0 else F.col("inside")).alias("inside")), "mix-thresholds")
        if (state.agg(F.max("inside")).first()[0] or 0) <= 1:
            break
        known = state.filter("inside > 1").select("key", F.col("hash").alias("_hash"), F.col("row").alias("_row"))
        same = F.shiftright(word, shift) == F.shiftright(f"_{word}", shift)
        rows = materialize(rows.join(known, "key").filter(same).select("key", "size", "hash", "row"), "mix-boundary")
    bound = F.struct("gap", "hash", "row")
    return state.select("key", F.concat("bounds", F.array(bound)).alias("bounds"), F.col("left").alias("gap"))


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """doc_id, source, size, source_size, target, copies and taken (size times copies) for every row of ``docs``.

    ``docs`` has doc_id, source and text. A text's size is its number of words; NULL, empty and blank texts have
    size 0 and are never taken, nor is anything of a source without words; very long texts are counted whole, and
    taken whole or not at all. NULL is a source of its own, the last. A document's hash is that of its id and text, so
    the mix doesn't depend on how rows are dealt out; of rows that agree in all, some may be taken more often than the
    others. An empty table gives an empty result; other columns are ignored.
    """
    key = F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))
    digest = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.lit(":"), F.coalesce("text", F.lit("-"))))
    rows = materialize(docs.select(
        "doc_id", "source", key.alias("key"), n_words(F.col("text")).alias("size"),
        F.conv(F.substring(digest, 1, 15), 16, 10).cast("long").alias("hash"),
        F.monotonically_increasing_id().alias("row")), "mix-rows")
    sources = rows.groupBy("key", "source").agg(F.sum("size").alias("source_size"))
    goals = materialize(targets(sources, weights, share, most), "mix-targets")
    none = F.array().cast("array<struct<gap:bigint,hash:bigint,row:bigint>>")
    state = goals.select("key", none.alias("bounds"), F.col("rest").alias("gap"))
    words = rows.select("key", "size", "hash", "row")
    for _ in range(1 + FILLS):
        state = _threshold(words, state)
    state = materialize(state, "mix-bounds")
    over = words.join(state, "key").filter((F.col("size") > 0) & (F.col("size") < 2 * F.col("gap")) & ~F.exists("bounds", _below))
    last = over.groupBy("key").agg(F.min(F.struct(F.abs(F.col("size") - F.col("gap")).alias("off"), "size", "hash", "row")).alias("last"))
    plan = materialize(goals.drop("rest").join(state.join(last, "key", "left").drop("gap"), "key"), "mix-plan")
    more = F.exists("bounds", _below) | F.coalesce((F.col("last.hash") == F.col("hash")) & (F.col("last.row") == F.col("row")), F.lit(False))
    copies = F.when(F.col("size") > 0, F.col("repeats") + more.cast("long")).otherwise(0)
    return rows.join(plan, "key").select(
        "doc_id", "source", "size", "source_size", "target", copies.alias("copies"), (F.col("size") * copies).alias("taken"))

"""N-gram Jaccard self-join by PartEnum signatures, and the components of its links.

Sets are compared whose sizes differ by the bound at most, so they lie in one band of sizes or in neighbouring ones.
Within a band the bound is a Hamming distance k. The domain is split into k // 2 + 1 parts, of which one holds at
most one difference; it is split into three cells, of which two then agree. A set's signatures are, for each part,
its elements in each two cells of three: any two sets that link share one, and only sets that share one are compared.

Everything runs on distinct sets, named by a 64-bit hash of their shingles; copies meet again at the end. Signature
buckets are never paired out: first each member of a bucket is compared with its smallest and with its largest, and
linked sets are contracted; only buckets that still hold several components are compared further, in blocks. Sketches,
whose distance can't exceed the true one, sort out nearly all pairs that don't link; each one that remains is verified
on the whole sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emberline.functions.storage import discard, free_shuffles, materialize
from emberline.llm.common import ASCII_LOWER, SLICE_ROWS
from emberline.llm.components import components

#: Fixed values of the result contract.
SHINGLE = 4
PERCENT = 85

#: Size bands grow by this factor.
BAND_GROWTH = 1.5
LONGEST = 1 << 40

BLOCK_ROWS = 256

#: Bits per element of the sketches that are compared within buckets; other pairs are ruled out by one.
SHARP_BITS = 4

#: The filter for the second reading has at most so many bits; beyond, it lets more sets through.
FILTER_BITS = 1 << 27

_M1, _M2, _M3 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit affects every output bit."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted hashes of a text's distinct shingles: four words each, or the whole sequence if it is shorter."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(ASCII_LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < SHINGLE:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=1 + len(words))], np.uint64)
    known: dict[bytes, int] = {}
    for w in words:
        if w not in known:
            known[w] = xxhash.xxh3_64_intdigest(w)
    h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    n = len(h) - SHINGLE + 1
    code = h[:n]
    for i in range(1, SHINGLE):
        code = mix(code) * _M3 + h[i:i + n]
    return np.unique(mix(code))


def set_name(shingles: np.ndarray) -> int:
    """A signed 64-bit name of a set; two of N different sets share one with a probability below N^2 / 2^65."""
    return int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(shingles.tobytes()))))


def most_different(size_a, size_b):
    """The largest symmetric difference at which sets of these sizes still link."""
    return (size_a + size_b) * (100 - PERCENT) // (100 + PERCENT)


def size_bands() -> list[tuple[int, int]]:
    bands, low = [], 1
    while low < LONGEST:
        high = max(low, int(low * BAND_GROWTH))
        bands.append((low, high))
        low = high + 1
    return bands


_BANDS = size_bands()
_BAND_ENDS = np.array([high for _, high in _BANDS])


def signatures(shingles: np.ndarray) -> np.ndarray:
    """For the set's own band, and for the next where a partner can lie in it. None where only equal sets link."""
    size = len(shingles)
    band = int(np.searchsorted(_BAND_ENDS, size))
    out = []
    for b in (band, band + 1):
        if b > band and size * 100 // PERCENT <= _BANDS[band][1]:
            break
        k = most_different(_BANDS[b][1], _BANDS[b][1])
        if k == 0:
            continue
        parts = k // 2 + 1
        salt = np.uint64((b + 1) * int(_M3) % (1 << 64))
        cell = (mix(shingles + salt) % np.uint64(3 * parts)).astype(np.int64)
        held = np.zeros(3 * parts, np.uint64)
        np.add.at(held, cell, mix(shingles ^ salt))
        held = held.reshape(parts, 3)
        place = np.arange(parts * 3, dtype=np.uint64).reshape(parts, 3)
        both = held + np.roll(held, -1, axis=1)  # cells (0,1), (1,2), (2,0)
        out.append(mix(both + mix(place + salt)).ravel())
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def sketch(shingles: np.ndarray, bits_each: int = 1) -> np.ndarray:
    """Parities of hashed elements, ``bits_each`` bits per element or more: a power of two of 64-bit words.

    Two sketches of one length differ in no more bits than the sets in elements. Folding a sketch in half (by
    exclusive or) gives the sketch of half the length, so that neighbouring sizes compare as well.
    """
    words = 1
    while 64 * words < bits_each * len(shingles):
        words *= 2
    bits = np.bincount((mix(shingles * _M2 + _M3) % np.uint64(64 * words)).astype(np.int64), minlength=64 * words)
    return np.packbits((bits & 1).astype(np.uint8), bitorder="little").view(np.uint64)


# ---- readings of the documents

def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[int | None, np.ndarray]]]:
    """(doc_id, set) of a few hundred rows at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, SLICE_ROWS):
            part = batch.slice(start, SLICE_ROWS)
            yield [(i, shingle_set(t)) for i, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist())]


def _names(docs: DataFrame) -> DataFrame:
    """(doc_id, n, name, sketch, sharp): NULL name for the empty set; sharp is the longer sketch."""
    def run(batches):
        for rows in _sets(batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array([i for i, _ in rows], pa.int64()), pa.array([len(s) for _, s in rows], pa.int64()),
                 pa.array([set_name(s) if len(s) else None for _, s in rows], pa.int64()),
                 *[pa.array([sketch(s, bits).view(np.int64) for _, s in rows], pa.list_(pa.int64()))
                   for bits in (1, SHARP_BITS)]], ["doc_id", "n", "name", "sketch", "sharp"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n long, name long, sketch array<long>, sharp array<long>")


def _signature_rows(docs: DataFrame) -> DataFrame:
    """(sig, name), once per set and task."""
    def run(batches):
        seen: set[int] = set()
        for rows in _sets(batches):
            sigs, names = [], []
            for _, shingles in rows:
                if not len(shingles) or (name := set_name(shingles)) in seen:
                    continue
                if len(seen) < 1 << 18:  # spares repeated rows; a set that comes again does no harm
                    seen.add(name)
                own = signatures(shingles)
                sigs.append(own)
                names.append(np.full(len(own), name, np.int64))
            if sigs:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sigs).view(np.int64)),
                                                  pa.array(np.concatenate(names))], ["sig", "name"])

    return docs.select("doc_id", "text").mapInArrow(run, "sig long, name long")


def _filter_positions(name: Column, n_bits: int) -> list[Column]:
    return [F.shiftrightunsigned(name, s).bitwiseAND(n_bits - 1) for s in (0, 17, 34)]


def _name_filter(names: DataFrame) -> np.ndarray:
    """A Bloom filter of the names, a power of two of bits up to FILTER_BITS, as bytes."""
    n_bits = 1 << 16
    wanted = 12 * names.count()
    while n_bits < min(wanted, FILTER_BITS):
        n_bits *= 2
    at = names.select(F.explode(F.array(*_filter_positions(F.col("name"), n_bits))).alias("at"))
    at = at.select((F.col("at") + 1).alias("at"))
    maps = at.groupBy(F.bitmap_bucket_number("at").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bitmap")).collect()  # n_bits bits in all
    bits = np.zeros(n_bits // 8, np.uint8)
    for row in maps:
        start = (row.bucket - 1) * 4096
        bits[start:start + len(row.bitmap)] = np.frombuffer(bytes(row.bitmap), np.uint8)
    return bits


def _candidate_sets(docs: DataFrame, names: DataFrame) -> DataFrame:
    """(name, shingles) of the sets named, read from the documents once more."""
    bits = _name_filter(names)
    sent = docs.sparkSession.sparkContext.broadcast(bits)
    n_bits = len(bits) * 8

    def run(batches):
        held, seen = sent.value, set()
        for rows in _sets(batches):
            out = []
            for _, shingles in rows:
                if not len(shingles) or (name := set_name(shingles)) in seen:
                    continue
                at = [((name & (1 << 64) - 1) >> s) & (n_bits - 1) for s in (0, 17, 34)]
                if all(held[p >> 3] >> (p & 7) & 1 for p in at):
                    if len(seen) < 1 << 18:
                        seen.add(name)
                    out.append((name, shingles.tobytes()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([n for n, _ in out], pa.int64()),
                                                  pa.array([d for _, d in out], pa.binary())], ["name", "shingles"])

    found = docs.select("doc_id", "text").mapInArrow(run, "name long, shingles binary")
    return found.join(names, "name", "left_semi").dropDuplicates(["name"])


# ---- pairs

def _apart(a: Column, b: Column) -> Column:
    """Bits in which two sketches differ, the longer one folded to the length of the shorter (half of it at most)."""
    def folded(x: Column, other: Column) -> Column:
        half = (F.size(x) / 2).cast("int")
        return F.when(F.size(x) > F.size(other), F.zip_with(
            F.slice(x, F.lit(1), half), F.slice(x, half + 1, half), lambda p, q: p.bitwiseXOR(q))).otherwise(x)

    return F.aggregate(F.zip_with(folded(a, b), folded(b, a), lambda p, q: F.bit_count(p.bitwiseXOR(q))),
                       F.lit(0), lambda total, n: total + n)


def _near(pairs: DataFrame, light: DataFrame) -> DataFrame:
    """The pairs (u, v) that sizes and sketches don't rule out; no pair that links is lost."""
    both = pairs.join(light.toDF("u", "n_u", "s_u"), "u").join(light.toDF("v", "n_v", "s_v"), "v")
    sizes = F.least("n_u", "n_v") * 100 >= F.greatest("n_u", "n_v") * PERCENT
    return both.filter(sizes).filter(
        _apart(F.col("s_u"), F.col("s_v")) * (100 + PERCENT) <= (F.col("n_u") + F.col("n_v")) * (100 - PERCENT)
    ).select("u", "v")


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (u, v) whose whole sets link."""
    both = pairs.join(sets.toDF("u", "a"), "u").join(sets.toDF("v", "b"), "v").select("u", "v", "a", "b")

    def run(batches):
        for batch in batches:
            keep = []
            for a, b in zip(batch.column(2), batch.column(3)):
                a, b = np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)
                common = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(100 * common >= PERCENT * (len(a) + len(b) - common))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["u", "v"]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(run, "u long, v long")


def _first_partners(pairs: DataFrame) -> DataFrame:
    """For each set its smallest partner."""
    both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return both.groupBy("u").agg(F.min("v").alias("v")).select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()


def _apart_still(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs that don't lie in one component."""
    roots = labels.toDF("u", "root_u"), labels.toDF("v", "root_v")
    return pairs.join(roots[0], "u", "left").join(roots[1], "v", "left").filter(
        F.coalesce("root_u", "u") != F.coalesce("root_v", "v")).select("u", "v")


def _open_buckets(buckets: DataFrame, labels: DataFrame) -> DataFrame:
    """(sig, name, root) of buckets with three members or more in several components.

    In smaller ones the members have met already, as the smallest and the largest.
    """
    rooted = buckets.select("sig", "name").join(labels.withColumnRenamed("node", "name"), "name", "left").withColumn(
        "root", F.coalesce("root", "name"))
    whole = Window.partitionBy("sig")
    spread = rooted.select("sig", "name", "root", F.min("root").over(whole).alias("least"),
                           F.max("root").over(whole).alias("most"), F.count("*").over(whole).alias("members"))
    return spread.filter("least <> most AND members > 2").select("sig", "name", "root")


def _block_pairs(buckets: DataFrame, light: DataFrame) -> DataFrame:
    """Distinct pairs of different components in one bucket that sizes and sketches don't rule out.

    A bucket is cut into blocks, and each two blocks meet in one group, of 2 * BLOCK_ROWS members at most.
    """
    in_bucket = Window.partitionBy("sig")
    rows = (buckets.withColumn("block", F.floor((F.row_number().over(in_bucket.orderBy("name")) - 1) / BLOCK_ROWS).cast("int"))
            .withColumn("blocks", F.max("block").over(in_bucket) + 1))
    dealt = (rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("sig", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "name",
                     "root"))
    dealt = dealt.join(light, "name").select("sig", "i", "j", "block", "name", "root", "n", "sketch")
    ordered = dealt.repartition("sig", "i", "j").sortWithinPartitions("sig", "i", "j", "name")

    def pairs_of(i: int, j: int, block, name, root, n, sketches: list[np.ndarray]) -> np.ndarray:
        a, b = np.flatnonzero(block == i), np.flatnonzero(block == j)
        fine = (root[a][:, None] != root[b][None, :]) & (
            np.minimum(n[a][:, None], n[b]) * 100 >= np.maximum(n[a][:, None], n[b]) * PERCENT)
        if i == j:
            fine &= a[:, None] < b[None, :]
        x, y = np.nonzero(fine)
        if not len(x):
            return np.zeros((0, 2), np.int64)
        x, y = a[x], b[y]
        words = min(map(len, sketches))
        parity = np.array([np.bitwise_xor.reduce(s.reshape(-1, words), axis=0) for s in sketches])
        near = np.concatenate([
            np.bitwise_count(parity[p] ^ parity[q]).sum(axis=1) <= most_different(n[p], n[q])
            for p, q in ((x[k:k + 4096], y[k:k + 4096]) for k in range(0, len(x), 4096))])
        x, y = x[near], y[near]
        return np.stack([np.minimum(name[x], name[y]), np.maximum(name[x], name[y])], axis=1)

    def run(batches):
        kept: list | None = None
        for batch in batches:
            columns = [c.to_numpy() for c in batch.columns[:7]]
            ends = batch.column(7).offsets.to_numpy()
            values = batch.column(7).values.to_numpy().view(np.uint64)
            columns.append([values[p:q] for p, q in zip(ends, ends[1:])])
            if kept is not None:
                columns = [a + b if isinstance(a, list) else np.concatenate([a, b]) for a, b in zip(kept, columns)]
            sig, i, j = columns[:3]
            cuts = np.flatnonzero((sig[1:] != sig[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])) + 1
            starts = [0, *cuts.tolist()]
            yield from _pair_batch([pairs_of(i[p], j[p], *(c[p:q] for c in columns[3:])) for p, q in zip(starts, starts[1:])])
            kept = [c[starts[-1]:] for c in columns]  # the last group may go on in the next batch
        if kept is not None and len(kept[0]):
            yield from _pair_batch([pairs_of(kept[1][0], kept[2][0], *kept[3:])])

    return ordered.mapInArrow(run, "u long, v long").distinct()


def _pair_batch(found: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    pairs = np.concatenate(found) if found else np.zeros((0, 2), np.int64)
    if len(pairs):
        pairs = np.unique(pairs, axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], ["u", "v"])


# ---- the operator

def ngram_components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id for every row of ``docs`` (doc_id, text).

    Two documents link when their sets of four-word shingles have a Jaccard similarity of 0.85 or more; component_id
    is the smallest doc_id that links reach. A text without words, or NULL, has an empty set and only itself. Rows
    that repeat a doc_id are documents of their own; a NULL doc_id takes part in links and is never a component's
    id unless nothing else is in it. An empty table gives an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    names = materialize(_names(docs), "set-names")
    light = materialize(names.filter("name IS NOT NULL").groupBy("name").agg(
        F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.first("sharp").alias("sharp")), "set-sketches")
    light, sharp = light.select("name", "n", "sketch"), light.select("name", "n", F.col("sharp").alias("sketch"))
    bucket = Window.partitionBy("sig")
    rows = _signature_rows(docs).select("sig", "name", F.min("name").over(bucket).alias("low"),
                                        F.max("name").over(bucket).alias("high")).filter("low <> high")
    buckets = materialize(rows.distinct(), "buckets")
    free_shuffles(spark)
    ends = buckets.select("name", F.explode(F.array("low", "high")).alias("end")).filter("name <> end")
    near = materialize(_near(ends.select(F.least("name", "end").alias("u"), F.greatest("name", "end").alias("v")).distinct(),
                             light), "pairs")
    wanted = materialize(near.select(F.explode(F.array("u", "v")).alias("name")).distinct(), "candidates")
    sets = materialize(_candidate_sets(docs, wanted), "sets")
    free_shuffles(spark)
    first = materialize(_verified(_first_partners(near), sets), "links")
    labels = components(first)
    free_shuffles(spark)
    second = materialize(_verified(_apart_still(near, labels), sets), "links")
    labels = components(first.union(second))
    free_shuffles(spark)
    rest = materialize(_block_pairs(_open_buckets(buckets, labels), sharp).join(near, ["u", "v"], "left_anti"), "pairs")
    more = materialize(rest.select(F.explode(F.array("u", "v")).alias("name")).distinct()
                       .join(wanted, "name", "left_anti"), "candidates")
    if not more.isEmpty():
        sets = sets.union(materialize(_candidate_sets(docs, more), "sets"))
    free_shuffles(spark)
    third = materialize(_verified(rest, sets), "links")
    labels = components(first.union(second).union(third))
    names = names.drop("sketch", "sharp")

    least = names.filter("name IS NOT NULL").groupBy("name").agg(F.min("doc_id").alias("least"))
    rooted = least.join(labels.withColumnRenamed("node", "name"), "name", "left").select(
        "name", "least", F.coalesce("root", "name").alias("root"))
    ids = rooted.groupBy("root").agg(F.min("least").alias("component"))
    by_name = rooted.join(ids, "root").select("name", "component")
    result = materialize(names.join(by_name, "name", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id")), "components")
    for table in (names, light, buckets, near, wanted, sets, first, second, rest, more, third, labels):
        discard(table)
    free_shuffles(spark)
    return result


def deduplicate(docs: DataFrame) -> DataFrame:
    """``docs`` with one row left of each group of linked documents; all columns stay as they are.

    That row has the smallest doc_id of the group (any id before NULL); of several rows with that id, one stays.
    Rows are told apart by a number of their own, not by doc_id, so that repeated ids and NULL ids are documents
    like any. A text without words, or NULL, links to nothing, and its row always stays.
    """
    row = "row"
    while row in {c.lower() for c in docs.columns}:
        row += "_"
    rows = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    groups = ngram_components(rows.select(F.col(row).alias("doc_id"), "text")).select(
        F.col("doc_id").alias(row), F.col("component_id").alias("group"))
    best = F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col(row)))
    kept = groups.join(rows.select(row, "doc_id"), row).groupBy("group").agg(best.alias("best")).select(f"best.{row}")
    return rows.join(kept, row, "left_semi").select(*[f"`{c}`" for c in docs.columns])

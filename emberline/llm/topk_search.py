"""Exact top-k search by inner product over a bit-sliced index.

Rows are dealt into blocks of bounded size. A block's index holds, for each component, one bitmap per bit of its
value over all rows of the block. A query adds up the slices of its components, weighted by the bits of its own,
with carry-save adders on whole bitmaps; the sums are bit slices too. The best rows are then selected from the most
significant slice downward; ties at the boundary go to the smallest vec_id. Only k rows of a query leave a block.

Work is queries x rows, as the contract's query set demands, in units of one block and one pack of queries.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows per block and queries per pack, on average; groups of packs that share a copy of a block's index.
BLOCK_ROWS = 32_768
PACK_ROWS = 128
GROUPS = 16

#: Fixed values of the result contract.
SCALE = 64
QUERY_STEP = 20
K = 20

#: Vectors with a component beyond this are indexed apart, in smaller groups, so that they don't widen the others' slices.
WIDE = 1 << 20
WIDE_GROUPS = 4

_INDEX = "block long, dims int, width int, ids binary, slices binary"
_PACK = "pack long, dims int, ids binary, vectors binary"


def integer_vectors(embeddings: DataFrame) -> DataFrame:
    """(vec_id, v array<long>): floor(64 x) of each component; rows that can't take part are left out.

    A finite component whose floor(64 x) is no 64-bit number is an error, as in the contract.
    """
    def scaled(c: Column) -> Column:
        y = c.cast("double") * SCALE
        return F.when((y >= -(2.0 ** 63)) & (y < 2.0 ** 63), F.floor(y)).otherwise(
            F.raise_error(F.lit("a component of embedding is too large for 64 bits")).cast("long"))

    x = F.col("embedding")
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")))
    takes_part = F.col("vec_id").isNotNull() & x.isNotNull() & F.coalesce(fine, F.lit(False))
    return embeddings.select("vec_id", F.when(takes_part, F.transform(x, scaled)).alias("v")).filter("v IS NOT NULL")


def _matrix(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    ids = table.column("vec_id").to_numpy()
    flat = np.concatenate([chunk.flatten().to_numpy() for chunk in table.column("v").chunks])
    return ids, flat.reshape(len(ids), len(flat) // len(ids))


def build_slices(ids: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, int, np.ndarray]:
    """Ids in order, bits per component, and slices (component, bit, word) of the components + 2^(bits - 1)."""
    order = np.argsort(ids, kind="stable")
    ids, vectors = ids[order], vectors[order]
    top = max(int(vectors.max(initial=0)), -int(vectors.min(initial=0)) - 1)
    width = top.bit_length() + 1
    shifted = vectors.astype(np.int64).view(np.uint64) + np.uint64(1 << (width - 1))  # modulo 2^64, of which width bits count
    words = (len(ids) + 63) // 64
    slices = np.zeros((vectors.shape[1], width, words * 8), np.uint8)
    for b in range(width):
        bits = np.packbits(((shifted >> np.uint64(b)) & np.uint64(1)).astype(np.uint8).T, axis=1, bitorder="little")
        slices[:, b, :bits.shape[1]] = bits
    return ids, width, slices.view(np.uint64)


def add_slices(by_weight: dict[int, np.ndarray]) -> list[np.ndarray]:
    """Bitmaps (n x words) at each weight, added up: one slice per weight, the least significant first."""
    out, carried, weight = [], [], 0
    last = max(by_weight, default=-1)
    while weight <= last or carried:
        parts = [by_weight[weight]] if weight in by_weight else []
        stack = np.concatenate([*parts, *carried]) if parts or carried else None
        carried = []
        if stack is None:
            words = next(iter(by_weight.values())).shape[1]
            out.append(np.zeros(words, np.uint64))
        else:
            while len(stack) > 2:
                n = len(stack) // 3
                a, b, c = stack[:n], stack[n:2 * n], stack[2 * n:3 * n]
                half = a ^ b
                carried.append((a & b) | (half & c))
                stack = np.concatenate([half ^ c, stack[3 * n:]])
            if len(stack) == 2:
                carried.append(stack[:1] & stack[1:])
                stack = stack[:1] ^ stack[1:]
            out.append(stack[0])
        weight += 1
    return out


def best_rows(slices: list[np.ndarray], valid: np.ndarray, k: int) -> np.ndarray:
    """Ordinals of the k largest sums among ``valid`` rows, from the top slice down; ties to low ordinals."""
    sure, open_ = np.zeros_like(valid), valid.copy()
    for s in reversed(slices):
        with_bit = open_ & s
        n = int(np.bitwise_count(sure | with_bit).sum())
        if n > k:
            open_ = with_bit
        else:
            sure = sure | with_bit
            open_ = open_ & ~s
            if n == k:
                open_ = np.zeros_like(valid)
                break
    rows = ordinals(sure)
    return np.concatenate([rows, ordinals(open_)[:k - len(rows)]])


def ordinals(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


class Block:
    def __init__(self, ids: np.ndarray, width: int, slices: np.ndarray):
        dims, _, words = slices.shape
        self.ids, self.width, self.dims, self.words = ids, width, dims, words
        flat = slices.reshape(dims * width, words)
        self.slices = np.concatenate([flat, ~flat])  # the second half serves negative query components
        self.valid = np.zeros(words * 64, np.uint8)
        self.valid[:len(ids)] = 1

    def search(self, query_id: int, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(vec_ids, scores) of the block's k best rows, the query's own vec_id left out.

        Scores are exact: Python integers where 64 bits might not hold what is added up.
        """
        width, half = self.width, self.dims * self.width
        at: dict[int, list[np.ndarray]] = {}
        bits = q.astype(np.int64).view(np.uint64)
        size, low = np.where(q < 0, np.uint64(0) - bits, bits), np.arange(self.dims) * width + (q < 0) * half
        for c in range(int(size.max(initial=0)).bit_length()):
            rows = low[(size >> np.uint64(c)) & np.uint64(1) == 1]
            for b in range(width):
                at.setdefault(b + c, []).append(rows + b)
        sums = add_slices({w: self.slices[np.concatenate(i)] for w, i in at.items() if sum(map(len, i))})
        first, last = np.searchsorted(self.ids, query_id, "left"), np.searchsorted(self.ids, query_id, "right")
        valid = self.valid
        if last > first:
            valid = valid.copy()
            valid[first:last] = 0
        rows = best_rows(sums, np.packbits(valid, bitorder="little").view(np.uint64), k)
        held = [(s[rows >> 6] >> (rows & 63).astype(np.uint64)) & np.uint64(1) for s in sums]
        offset = (1 << (width - 1)) * sum(q.tolist()) + ((1 << width) - 1) * sum(size[q < 0].tolist())
        if len(sums) < 62 and abs(offset) < 1 << 62:
            scores = np.zeros(len(rows), np.int64)
            for w, bit in enumerate(held):
                scores += bit.astype(np.int64) << w
            return self.ids[rows], scores - offset
        exact = [sum(int(bit[r]) << w for w, bit in enumerate(held)) - offset for r in range(len(rows))]
        return self.ids[rows], np.array(exact, object)


def as_longs(scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Scores as 64-bit numbers, and which of them those can hold.

    A score that is too large is among the best of its query whatever else comes, and an error at once. One that is too
    small may yet be left out by the other blocks: it becomes the smallest number.
    """
    if scores.dtype != object:
        return scores, np.ones(len(scores), bool)
    if any(s >= 1 << 63 for s in scores):
        raise OverflowError("a score is too large for 64 bits")
    return (np.array([max(s, -1 << 63) for s in scores], np.int64), np.array([s >= -1 << 63 for s in scores], bool))


def _deal(rows: DataFrame, name: str, size: int, *by: Column | str) -> DataFrame:
    """Deal rows into groups of about ``size`` by a hash of ``by``, which must come out the same if a task runs again."""
    n = max(1, -(-rows.count() // size))
    return rows.withColumn(name, F.pmod(F.xxhash64(*by), F.lit(n)))


def block_index(vectors: DataFrame) -> DataFrame:
    """One row per block, dimension and part (wide vectors have their own): the ids of its rows and their slices."""
    def build(table: pa.Table) -> pa.Table:
        ids, width, slices = build_slices(*_matrix(table))
        return pa.table({"block": [table.column("block")[0].as_py()], "dims": pa.array([slices.shape[0]], pa.int32()),
                         "width": pa.array([width], pa.int32()), "ids": [ids.tobytes()], "slices": [slices.tobytes()]})

    # equal rows are dealt apart, by their places in the table as it was read
    rows = _deal(vectors, "block", BLOCK_ROWS, F.monotonically_increasing_id(), "vec_id").withColumn("dims", F.size("v"))
    wide = F.exists("v", lambda c: (c >= WIDE) | (c < -WIDE))
    rows = rows.withColumn("part", F.when(wide, 1 + F.pmod(F.xxhash64("vec_id", "v"), F.lit(WIDE_GROUPS))).otherwise(0))
    return rows.groupBy("block", "dims", "part").applyInArrow(build, _INDEX)


def query_packs(queries: DataFrame) -> DataFrame:
    """Distinct queries in packs. They come out of a shuffle, whose order isn't fixed: dealt by what they hold alone."""
    def pack(table: pa.Table) -> pa.Table:
        ids, vectors = _matrix(table)
        return pa.table({"pack": [table.column("pack")[0].as_py()], "dims": pa.array([vectors.shape[1]], pa.int32()),
                         "ids": [ids.tobytes()], "vectors": [vectors.tobytes()]})

    rows = _deal(queries, "pack", PACK_ROWS, "vec_id", "v").withColumn("dims", F.size("v"))
    return rows.groupBy("pack", "dims").applyInArrow(pack, _PACK)


def top_k(embeddings: DataFrame, is_query: Column, k: int = K) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the k best other rows for each row where ``is_query`` holds.

    ``embeddings`` has vec_id and embedding. Rows with a NULL vec_id, a NULL vector, a NULL, NaN or infinite
    component take no part. Components of any size do; a score of the result that 64 bits can't hold is an error,
    as is a finite component whose floor(64 x) they can't. A query meets vectors of its own length only, and never a
    row with its own vec_id. Ties go to the smaller vec_id. Repeated rows are candidates each; as queries, rows
    that are equal in every respect count once, and rows with one vec_id and several vectors are ranked apart.
    An empty table gives an empty result; other columns are ignored.
    """
    vectors = integer_vectors(embeddings)
    queries = vectors.filter(is_query).distinct()
    index = block_index(vectors).withColumn("grp", F.explode(F.sequence(F.lit(0), F.lit(GROUPS - 1))))
    packs = query_packs(queries).withColumn("grp", F.pmod(F.col("pack"), F.lit(GROUPS)).cast("int"))
    n_blocks = max(1, -(-vectors.count() // BLOCK_ROWS))
    packs = packs.withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n_blocks - 1).cast("bigint"))))
    pairs = packs.withColumnsRenamed({"ids": "query_ids"}).join(index, ["block", "grp", "dims"]).select(
        "block", "dims", "width", "ids", "slices", "query_ids", "vectors")

    def search(batches):
        known: dict[bytes, Block] = {}  # the parts of one block
        at = None
        for batch in batches:
            for row in batch.to_pylist():
                dims = row["dims"]
                if at != (row["block"], dims):
                    known, at = {}, (row["block"], dims)
                if row["ids"] not in known:
                    ids = np.frombuffer(row["ids"], np.int64)
                    slices = np.frombuffer(row["slices"], np.uint64).reshape(dims, row["width"], (len(ids) + 63) // 64)
                    known[row["ids"]] = Block(ids, row["width"], slices)
                block = known[row["ids"]]
                query_ids = np.frombuffer(row["query_ids"], np.int64)
                queries = np.frombuffer(row["vectors"], np.int64).reshape(len(query_ids), dims)
                found = [block.search(int(i), q, k) for i, q in zip(query_ids, queries)]
                each = [len(f[0]) for f in found]
                longs = [as_longs(f[1]) for f in found]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(query_ids, each)), pa.array(np.repeat([zlib.crc32(q.tobytes()) for q in queries], each), pa.int64()),
                     pa.array(np.concatenate([f[0] for f in found])), pa.array(np.concatenate([s for s, _ in longs])),
                     pa.array(np.concatenate([fits for _, fits in longs]))],
                    ["query_id", "variant", "vec_id", "score", "fits"])

    found = pairs.mapInArrow(search, "query_id long, variant long, vec_id long, score long, fits boolean")
    order = Window.partitionBy("query_id", "variant").orderBy(F.desc("score"), F.desc("fits"), "vec_id")
    score = F.when(F.col("fits"), F.col("score")).otherwise(
        F.raise_error(F.lit("a score is too small for 64 bits")).cast("long"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", score.alias("score"))

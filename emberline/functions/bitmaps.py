"""A Bloom filter from bitmap aggregates, to thin out the large side of a join before it is shuffled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS_PER_KEY = 8
HASHES = 3
#: The filter travels with the plan: 8 MB at most. Longer key lists are joined without one.
MAX_BITS = 1 << 26
_WORD = 32_768


def _places(key: Column, n_bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(n)), F.lit(n_bits)) for n in range(HASHES)]


def may_contain(keys: DataFrame, column: str) -> Column | None:
    """A test for a column of the same name: false only for values that ``keys`` lacks. None for too many keys.

    Bits are set by Spark, a bitmap of 4 KB for each 32,768 of them, after the keys have been made distinct; only
    bitmaps reach the driver.
    """
    distinct = keys.select(column).where(F.col(column).isNotNull()).distinct()
    n = distinct.count()
    n_bits = -(-max(n, 1) * BITS_PER_KEY // _WORD) * _WORD
    if n_bits > MAX_BITS:
        return None
    at = distinct.select(F.explode(F.array(*[place + 1 for place in _places(F.col(column), n_bits)])).alias("at"))
    rows = at.groupBy(F.bitmap_bucket_number("at").alias("word")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits")).collect()
    words = {row.word: bytes(row.bits) for row in rows}
    data = F.lit(b"".join(words.get(i + 1, bytes(_WORD // 8)) for i in range(n_bits // _WORD)))
    found = F.lit(True)
    for place in _places(F.col(column), n_bits):
        byte = F.conv(F.hex(F.substring(data, (place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        found = found & (F.getbit(byte, (place % 8).cast("int")) == 1)
    return found

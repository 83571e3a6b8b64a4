"""Bloom filters and cascades of them from built-in functions.

A filter is built by Spark (bit positions, one bitmap per 32,768 bits) and is tested by an expression over its bits
as a literal. A cascade alternates filters over the listed keys and over the other keys that came through, until
none is left: it then answers exactly for every key of the universe it was built on, with no join.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberline.functions.storage import materialize

BITS_PER_KEY = 10
HASHES = 5
_BUCKET_BITS = 32768

#: Bits of one filter, which travels with the plan. Longer lists are split by a hash of the key into several cascades.
MAX_BITS = 1 << 27


@dataclass(frozen=True)
class Bloom:
    bits: bytes
    n_bits: int
    salt: int

    def contains(self, key: Column) -> Column:
        data, found = F.lit(self.bits), F.lit(True)
        for position in _positions(key, self.n_bits, self.salt):
            byte = F.conv(F.hex(F.substring(data, (position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("bigint")
            found = found & (F.getbit(byte, (position % 8).cast("int")) == 1)
        return found


def _positions(key: Column, n_bits: int, salt: int) -> list[Column]:
    first = F.pmod(F.xxhash64(key, F.lit(salt)), F.lit(n_bits))
    step = F.pmod(F.xxhash64(F.lit(salt), key), F.lit(n_bits))
    return [F.pmod(first + i * step, F.lit(n_bits)) for i in range(HASHES)]


def build(keys: DataFrame, column: str, n_keys: int, salt: int = 0) -> Bloom:
    """Only bitmaps reach the driver: n_keys * BITS_PER_KEY bits."""
    n_bits = max(64, (n_keys * BITS_PER_KEY + 7) // 8 * 8)
    at = F.explode(F.array(*_positions(F.col(column), n_bits, salt))).alias("at")
    maps = (keys.select(at).select((F.col("at") + 1).alias("at"))
            .groupBy(F.bitmap_bucket_number("at").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bitmap")).collect())
    bits = bytearray((n_bits + _BUCKET_BITS - 1) // _BUCKET_BITS * (_BUCKET_BITS // 8))
    for row in maps:
        start = (row.bucket - 1) * (_BUCKET_BITS // 8)
        bits[start:start + len(row.bitmap)] = row.bitmap
    return Bloom(bytes(bits[:n_bits // 8]), n_bits, salt)


@dataclass(frozen=True)
class Cascade:
    levels: tuple[Bloom, ...]

    def contains(self, key: Column) -> Column:
        """Whether ``key`` is listed: the first level that lacks it tells, or else the last one."""
        answer = None
        for level in reversed(self.levels):
            answer = level.contains(key) if answer is None else level.contains(key) & ~answer
        return F.lit(False) if answer is None else answer


@dataclass(frozen=True)
class SplitCascade:
    """Cascades over the parts of a list: a key is asked of the cascade of its part."""

    parts: tuple[Cascade, ...]

    def contains(self, key: Column) -> Column:
        part, found = part_of(key, len(self.parts)), F.lit(False)
        for i, cascade in enumerate(self.parts):
            found = F.when(part == i, cascade.contains(key)).otherwise(found)
        return found


def part_of(key: Column, parts: int) -> Column:
    return F.pmod(F.xxhash64(F.lit("part"), key), F.lit(parts))


def build_cascade(listed: DataFrame, universe: DataFrame, column: str, max_bits: int | None = None) -> Cascade | SplitCascade:
    """``listed`` and ``universe`` hold keys in ``column``; ``universe`` may repeat them.

    The exact difference of the two is taken here, once, over the few keys that pass the first filter; asking
    needs none. Both sides shrink about a hundredfold every second level. A list whose first filter would have more than
    ``max_bits`` (MAX_BITS) is split by a hash of its keys, and so is the universe.
    """
    inside = materialize(listed.select(column).filter(F.col(column).isNotNull()).distinct(), "cascade-listed")
    n_inside = inside.count()
    parts = -(-n_inside * BITS_PER_KEY // (max_bits or MAX_BITS))
    if parts <= 1:
        return _one_cascade(inside, n_inside, universe, column)
    cascades = []
    for i in range(parts):
        here = part_of(F.col(column), parts) == i
        own = inside.filter(here)
        cascades.append(_one_cascade(own, own.count(), universe.filter(here), column))
    return SplitCascade(tuple(cascades))


def _one_cascade(inside: DataFrame, n_inside: int, universe: DataFrame, column: str) -> Cascade:
    levels: list[Bloom] = []
    if not n_inside:
        return Cascade(())
    first = build(inside, column, n_inside, salt=0)
    levels.append(first)
    passed = universe.select(column).filter(F.col(column).isNotNull() & first.contains(F.col(column))).distinct()
    outside = materialize(passed.join(inside, column, "left_anti"), "cascade-passed")
    now, other = outside, inside
    while n_now := now.count():
        level = build(now, column, n_now, salt=len(levels))
        levels.append(level)
        now, other = materialize(other.filter(level.contains(F.col(column))), "cascade-passed"), now
    return Cascade(tuple(levels))

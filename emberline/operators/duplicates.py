"""Exact and key duplicates, and diagnostics of how the copies differ."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberline import schema as S
from emberline.functions.bitmaps import may_contain
from emberline.functions.columns import union_all
from emberline.functions.layout import deal
from emberline.functions.storage import materialize

#: With more repeated hashes than this, which may be too many to broadcast, rows are thinned before they are shuffled.
UNTHINNED_HASHES = 1_000_000


def exact_duplicate_groups(df: DataFrame) -> DataFrame:
    """Distinct rows that occur more than once, with ``copies``.

    Only a 64-bit hash per row is shuffled for the whole data. Rows whose hash repeats are then
    grouped on all columns, so a hash collision cannot make a false duplicate. The repeated hashes are
    written down first: their size is not known before, and whole rows would be shuffled to meet them.
    """
    hashed = df.withColumn("_hash", F.xxhash64(*df.columns))
    repeated = materialize(hashed.groupBy("_hash").agg(F.count("*").alias("_n"))
                           .where(F.col("_n") > 1).select("_hash"), "repeated-hashes")
    test = may_contain(repeated, "_hash") if repeated.count() > UNTHINNED_HASHES else None
    if test is not None:
        hashed = hashed.where(test)
    return (hashed.join(repeated, "_hash", "left_semi").groupBy(*df.columns)
            .agg(F.count("*").alias("copies")).where(F.col("copies") > 1))


def key_duplicate_groups(df: DataFrame, keys: list[str] = S.KEY_COLUMNS) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).where(F.col("copies") > 1)


def duplicate_totals(df: DataFrame, keys: list[str] = S.KEY_COLUMNS, by: list[str] | None = None) -> DataFrame:
    """(item, item_count): exact and key duplicate groups, their rows, and the surplus copies.

    With ``by`` (columns of ``df``) per value of them, where there are duplicates.
    """
    own = by or []
    totals = [F.count("*").alias("groups"), F.coalesce(F.sum("copies"), F.lit(0)).alias("rows")]
    exact = exact_duplicate_groups(df).groupBy(*own).agg(*totals)
    by_key = key_duplicate_groups(df, [*own, *keys]).groupBy(*own).agg(*totals)

    def rows(source: DataFrame, kind: str) -> DataFrame:
        return source.select(*own, F.inline(F.array(*[
            F.struct(F.lit(f"{kind}_{name}").alias("item"), value.alias("item_count")) for name, value in [
                ("duplicate_groups", F.col("groups")),
                ("duplicate_group_rows", F.col("rows")),
                ("duplicate_surplus_rows", F.col("rows") - F.col("groups"))]])))

    return union_all([rows(exact, "exact"), rows(by_key, "key")])


def rows_with_repeated_key(df: DataFrame, keys: list[str] = S.KEY_COLUMNS) -> DataFrame:
    """All rows of keys that occur more than once. NULL-safe on every key column.

    The whole data is shuffled only as (key, count); the rows themselves meet the repeated keys in
    a semi join, which runs as a broadcast when those keys measure small.
    """
    repeated = key_duplicate_groups(df, keys).select([F.col(k).alias(f"_{k}") for k in keys])
    condition = F.lit(True)
    for k in keys:
        condition = condition & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return df.join(repeated, condition, "left_semi")


def duplicate_diagnostics(df: DataFrame, keys: list[str] = S.KEY_COLUMNS) -> DataFrame:
    """Per repeated key: rows, distinct rows, and distinct values of the columns that may differ."""
    measured = {
        "n_distinct_texts": "review", "n_distinct_languages": "language", "n_distinct_updated": S.UPDATED,
        "n_distinct_playtime": "author_playtime_forever", "n_distinct_votes_up": "votes_up",
        "n_distinct_scores": S.SCORE_COLUMN}
    return rows_with_repeated_key(df, keys).groupBy(*keys).agg(
        F.count("*").alias("n_rows"),
        F.count_distinct(F.struct(*df.columns)).alias("n_distinct_rows"),
        *[F.count_distinct(column).alias(name) for name, column in measured.items()])


def conflicting_rows(df: DataFrame, keys: list[str] = S.KEY_COLUMNS) -> DataFrame:
    """Rows of repeated keys whose copies are not all identical."""
    differing = (rows_with_repeated_key(df, keys).groupBy(*keys)
                 .agg(F.count_distinct(F.struct(*df.columns)).alias("_versions"))
                 .where(F.col("_versions") > 1).select([F.col(k).alias(f"_{k}") for k in keys]))
    condition = F.lit(True)
    for k in keys:
        condition = condition & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return df.join(differing, condition, "left_semi")


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    """Distinct rows, in parts of bounded size; copies of a row take no memory where they meet."""
    return deal(df, df.columns).dropDuplicates()

"""Exploration of the review table: cardinalities, summaries, top lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberline import schema as S
from emberline.functions.columns import long_form
from emberline.operators.frequent import frequent_values
from emberline.operators.quantiles import COUNT, VALUE, describe

SUMMARY_COLUMNS = ["author_playtime_forever", "author_num_games_owned", "votes_up", "comment_count"]


def cardinality(df: DataFrame) -> DataFrame:
    """Rows, distinct users and distinct apps, from partial (user, app) counts."""
    pairs = df.groupBy(S.USER, S.APP).agg(F.count("*").alias("n"))
    return pairs.agg(F.sum("n").alias("row_count"), F.count_distinct(S.USER).alias("user_count"),
                     F.count_distinct(S.APP).alias("app_count"))


def extremes(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, min_value, max_value, mean_value) of numeric columns in one pass."""
    wide = df.selectExpr(*[f"struct(min({c}) AS lo, max({c}) AS hi, avg({c}) AS mid) AS {c}" for c in columns])
    return long_form(wide, columns, {"min_value": "CAST({c}.lo AS DOUBLE)", "max_value": "CAST({c}.hi AS DOUBLE)",
                                     "mean_value": "{c}.mid"})


def time_range(df: DataFrame, column: str = S.CREATED) -> DataFrame:
    return df.agg(F.min(column).alias("first_ts"), F.max(column).alias("last_ts"))


def summary(df: DataFrame, columns: list[str] = SUMMARY_COLUMNS) -> DataFrame:
    return describe(df, columns, [0.25, 0.5, 0.75])


def value_frequencies(df: DataFrame, column: str, drop_null: bool = False) -> DataFrame:
    source = df.where(F.col(column).isNotNull()) if drop_null else df
    return source.groupBy(column).agg(F.count("*").alias("review_count")).orderBy(F.desc("review_count"), column)


def top_by(df: DataFrame, key: str, measure: Column, name: str, n: int = 10) -> DataFrame:
    """The n keys with the largest measure; equal measures are ordered by key."""
    return df.groupBy(key).agg(measure.alias(name)).orderBy(F.desc(name), F.asc_nulls_last(key)).limit(n)


def most_frequent(df: DataFrame, key: str, name: str, n: int = 10) -> DataFrame:
    """The n keys of the most rows, NULL among them, without shuffling every key; equal counts are ordered by key."""
    kind = df.schema[key].dataType.simpleString()
    known = frequent_values(df, [key], n, ties=kind).select(F.col(VALUE).cast(kind).alias(key), F.col(COUNT).alias(name))
    unknown = df.where(F.col(key).isNull()).agg(F.count("*").alias(name)).where(F.col(name) > 0)
    both = known.unionByName(unknown.withColumn(key, F.lit(None).cast(kind)))
    return both.orderBy(F.desc(name), F.asc_nulls_last(key)).limit(n)


def top_users(df: DataFrame, n: int = 10) -> DataFrame:
    return most_frequent(df, S.USER, "review_count", n)


def top_users_by_games(df: DataFrame, n: int = 10) -> DataFrame:
    return top_by(df, S.USER, F.count_distinct(S.APP), "games", n)


def top_apps(df: DataFrame, n: int = 10) -> DataFrame:
    return most_frequent(df, S.APP, "review_count", n)


def preview(df: DataFrame, order: list[str], n: int = 5) -> DataFrame:
    return df.orderBy(*order).limit(n)

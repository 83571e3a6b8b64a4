"""Repeatable user-level sampling and splitting.

Membership is a function of the user id alone (an MD5 bucket), so neither a join with a user list
nor a shuffle is needed, and the same users are chosen on every cluster and after every retry.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emberline import schema as S
from emberline.functions.bitmaps import may_contain
from emberline.functions.columns import hash_bucket, union_all
from emberline.operators.quantiles import exact_cutoffs
from emberline.operators.timeline import until

BUCKETS = 10_000
PREFIX_DIGITS = 5


def user_share(share: float, user: str = S.USER, salt: str = "") -> Column:
    return hash_bucket(user, BUCKETS, salt) < round(share * BUCKETS)


def sample_users_until(df: DataFrame, share: float = 0.02, quantile: float = 0.95) -> DataFrame:
    """All rows of a share of the users, up to a quantile of the event time."""
    return until(df, time_quantile(df, quantile)).where(user_share(share))


def time_quantile(df: DataFrame, quantile: float) -> Column:
    return exact_cutoffs(df, S.CREATED, {"cutoff": quantile}).scalar()


def in_sample(df: DataFrame, share: float = 0.02, quantile: float = 0.95) -> Column:
    """Whether a row is one of ``sample_users_until``."""
    return user_share(share) & (F.col(S.CREATED) <= time_quantile(df, quantile))


def rows_of_users(df: DataFrame, users: DataFrame, user: str = S.USER) -> DataFrame:
    """Rows whose user is in a given user table, which may repeat users.

    A Bloom filter of the users drops nearly all other rows where they are read; what passes meets the users in an exact
    semi join, whose hot users AQE splits. Spark broadcasts the users only if they measure small.
    """
    passes = may_contain(users, user)
    rows = df if passes is None else df.where(passes)
    return rows.join(users.select(user).where(F.col(user).isNotNull()).distinct(), user, "left_semi")


def size_report(**frames: DataFrame) -> DataFrame:
    """(dataset, row_count, user_count) of each named frame."""
    return union_all([
        df.groupBy(S.USER).agg(F.count("*").alias("n"))
        .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"), F.count(S.USER).alias("user_count"))
        .select(F.lit(name).alias("dataset"), "row_count", "user_count")
        for name, df in frames.items()])


def sample_rows(df: DataFrame, n: int, keys: list[str] = S.KEY_COLUMNS) -> DataFrame:
    """n rows in the order of an MD5 of their key: uniform over keys and repeatable.

    The digests are counted by their first digits first. Only rows up to the digits at which n is reached, n and
    a millionth of all rows or so, are ever sorted.
    """
    key_text = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])
    others = [F.col(c).asc_nulls_first() for c in df.columns if c not in keys]
    ordered = df.withColumn("_order", F.md5(key_text))
    digits = F.substring("_order", 1, PREFIX_DIGITS)
    reached = (ordered.groupBy(digits.alias("digits")).agg(F.count("*").alias("n"))  # 16 ** PREFIX_DIGITS rows at most
               .withColumn("upto", F.sum("n").over(Window.partitionBy(F.lit(1)).orderBy("digits"))))
    cut = F.coalesce(reached.where(F.col("upto") >= n).agg(F.min("digits")).scalar(), F.lit("g"))
    return ordered.where(digits <= cut).orderBy("_order", *keys, *others).limit(n).drop("_order")


def split_users(df: DataFrame, train_share: float = 0.8, user: str = S.USER) -> tuple[DataFrame, DataFrame]:
    """(train, test): each user is in one part only. Rows without a user are in neither."""
    known = df.where(F.col(user).isNotNull())
    inside = user_share(train_share, user)
    return known.where(inside), known.where(~inside)


def split_report(df: DataFrame, train_share: float = 0.8) -> DataFrame:
    """Rows and users per part, from one pass over the data."""
    part = F.when(user_share(train_share), "train").otherwise("test")
    per_user = df.where(F.col(S.USER).isNotNull()).groupBy(S.USER).agg(F.count("*").alias("n"))
    return per_user.groupBy(part.alias("dataset")).agg(
        F.sum("n").alias("row_count"), F.count("*").alias("user_count"))

"""Declared schemas, column groups and limits.

Everything here is a fixed value that other tools reading or writing the same tables must
agree on: column names, types and order, value limits, and the seconds in a day.
"""

from __future__ import annotations

from pyspark.sql import types as T

REVIEW_SCHEMA: dict[str, T.DataType] = {
    "author_steamid": T.LongType(),
    "appid": T.IntegerType(),
    "author_num_games_owned": T.IntegerType(),
    "author_num_reviews": T.IntegerType(),
    "author_playtime_forever": T.IntegerType(),
    "author_playtime_last_two_weeks": T.IntegerType(),
    "author_playtime_at_review": T.IntegerType(),
    "author_last_played": T.LongType(),
    "review": T.StringType(),
    "voted_up": T.BooleanType(),
    "votes_up": T.IntegerType(),
    "votes_funny": T.LongType(),
    "weighted_vote_score": T.FloatType(),
    "comment_count": T.IntegerType(),
    "written_during_early_access": T.BooleanType(),
    "language": T.StringType(),
    "timestamp_created": T.LongType(),
    "timestamp_updated": T.LongType(),
}

CATALOG_SCHEMA: dict[str, T.DataType] = {
    "appid": T.IntegerType(),
    "name": T.StringType(),
    "release_date": T.StringType(),
    "price": T.DoubleType(),
    "genres": T.StringType(),
    "tags": T.StringType(),
    "peak_ccu": T.IntegerType(),
    "estimated_owners": T.StringType(),
    "average_playtime_forever": T.IntegerType(),
    "pct_pos_total": T.IntegerType(),
    "num_reviews_total": T.IntegerType(),
}

COMPETITORS_TYPE = "array<struct<appid:int,name:string,release_date:string,similarity:double>>"

USER = "author_steamid"
APP = "appid"
CREATED = "timestamp_created"
UPDATED = "timestamp_updated"
LAST_PLAYED = "author_last_played"
KEY_COLUMNS = [USER, APP, CREATED]
EPOCH_COLUMNS = [CREATED, UPDATED, LAST_PLAYED]

COUNT_COLUMNS = [
    "author_num_games_owned",
    "author_num_reviews",
    "author_playtime_forever",
    "author_playtime_last_two_weeks",
    "author_playtime_at_review",
    "votes_up",
    "votes_funny",
    "comment_count",
]
SCORE_COLUMN = "weighted_vote_score"
NUMERIC_COLUMNS = [*COUNT_COLUMNS, SCORE_COLUMN]
BOOLEAN_COLUMNS = ["voted_up", "written_during_early_access"]

SECONDS_PER_DAY = 86_400
TWO_WEEKS_MINUTES = 14 * 24 * 60
NEAR_TWO_WEEKS_MINUTES = 18_144
UINT32_MAX = 4_294_967_295
UINT32_ARTIFACT_FROM = 4_000_000_000

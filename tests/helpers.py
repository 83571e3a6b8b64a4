from pyspark.sql import types as T

from emberline.schema import REVIEW_SCHEMA

DEFAULTS = {"author_steamid": 1, "appid": 1, "author_num_games_owned": 1, "author_num_reviews": 1,
            "author_playtime_forever": 100, "author_playtime_last_two_weeks": 0, "author_playtime_at_review": 50,
            "author_last_played": 1, "review": "text", "voted_up": True, "votes_up": 1, "votes_funny": 0,
            "weighted_vote_score": 0.5, "comment_count": 0, "written_during_early_access": False,
            "language": "english", "timestamp_created": 1, "timestamp_updated": 1}


def rows_frame(spark, rows):
    """A review frame from partial rows; what a row does not name takes a harmless default."""
    struct = T.StructType([T.StructField(name, kind) for name, kind in REVIEW_SCHEMA.items()])
    return spark.createDataFrame([tuple({**DEFAULTS, **row}[name] for name in REVIEW_SCHEMA) for row in rows], struct)

"""Which genres and tags occur together. Pairs are formed inside a game's own array: no join.

A game's arrays are short, so two explodes of one row are bounded, and counts are summed before
they are shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberline.operators.catalog import genres_of, tag_counts, tags_of

#: Columns that a matrix may have.
MATRIX_COLUMNS = 5_000


def genres_with(parsed: DataFrame, genre: str, remove_self: bool = True) -> DataFrame:
    counts = (parsed.where(F.array_contains("genres_array", genre)).select(F.explode("genres_array").alias("genre"))
              .groupBy("genre").agg(F.count("*").alias("game_count")))
    return counts.where(F.col("genre") != genre) if remove_self else counts


def tags_with(parsed: DataFrame, tag: str, remove_self: bool = True) -> DataFrame:
    counts = (tags_of(parsed.where(F.map_contains_key("tags_map", tag)))
              .groupBy("tag").agg(F.count("*").alias("game_count")))
    return counts.where(F.col("tag") != tag) if remove_self else counts


def _pairs(df: DataFrame, array: str, item: str) -> DataFrame:
    return (df.select(array, F.explode(array).alias(f"{item}_1"))
            .select(f"{item}_1", F.explode(array).alias(f"{item}_2"))
            .groupBy(f"{item}_1", f"{item}_2").agg(F.count("*").alias("pair_count")))


def genre_pairs(parsed: DataFrame) -> DataFrame:
    """Ordered genre pairs with the number of games that hold both; includes (g, g)."""
    return _pairs(parsed, "genres_array", "genre")


def tag_pairs(parsed: DataFrame, n: int = 20) -> DataFrame:
    """Ordered pairs among the n most frequent tags. The n tags are one scalar array."""
    chosen = tag_counts(parsed, n).agg(F.collect_list("tag").alias("tags")).scalar()
    kept = parsed.select(F.array_intersect(F.map_keys("tags_map"), chosen).alias("tags"))
    return _pairs(kept, "tags", "tag")


def genre_matrix(parsed: DataFrame, genres: list[str] | None = None, most: int = MATRIX_COLUMNS) -> DataFrame:
    """Pair counts as a matrix with one column per genre of the catalogue, or of ``genres``; absent pairs are 0.

    The genres of a catalogue are a small dimension: they become columns, so the driver has to know them. More than
    ``most`` are an error; ``genre_pairs`` has the same counts as rows, for any number.
    """
    if genres is None:
        genres = [row.genre for row in genres_of(parsed).distinct().orderBy("genre").limit(most + 1).collect()]
        if len(genres) > most:
            raise ValueError(f"more than {most} genres: use genre_pairs, or name the genres")
    return (genre_pairs(parsed).groupBy("genre_1").pivot("genre_2", genres).agg(F.sum("pair_count"))
            .na.fill(0))

"""Row cleaning: incomplete rows, artifact rows, copies, older versions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from emberline import schema as S
from emberline.functions.columns import is_missing
from emberline.functions.layout import deal
from emberline.operators.duplicates import drop_exact_duplicates


def _complete(df: DataFrame):
    test = F.lit(True)
    for field in df.schema.fields:
        test = test & ~is_missing(df, field.name, nan=True)
    return test


def drop_incomplete(df: DataFrame) -> DataFrame:
    """Rows without NULL or NaN. One test per column: each reaches the Parquet scan by itself, and
    the optimizer can reason about it, which it cannot about one test over all columns."""
    return df.where(_complete(df))


def drop_artifacts(df: DataFrame) -> DataFrame:
    return df.where(F.col("votes_funny") < S.UINT32_ARTIFACT_FROM)


def keep_latest(df: DataFrame, keys: list[str] = S.KEY_COLUMNS, version: str = S.UPDATED,
                counted: DataFrame | None = None) -> DataFrame:
    """One row per key: the latest version, ties broken by every other column (DESC, NULLs last).

    Rows are dealt by key into parts of bounded size (``counted`` as in ``deal``), so that no task sorts more of a
    larger table; a part with a key of very many rows is sorted on disk. Of small tables, ``row_number() = 1`` lets
    Spark drop older versions inside each input partition before the shuffle.
    """
    others = [c for c in df.columns if c not in (*keys, version)]
    order = [F.col(c).desc_nulls_last() for c in [version, *others]]
    ranked = deal(df, keys, counted).withColumn("_version", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("_version") == 1).drop("_version")


def clean_reviews(df: DataFrame) -> DataFrame:
    """Incomplete rows, artifacts, copies and older versions removed; idempotent.

    Exact copies share their key, so keeping one version per key removes them as well: one shuffle.
    """
    return keep_latest(drop_artifacts(drop_incomplete(df)), counted=df)


def step_counts(df: DataFrame) -> DataFrame:
    """Rows left after each step: (step, step_name, row_count)."""
    tests = df.agg(
        F.count("*").alias("input"),
        F.count_if(_complete(df)).alias("drop_incomplete"),
        F.count_if(_complete(df) & (F.col("votes_funny") < S.UINT32_ARTIFACT_FROM)).alias("drop_artifacts"))
    kept = drop_artifacts(drop_incomplete(df))
    # Copies and versions are counted per key first, so both totals come from one shuffle of hashes.
    groups = (kept.groupBy(*S.KEY_COLUMNS, F.xxhash64(*kept.columns).alias("_hash")).agg(F.lit(1).alias("_one"))
              .groupBy(*S.KEY_COLUMNS).agg(F.count("*").alias("versions"))
              .agg(F.sum("versions").alias("drop_exact_duplicates"), F.count("*").alias("keep_latest")))

    def rows(source: DataFrame, names: list[tuple[int, str]]) -> DataFrame:
        return source.select(F.inline(F.array(*[
            F.struct(F.lit(i).alias("step"), F.lit(n).alias("step_name"),
                     F.coalesce(F.col(n), F.lit(0)).alias("row_count")) for i, n in names])))

    return rows(tests, [(0, "input"), (1, "drop_incomplete"), (2, "drop_artifacts")]).unionByName(
        rows(groups, [(3, "drop_exact_duplicates"), (4, "keep_latest")]))


__all__ = ["clean_reviews", "drop_artifacts", "drop_exact_duplicates", "drop_incomplete", "keep_latest", "step_counts"]

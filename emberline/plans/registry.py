"""What a registered query is, and small helpers for result columns."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


@dataclass(frozen=True)
class Query:
    """A Spark query and the SQL it is checked against (None: checked by tests instead)."""

    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


def rounded(df: DataFrame, places: int) -> DataFrame:
    """Round the floating columns, so that results do not depend on the order of summation."""
    return df.selectExpr(*[
        f"round(`{f.name}`, {places}) AS `{f.name}`" if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else f"`{f.name}`"
        for f in df.schema.fields])

"""Column expressions shared by the operators. All stay inside the JVM."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def safe_rate(count: Column, total: Column) -> Column:
    """count / total as DOUBLE; NULL when the total is zero or NULL."""
    return F.try_divide(count.cast("double"), total.cast("double"))


def typed(column: str, data_type: T.DataType) -> Column:
    """Cast that turns malformed text into NULL instead of failing under ANSI mode."""
    return F.col(column).try_cast(data_type).alias(column)


def epoch_seconds(df: DataFrame, column: str) -> Column:
    """Epoch seconds of a LONG, TIMESTAMP or TIMESTAMP_NTZ column, whatever the session zone."""
    data_type = df.schema[column].dataType
    if isinstance(data_type, T.TimestampNTZType):
        return F.expr(f"timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{column}`)")
    if isinstance(data_type, T.TimestampType):
        return F.unix_seconds(F.col(column))
    return F.col(column).cast("long")


def utc_day(df: DataFrame, column: str) -> Column:
    """The day (DATE) of a DATE, TIMESTAMP, TIMESTAMP_NTZ or epoch-second column, in UTC whatever the session zone."""
    if isinstance(df.schema[column].dataType, T.DateType):
        return F.col(column)
    days = F.floor(epoch_seconds(df, column) / 86400).cast("int")
    return F.date_add(F.lit("1970-01-01").cast("date"), days)


def hash_bucket(column: str | Column, buckets: int = 10_000, salt: str = "") -> Column:
    """Repeatable bucket of an id: first 32 bits of the MD5 of its text, modulo ``buckets``.

    It depends on the value only, never on the partition layout, so a split or a sample comes
    out the same on any cluster and after any retry. A salt gives an independent bucketing.
    """
    text = (F.col(column) if isinstance(column, str) else column).cast("string")
    if salt:
        text = F.concat(F.lit(f"{salt}:"), text)
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % buckets


def is_missing(df: DataFrame, column: str, nan: bool = False, blank: bool = False) -> Column:
    """NULL test that can also take NaN (floating columns) and blank text as missing."""
    data_type = df.schema[column].dataType
    test = F.col(column).isNull()
    if nan and isinstance(data_type, (T.DoubleType, T.FloatType)):
        test = test | F.isnan(column)
    if blank and isinstance(data_type, T.StringType):
        test = test | (F.trim(F.col(column)) == "")
    return test


def rate_sql(count: str, total: str) -> str:
    return f"try_divide(CAST({count} AS DOUBLE), CAST({total} AS DOUBLE))"


def count_each(df: DataFrame, tests: dict[str, str], by: list[str] | None = None) -> DataFrame:
    """One row (per ``by``): ``_rows`` and, per name, how many rows pass the SQL test. One pass over the data."""
    return df.groupBy(*by or []).agg(F.count("*").alias("_rows"), *[F.expr(f"count_if({test}) AS `{name}`") for name, test in tests.items()])


def long_form(one_row: DataFrame, names: list[str], values: dict[str, str],
              name_column: str = "column_name") -> DataFrame:
    """Turn a one-row wide aggregate into one row per name.

    ``values`` maps each output column to SQL text in which ``{c}`` stands for the quoted name.
    """
    entries = [
        f"named_struct('{name_column}', '{name}', "
        + ", ".join(f"'{column}', " + text.replace("{c}", f"`{name}`") for column, text in values.items()) + ")"
        for name in names]
    return one_row.selectExpr(f"inline(array({', '.join(entries)}))")


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda left, right: left.unionByName(right), parts)

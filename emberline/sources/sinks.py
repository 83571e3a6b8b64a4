"""Sinks: snappy Parquet for datasets; CSV, JSON or Parquet for reports."""

from __future__ import annotations

from pyspark.sql import DataFrame

#: Rows of a CSV file. One with line breaks inside texts is read whole by one task.
CSV_FILE_ROWS = 100_000


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    writer = df.write.mode("overwrite").option("compression", "snappy")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_report(df: DataFrame, root: str, name: str, fmt: str = "parquet") -> str:
    """Write one report to ``root/name`` and return that path."""
    path = f"{root.rstrip('/')}/{name}"
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", True).option("escape", '"').option("maxRecordsPerFile", CSV_FILE_ROWS).csv(path)
    elif fmt == "json":
        writer.option("ignoreNullFields", False).json(path)
    elif fmt == "parquet":
        writer.option("compression", "snappy").parquet(path)
    else:
        raise ValueError(f"unknown report format: {fmt}")
    return path

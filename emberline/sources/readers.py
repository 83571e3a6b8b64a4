"""Typed scans. Types are declared, never inferred, so no file is read twice."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emberline.functions.columns import typed
from emberline.schema import CATALOG_SCHEMA, REVIEW_SCHEMA


def read_csv_typed(spark: SparkSession, path: str, schema: dict[str, T.DataType],
                   multi_line: bool = False) -> DataFrame:
    """CSV with a header, projected and cast to ``schema``.

    Quotes inside quoted text are doubled. ``multi_line`` keeps line breaks inside quoted text
    together; such a file cannot be split over tasks, so it is off unless asked for.
    """
    raw = (spark.read.option("header", True).option("inferSchema", False)
           .option("escape", '"').option("multiLine", multi_line).csv(path))
    return raw.select([typed(name, data_type) for name, data_type in schema.items()])


_CORRUPT = "_corrupt"


def read_csv_rejects(spark: SparkSession, path: str, schema: dict[str, T.DataType], keys: list[str],
                     multi_line: bool = False) -> DataFrame:
    """What ``read_csv_typed`` can't take: (file, key, column_name, raw_text), one row per cell whose text didn't cast.

    A record with more or fewer fields than the header is one more row without a column, and its whole text. ``key``
    has the texts of the key columns, joined by ``|``. Typed rows and rejects are separate scans of the same files, so
    either can be had alone.
    """
    options = {"header": True, "inferSchema": False, "escape": '"', "multiLine": multi_line}
    names = spark.read.options(**options).csv(path).columns
    fields = T.StructType([T.StructField(c, T.StringType()) for c in [*names, _CORRUPT]])
    raw = spark.read.schema(fields).options(**options, columnPruning=False, columnNameOfCorruptRecord=_CORRUPT).csv(path)
    raw = raw.select("*", F.col("_metadata.file_name").alias("file"))
    cells = [F.struct(F.lit(c).alias("column_name"), F.when(F.col(c).try_cast(kind).isNull(), F.col(c)).alias("raw_text"))
             for c, kind in schema.items() if c in names and not isinstance(kind, T.StringType)]
    broken = F.struct(F.lit(None).cast("string").alias("column_name"), F.col(_CORRUPT).alias("raw_text"))
    key = F.concat_ws("|", *[F.coalesce(c, F.lit("")) for c in keys])
    return raw.select("file", key.alias("key"), F.inline(F.filter(F.array(*cells, broken), lambda c: c["raw_text"].isNotNull())))


def read_reviews_csv(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    return read_csv_typed(spark, path, REVIEW_SCHEMA, multi_line)


def read_catalog_csv(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    return read_csv_typed(spark, path, CATALOG_SCHEMA, multi_line)


def read_parquet(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def broken_key_rows(df: DataFrame, keys: list[str]) -> DataFrame:
    """How many rows have a key that did not parse: the trace broken CSV rows leave."""
    broken = F.lit(False)
    for key in keys:
        broken = broken | F.col(key).isNull()
    return df.agg(F.count("*").alias("row_count"), F.count_if(broken).alias("broken_key_rows"))

"""Small helpers that several operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

#: Rows of an Arrow batch that are turned into Python objects at a time.
SLICE_ROWS = 512

#: Characters that separate words: \x20 and \x09-\x0D. ``bytes.split()`` cuts exactly there.
SPACES = b" \t\n\x0b\x0c\r"

ASCII_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def arrow_schema(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(schema)


def map_rows(df: DataFrame, columns: list[str], schema: str,
             make: Callable[[], Callable[..., Iterable[tuple]]], slice_rows: int = SLICE_ROWS) -> DataFrame:
    """``make()`` runs once per task and returns a function from the columns of a slice to result rows.

    Only ``columns`` are read, so other columns of the table, whatever their names, play no part. A slice is
    a few hundred rows: memory follows the texts of one slice, not of a partition.
    """
    struct = T._parse_datatype_string(schema)
    out = arrow_schema(struct)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for start in range(0, batch.num_rows, slice_rows):
                part = batch.slice(start, slice_rows)
                rows = list(work(*(column.to_pylist() for column in part.columns)))
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(values, field.type) for values, field in zip(zip(*rows), out)], schema=out)

    return df.select(*[f"`{c}`" for c in columns]).mapInArrow(run, struct)

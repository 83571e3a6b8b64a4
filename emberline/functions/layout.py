"""How many parts a table is dealt into."""

from __future__ import annotations

from pyspark.sql import DataFrame

#: Rows of a part, about. Spark's own number of shuffle partitions is the same for tables of any size.
PART_ROWS = 250_000


def deal(df: DataFrame, keys: list[str], counted: DataFrame | None = None) -> DataFrame:
    """``df`` dealt by a hash of ``keys`` into parts that stay as large when the table grows.

    What groups or sorts by ``keys`` then needs no shuffle of its own. Small tables are left as they are. ``counted``
    is a table with as many rows or more that is cheaper to count.
    """
    rows = (df if counted is None else counted).count()
    if rows <= 4 * PART_ROWS:
        return df
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // PART_ROWS))
    return df.repartition(parts, *keys)

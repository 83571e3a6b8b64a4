"""Places of rows in their groups, however large a group is.

Rows are sorted by group and order in one distributed sort, so that a group may run over many partitions. Each
partition numbers its own rows, and what a group has in earlier partitions is added: no group meets in one task.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emberline.functions.storage import materialize


def ranked(df: DataFrame, group: list[str], order: list[Column], kind: str) -> DataFrame:
    """``df`` with ``rank`` (long, from 0): the place of the row in its group by ``order``, NULL groups included.

    Rows with equal group and order may take each other's places. The sorted rows are written to the shared folder.
    """
    keys = [F.col(c).asc_nulls_first() for c in group]
    rows = (df.withColumn("_salt", F.monotonically_increasing_id())  # so that equal rows, too, can be dealt out
            .orderBy(*keys, *order, "_salt").drop("_salt").withColumn("_at", F.monotonically_increasing_id()))
    rows = materialize(rows, kind).withColumn("_part", F.shiftright("_at", 33))
    counts = rows.groupBy(*group, "_part").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.withColumn("_before", F.sum("_n").over(earlier)).filter("_before > 0")  # fewer than partitions
    own = rows.withColumn("_own", F.row_number().over(Window.partitionBy(*group, "_part").orderBy("_at")))
    same = reduce(Column.__and__, [own[c].eqNullSafe(before[c]) for c in group], own["_part"] == before["_part"])
    return own.join(before, same, "left").select(
        *[own[c] for c in df.columns], (own["_own"] - 1 + F.coalesce(before["_before"], F.lit(0))).alias("rank"))


def running(df: DataFrame, key: list[str], at: str, columns: list[str], total: Callable[[str], Column],
            add: Callable[[Column, Column], Column], chunk: int = 4096) -> DataFrame:
    """``df`` with ``before_<column>``: the ``total`` of the column over the key's rows with a smaller ``at``, 0 for none.

    ``at`` is a long from 0, one row each. A long key is worked on in chunks of ``at``: ``add`` puts the total of the
    chunks before and that of the rows before together.
    """
    df = df.withColumn("_chunk", F.floor(F.col(at) / chunk))
    inside = Window.partitionBy(*key, "_chunk").orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    rows = df.select("*", *[total(c).over(inside).alias(f"_in_{c}") for c in columns])
    chunks = df.groupBy(*key, "_chunk").agg(*[total(c).alias(c) for c in columns])
    earlier = Window.partitionBy(*key).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = chunks.select(*key, "_chunk", *[total(c).over(earlier).alias(f"_by_{c}") for c in columns]).filter("_chunk > 0")
    zero = F.lit(0).cast("long")
    return rows.join(carried, [*key, "_chunk"], "left").select(
        *[c for c in df.columns if c != "_chunk"],
        *[add(F.coalesce(f"_by_{c}", zero), F.coalesce(f"_in_{c}", zero)).alias(f"before_{c}") for c in columns])

"""Event-time cuts that skip what lies behind them.

A log that is stored by event month has the month as its partition column. A cut by event time then also says up to
which month it reads: for a cutoff that is worked out in the same query, Spark prunes the partitions at run time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberline import schema as S
from emberline.functions.columns import epoch_seconds
from emberline.sources.sinks import write_parquet

MONTH = "event_month"


def month_of(seconds: Column) -> Column:
    """Months since the year 0, of epoch seconds, in UTC."""
    day = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(seconds / S.SECONDS_PER_DAY).cast("int"))
    return F.year(day) * 12 + F.month(day) - 1


def write_by_month(df: DataFrame, path: str, column: str = S.CREATED) -> None:
    """``df`` in a folder per month of ``column``; a month is dealt over tasks by Spark as its size needs."""
    months = df.withColumn(MONTH, month_of(epoch_seconds(df, column)))
    write_parquet(months.hint("rebalance", MONTH), path, partition_by=[MONTH])


def until(df: DataFrame, cutoff: Column, column: str = S.CREATED) -> DataFrame:
    """Rows up to and including ``cutoff`` (epoch seconds); of a log stored by month, only months that may hold them."""
    rows = df.where(epoch_seconds(df, column) <= cutoff)
    return rows.where(F.col(MONTH) <= month_of(cutoff)) if MONTH in df.columns else rows

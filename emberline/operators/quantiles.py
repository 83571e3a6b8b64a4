"""Exact order statistics without a global sort or a single-task buffer.

Spark's own exact ``percentile`` keeps every distinct value of a column in one task. Here each
column is first reduced to (value, count), which also flattens hot values, and the distinct
values are then ranked inside buckets that split each column evenly, as many as its distinct values
need. The bucket borders are the values whose hash lies under a threshold: a uniform, repeatable
sample, used for routing only, so results are exact whatever the borders are. Only the borders and
the bucket totals are broadcast, about columns x ``MAX_SPLITS`` of them at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emberline.functions.columns import count_each, long_form, union_all

SPLIT_VALUES = 65_536
MAX_SPLITS = 512
#: Size of a stored sketch: its rank error stays below a thousandth.
SKETCH_K = 8_192
_HASHES = 1 << 31
NAME, VALUE, COUNT = "column_name", "value", "value_count"


def known_values(df: DataFrame, column: str) -> str:
    """SQL text of a column without NaN and -0.0."""
    kind = df.schema[column].dataType
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return f"CASE WHEN NOT isnan(`{column}`) THEN `{column}` + CAST(0.0 AS {kind.simpleString()}) END"
    return f"`{column}`"


def value_counts(df: DataFrame, columns: list[str], value_type: str = "double", by: list[str] | None = None) -> DataFrame:
    """(column_name, value, value_count) of every known value, per ``by``; partial counts run before the shuffle.

    NaN is no value (``nan_counts`` reports it), and -0.0 is 0.0, also where values are taken as text.
    """
    keys = by or []
    typed = df.selectExpr(*keys, *[f"CAST({known_values(df, c)} AS {value_type}) AS `{c}`" for c in columns])
    return (typed.unpivot(keys, columns, NAME, VALUE).where(f"{VALUE} IS NOT NULL")
            .groupBy(*keys, NAME, VALUE).agg(F.count("*").alias(COUNT)))


def nan_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, nan_count), 0 for columns that can't hold NaN. One pass over the data."""
    floating = {c for c in columns if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType))}
    tests = {c: f"isnan(`{c}`)" if c in floating else "false" for c in columns}
    return long_form(count_each(df, tests), columns, {"nan_count": "{c}"})


def ranked_values(counts: DataFrame) -> DataFrame:
    """Add ``lo`` and ``hi`` (the value fills the 0-based ranks [lo, hi)) and ``total`` per column."""
    sizes = counts.groupBy(NAME).agg(F.count("*").alias("distinct"))
    # A column of one bucket's size has no borders at all.
    splits = F.least(F.floor(F.col("distinct") / SPLIT_VALUES), F.lit(MAX_SPLITS))
    picked = F.when(F.pmod(F.xxhash64(VALUE), F.lit(_HASHES)).cast("double") * F.col("distinct") < F.lit(_HASHES) * splits, F.col(VALUE))
    borders = (counts.join(F.broadcast(sizes), NAME)
               .groupBy(NAME).agg(F.sort_array(F.collect_list(picked)).alias("borders")))
    bucketed = (counts.join(F.broadcast(borders), NAME)
                .withColumn("bucket", F.expr(f"size(filter(borders, b -> b < {VALUE}))")).drop("borders"))
    along = Window.partitionBy(NAME).orderBy("bucket")
    totals = bucketed.groupBy(NAME, "bucket").agg(F.sum(COUNT).alias("bucket_rows"))
    offsets = totals.select(
        NAME, "bucket",
        (F.sum("bucket_rows").over(along) - F.col("bucket_rows")).alias("offset"),
        F.sum("bucket_rows").over(Window.partitionBy(NAME)).alias("total"))
    inside = Window.partitionBy(NAME, "bucket").orderBy(VALUE)
    ranked = (bucketed.join(F.broadcast(offsets), [NAME, "bucket"])
              .withColumn("hi", F.col("offset") + F.sum(COUNT).over(inside)))
    return ranked.select(NAME, VALUE, COUNT, (F.col("hi") - F.col(COUNT)).alias("lo"), "hi", "total")


def percentiles(ranked: DataFrame, fractions: list[float]) -> DataFrame:
    """Interpolated percentiles: (column_name, q, quantile)."""
    wanted = F.array(*[F.lit(q) for q in fractions])
    hits = ranked.select(NAME, VALUE, "lo", "hi", "total", F.explode(wanted).alias("q"))
    position = F.col("q") * (F.col("total") - 1)
    hits = (hits.withColumn("below", F.floor(position)).withColumn("above", F.ceil(position))
            .withColumn("weight", position - F.floor(position))
            .withColumn("is_below", (F.col("below") >= F.col("lo")) & (F.col("below") < F.col("hi")))
            .withColumn("is_above", (F.col("above") >= F.col("lo")) & (F.col("above") < F.col("hi")))
            .where(F.col("is_below") | F.col("is_above")))
    ends = hits.groupBy(NAME, "q").agg(
        F.max(F.when(F.col("is_below"), F.col(VALUE))).alias("low"),
        F.max(F.when(F.col("is_above"), F.col(VALUE))).alias("high"),
        F.max("weight").alias("weight"))
    return ends.select(NAME, "q", (F.col("low") + (F.col("high") - F.col("low")) * F.col("weight")).alias("quantile"))


def percentiles_disc(ranked: DataFrame, fractions: list[float]) -> DataFrame:
    """Discrete percentiles, always an existing value: (column_name, q, quantile)."""
    wanted = F.array(*[F.lit(q) for q in fractions])
    hits = ranked.select(NAME, VALUE, "lo", "hi", "total", F.explode(wanted).alias("q"))
    rank = F.greatest(F.ceil(F.round(F.col("q") * F.col("total"), 6)) - 1, F.lit(0))
    return (hits.where((rank >= F.col("lo")) & (rank < F.col("hi")))
            .select(NAME, "q", F.col(VALUE).alias("quantile")))


def exact_cutoffs(df: DataFrame, column: str, fractions: dict[str, float], value_type: str = "long") -> DataFrame:
    """One row holding the discrete percentile of ``column`` for each named fraction."""
    found = percentiles_disc(ranked_values(value_counts(df, [column], value_type)), list(fractions.values()))
    return found.agg(*[F.max(F.when(F.col("q") == q, F.col("quantile"))).alias(name)
                       for name, q in fractions.items()])


def approx_cutoffs(df: DataFrame, column: str, fractions: dict[str, float], accuracy: int = 1000) -> DataFrame:
    """Same shape from Spark's quantile sketch; cheaper, rank error up to 1 / accuracy."""
    sketch = F.percentile_approx(column, list(fractions.values()), accuracy)
    return (df.agg(sketch.alias("sketch"))
            .select([F.col("sketch")[i].cast("long").alias(name) for i, name in enumerate(fractions)]))


def time_sketches(df: DataFrame, column: str, part: Column, k: int = SKETCH_K) -> DataFrame:
    """(part, n, sketch): a quantile sketch of a LONG column per part of the data, to be stored and merged at will."""
    return df.where(F.col(column).isNotNull()).groupBy(part.alias("part")).agg(
        F.count("*").alias("n"), F.kll_sketch_agg_bigint(column, F.lit(k)).alias("sketch"))


def sketched_cutoffs(sketches: DataFrame, fractions: dict[str, float], k: int = SKETCH_K) -> DataFrame:
    """One row with the quantile for each named fraction, from stored sketches of any parts, without their data."""
    merged = sketches.agg(F.kll_merge_agg_bigint("sketch", F.lit(k)).alias("sketch"))
    return merged.select([F.kll_sketch_get_quantile_bigint("sketch", F.lit(q)).alias(name) for name, q in fractions.items()])


def rank_errors(df: DataFrame, column: str, cutoffs: dict[str, int], fractions: dict[str, float]) -> DataFrame:
    """(cutoff_name, row_count, rank_error): how far each cutoff's ranks are from its fraction of all rows, as a share."""
    tests = [f"named_struct('cutoff_name', '{name}', 'below', count_if({column} < {at}L), 'upto', count_if({column} <= {at}L), "
             f"'wanted', {fractions[name]}D * count({column}), 'row_count', count({column}))" for name, at in cutoffs.items()]
    ranks = df.selectExpr(f"array({', '.join(tests)}) AS ranks").selectExpr("inline(ranks)")
    off = F.greatest(F.col("below") - F.col("wanted"), F.col("wanted") - F.col("upto"), F.lit(0.0))
    return ranks.select("cutoff_name", "row_count", F.try_divide(off, F.col("row_count")).alias("rank_error"))


def describe(df: DataFrame, columns: list[str], fractions: list[float]) -> DataFrame:
    """Long-form summary (column_name, measure, measure_value): moments, extremes and percentiles."""
    counts = value_counts(df, columns)
    weight, value = F.col(COUNT).cast("double"), F.col(VALUE)
    total = F.sum(weight)
    # Moments around a fixed point of the column would need a second pass; sums over (value, count)
    # pairs of whole numbers are exact in DOUBLE up to 2^53.
    mean = F.sum(weight * value) / total
    moments = counts.groupBy(NAME).agg(
        total.alias("count"), mean.alias("mean"), F.min(VALUE).alias("min"), F.max(VALUE).alias("max"))
    spread = (counts.join(F.broadcast(moments.select(NAME, "mean", F.col("count").alias("n"))), NAME)
              .groupBy(NAME).agg(F.sqrt(F.try_divide(
                  F.sum(weight * F.pow(value - F.col("mean"), 2)), F.max("n") - 1)).alias("stddev")))
    parts = [
        moments.unpivot([NAME], ["count", "mean", "min", "max"], "measure", "measure_value"),
        spread.unpivot([NAME], ["stddev"], "measure", "measure_value"),
        percentiles(ranked_values(counts), fractions).select(
            NAME, F.concat(F.lit("p"), F.round(F.col("q") * 100).cast("int").cast("string")).alias("measure"),
            F.col("quantile").alias("measure_value")),
    ]
    return union_all(parts)

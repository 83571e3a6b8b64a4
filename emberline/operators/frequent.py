"""Most frequent and most extreme values by summaries that merge.

Every partition is summed up once, in bounded memory, whatever the number of distinct values: counters of its most
frequent values and how much they may miss, or its lowest and highest values. Only summaries are shuffled. Results are
exact: frequent values are counted again where counters may miss something, and a column whose values are too even for
counters to tell is counted in full.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emberline.functions.columns import union_all
from emberline.functions.storage import materialize
from emberline.operators.quantiles import COUNT, NAME, VALUE, known_values, value_counts

#: Counters that a partition keeps for a column.
COUNTERS = 4_096
_PARTS = 256
_SUMMARY = f"{NAME} string, {VALUE} string, {COUNT} long, missed long"
_ENDS = f"{NAME} string, side string, {VALUE} double, {COUNT} long"


class FrequentCounter:
    """Counts of the values most often seen. No value's count is more than ``missed`` too low."""

    def __init__(self, counters: int):
        self.counters, self.counts, self.missed = counters, Counter(), 0

    def add(self, values: pa.Array) -> None:
        found = pc.value_counts(values.drop_null())
        self.counts.update(dict(zip(found.field("values").to_pylist(), found.field("counts").to_pylist())))
        if len(self.counts) > 2 * self.counters:
            ordered = self.counts.most_common()
            self.missed += ordered[self.counters][1]
            self.counts = Counter(dict(ordered[:self.counters]))


def _counter_rows(typed: DataFrame, counters: int) -> DataFrame:
    """(column_name, value, value_count, missed) of every partition; ``missed`` stands in a row without a value."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns: dict[str, FrequentCounter] = {}
        for batch in batches:
            for name, values in zip(batch.schema.names, batch.columns):
                columns.setdefault(name, FrequentCounter(counters)).add(values)
        for name, counter in columns.items():
            n = len(counter.counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * (n + 1)), pa.array([*counter.counts, None], pa.string()),
                 pa.array([*counter.counts.values(), 0], pa.int64()), pa.array([0] * n + [counter.missed], pa.int64())],
                names=[NAME, VALUE, COUNT, "missed"])

    return typed.mapInArrow(run, _SUMMARY)


def first_of_each(rows: DataFrame, group: list[str], order: list[Column], n: int) -> DataFrame:
    """The first n rows of each group with their ``position``: cut down in parts of the group first, then put together."""
    parts = rows.withColumn("_part", F.pmod(F.xxhash64(VALUE), F.lit(_PARTS)))
    cut = parts.withColumn("_rank", F.row_number().over(Window.partitionBy(*group, "_part").orderBy(*order))).where(F.col("_rank") <= n)
    kept = cut.groupBy(*group).agg(F.collect_list(F.struct(VALUE, COUNT)).alias("rows"))  # _PARTS * n at most
    return kept.select(*group, F.inline("rows")).withColumn(
        "position", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col("position") <= n)


def frequent_values(df: DataFrame, columns: list[str], n: int, counters: int = COUNTERS, ties: str = "string") -> DataFrame:
    """(column_name, value, value_count, position): the n most frequent values of each column, as text.

    Ties are ordered by value, taken as the type ``ties``; NULL is no value.

    Counters settle a column if its n-th best count is larger than all that the partitions may have missed of any value:
    then only values that can be among the first n are counted again. Other columns are counted in full.
    """
    typed = df.selectExpr(*[f"CAST({known_values(df, c)} AS string) AS `{c}`" for c in columns])
    summed = materialize(_counter_rows(typed, counters).groupBy(NAME, VALUE).agg(
        F.sum(COUNT).alias(COUNT), F.sum("missed").alias("missed")), "frequent")
    order = [F.desc(COUNT), F.col(VALUE).cast(ties).asc()]
    missed = {r[NAME]: r.missed for r in summed.where(F.col(VALUE).isNull()).collect()}  # a row per column
    least: dict[str, int] = {c: 0 for c in columns}
    for r in first_of_each(summed.where(F.col(VALUE).isNotNull()), [NAME], order, n).where(F.col("position") == n).collect():
        least[r[NAME]] = r[COUNT]
    exact = [c for c in columns if not missed.get(c, 0)]
    told = [c for c in columns if 0 < missed.get(c, 0) < least[c]]
    full = [c for c in columns if c not in exact and c not in told]
    parts = [summed.where(F.col(VALUE).isNotNull() & F.col(NAME).isin(exact)).select(NAME, VALUE, COUNT)]
    if told:
        short = F.lit(False)
        for c in told:
            short = short | ((F.col(NAME) == c) & (F.col(COUNT) >= least[c] - missed[c]))
        candidates = summed.where(F.col(VALUE).isNotNull() & short).select(NAME, VALUE)
        cells = typed.select(*told).unpivot([], told, NAME, VALUE)
        parts.append(cells.join(candidates, [NAME, VALUE], "left_semi").groupBy(NAME, VALUE).agg(F.count("*").alias(COUNT)))
    if full:
        parts.append(value_counts(df, full, "string"))
    return first_of_each(union_all(parts), [NAME], order, n)


def extreme_values(df: DataFrame, columns: list[str], n: int) -> DataFrame:
    """(column_name, side, value, value_count, position): the n lowest and n highest distinct values of each column.

    What is among the n lowest of all is among the n lowest of each partition that has it, so that the partitions'
    counts add up to the whole ones.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = {}

        def ends(counter: Counter) -> dict[str, list[float]]:
            ordered = sorted(counter)
            return {"lowest": ordered[:n], "highest": ordered[-n:]}

        for batch in batches:
            for name, values in zip(batch.schema.names, batch.columns):
                counter = counts.setdefault(name, Counter())
                found = pc.value_counts(values.drop_null())
                counter.update(dict(zip(found.field("values").to_pylist(), found.field("counts").to_pylist())))
                if len(counter) > 4 * n + 1_000:
                    kept = ends(counter)
                    counts[name] = Counter({v: counter[v] for v in {*kept["lowest"], *kept["highest"]}})
        for name, counter in counts.items():
            rows = [(name, side, v, counter[v]) for side, values in ends(counter).items() for v in values]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=[NAME, "side", VALUE, COUNT])

    typed = df.selectExpr(*[f"CAST({known_values(df, c)} AS double) AS `{c}`" for c in columns])
    summed = typed.mapInArrow(run, _ENDS).groupBy(NAME, "side", VALUE).agg(F.sum(COUNT).alias(COUNT))
    near = F.when(F.col("side") == "lowest", F.col(VALUE)).otherwise(-F.col(VALUE))
    return first_of_each(summed, [NAME, "side"], [near], n)

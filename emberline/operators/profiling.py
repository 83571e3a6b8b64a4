"""Column profiles. Numeric profiles start from (column, value, count), so a value that fills a third
of a column is one row from the first shuffle on."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emberline.functions.columns import long_form, safe_rate
from emberline.functions.storage import materialize
from emberline.operators import frequent
from emberline.operators.audit import distinct_counts
from emberline.operators.duplicates import exact_duplicate_groups
from emberline.operators.quantiles import COUNT, NAME, VALUE, percentiles, ranked_values, value_counts

QUANTILES = [0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99]
BINS = 50
SKEWNESS_LIMIT = 20
IMBALANCE_LIMIT = 0.5
CARDINALITY_LIMIT = 50
CORRELATION_LIMIT = 0.9
#: Ranks of a column that are broadcast whole, and the share (its inverse) that makes a value of a longer one frequent.
RANKS = 65_536
FREQUENT = 4_096


def quantile_table(df: DataFrame, columns: list[str]) -> DataFrame:
    return percentiles(ranked_values(value_counts(df, columns)), QUANTILES)


def _column_stats(counts: DataFrame, *aggregates: Column) -> DataFrame:
    """One row per column: bounded by the number of columns, so always fit to broadcast."""
    return F.broadcast(counts.groupBy(NAME).agg(*aggregates))


def skewness(df: DataFrame, columns: list[str]) -> DataFrame:
    """Population skewness around the mean; ``highly_skewed`` above the limit."""
    counts = value_counts(df, columns)
    n = F.sum(COUNT)
    means = _column_stats(counts, (F.sum(F.col(VALUE) * F.col(COUNT)) / n).alias("mean"), n.alias("n"))
    gap = F.col(VALUE) - F.col("mean")
    moments = counts.join(means, NAME).groupBy(NAME).agg(
        (F.sum(F.col(COUNT) * F.pow(gap, 2)) / F.max("n")).alias("m2"),
        (F.sum(F.col(COUNT) * F.pow(gap, 3)) / F.max("n")).alias("m3"))
    return moments.select(NAME, F.try_divide(F.col("m3"), F.pow("m2", 1.5)).alias("skewness")).withColumn(
        "highly_skewed", F.abs("skewness") > SKEWNESS_LIMIT)


def _bin(value: Column, lo: Column, hi: Column, bins: int) -> Column:
    share = F.coalesce(F.try_divide(value - lo, hi - lo), F.lit(0.0))
    return F.least(F.floor(share * bins), F.lit(bins - 1)).cast("int")


def histogram(df: DataFrame, columns: list[str], bins: int = BINS) -> DataFrame:
    """Equal-width bins between minimum and maximum: (column_name, bin, bin_start, bin_count)."""
    counts = value_counts(df, columns)
    ends = _column_stats(counts, F.min(VALUE).alias("lo"), F.max(VALUE).alias("hi"))
    binned = counts.join(ends, NAME).withColumn("bin", _bin(F.col(VALUE), F.col("lo"), F.col("hi"), bins))
    return binned.groupBy(NAME, "bin").agg(
        F.max(F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("bin") / bins).alias("bin_start"),
        F.sum(COUNT).alias("bin_count"))


def boxplot(df: DataFrame, columns: list[str]) -> DataFrame:
    """Quartiles, whiskers (furthest values within 1.5 IQR) and the number of outliers."""
    counts = value_counts(df, columns)
    quartiles = percentiles(ranked_values(counts), [0.25, 0.5, 0.75]).groupBy(NAME).agg(
        *[F.max(F.when(F.col("q") == q, F.col("quantile"))).alias(name)
          for q, name in ((0.25, "q1"), (0.5, "median"), (0.75, "q3"))])
    fences = quartiles.withColumn("reach", 1.5 * (F.col("q3") - F.col("q1")))
    inside = (F.col(VALUE) >= F.col("q1") - F.col("reach")) & (F.col(VALUE) <= F.col("q3") + F.col("reach"))
    return counts.join(F.broadcast(fences), NAME).groupBy(NAME, "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col(VALUE))).alias("whisker_low"),
        F.max(F.when(inside, F.col(VALUE))).alias("whisker_high"),
        F.coalesce(F.sum(F.when(~inside, F.col(COUNT))), F.lit(0)).alias("n_outliers"))


def categories(df: DataFrame, columns: list[str], n: int = 10) -> DataFrame:
    """The n most frequent values per column."""
    return frequent.frequent_values(df, columns, n)


def imbalance(df: DataFrame, columns: list[str]) -> DataFrame:
    """1 - entropy / log2(number of values): 0 is even, 1 is one value only."""
    counts = value_counts(df, columns, "string")
    totals = _column_stats(counts, F.sum(COUNT).alias("n"))
    share = F.col(COUNT) / F.col("n")
    out = counts.join(totals, NAME).groupBy(NAME).agg(
        F.count("*").alias("n_values"), (-F.sum(share * F.log2(share))).alias("entropy"))
    score = F.when(F.col("n_values") > 1, 1 - F.col("entropy") / F.log2(F.col("n_values").cast("double"))).otherwise(1.0)
    return out.select(NAME, "n_values", score.alias("imbalance")).select(
        "*", (F.col("imbalance") > IMBALANCE_LIMIT).alias("is_imbalanced"),
        (F.col("n_values") > CARDINALITY_LIMIT).alias("high_cardinality"))


def extreme_values(df: DataFrame, columns: list[str], n: int = 5) -> DataFrame:
    """The n lowest and n highest distinct values per column, with their counts."""
    return frequent.extreme_values(df, columns, n)


def pearson(df: DataFrame, columns: list[str]) -> DataFrame:
    """All column pairs from one aggregate."""
    pairs = list(combinations(columns, 2))
    wide = df.selectExpr(*[f"corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)) AS `{a}|{b}`" for a, b in pairs])
    return _pair_table(wide, pairs, "pearson")


def _pair_table(wide: DataFrame, pairs: list[tuple[str, str]], measure: str) -> DataFrame:
    long = long_form(wide, [f"{a}|{b}" for a, b in pairs], {measure: "{c}"})
    parts = F.split(NAME, r"\|")
    return long.select(parts[0].alias("column_1"), parts[1].alias("column_2"), measure,
                       (F.abs(measure) > CORRELATION_LIMIT).alias("highly_correlated"))


def spearman(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlation of average ranks, over the rows where both columns are known.

    Ranks come from the distributed ranking of each column's distinct values and are centred, so that the sums stay
    accurate. Columns with up to ``RANKS`` distinct values look their ranks up in a broadcast table: no row moves. Of a
    column with more, only the values that fill a ``FREQUENT``-th of it or more are broadcast, ``FREQUENT`` at most; its
    other values go as (row, column, value) to the ranks and come back to their rows: two shuffles for all such columns
    together, in which no key is hot.
    """
    middle = (F.col("lo") + F.col("hi") - F.col("total")) / 2.0
    ranks = materialize(ranked_values(value_counts(df, columns)).select(NAME, VALUE, COUNT, "total", middle.alias("rank")), "ranks")
    distinct = {row[NAME]: row.n for row in ranks.groupBy(NAME).agg(F.count("*").alias("n")).collect()}
    large = [c for c in columns if distinct.get(c, 0) > RANKS]
    rows = df.select([F.nullif(F.col(c).cast("double") + 0.0, F.lit(float("nan"))).alias(c) for c in columns])
    if large:
        rows = materialize(rows.withColumn("_id", F.monotonically_increasing_id()), "rank-rows")
    for c in columns:
        own = ranks.where((F.col(NAME) == c) & ((F.col(COUNT) * FREQUENT >= F.col("total")) if c in large else F.lit(True)))
        rows = rows.join(F.broadcast(own.select(F.col(VALUE).alias(c), F.col("rank").alias(f"_r_{c}"))), c, "left")
    if large:
        rows = _with_rare_ranks(rows, ranks, columns, large)
    pairs = list(combinations(columns, 2))
    return _pair_table(rows.selectExpr(*[f"corr(`_r_{a}`, `_r_{b}`) AS `{a}|{b}`" for a, b in pairs]), pairs, "spearman")


def _with_rare_ranks(rows: DataFrame, ranks: DataFrame, columns: list[str], large: list[str]) -> DataFrame:
    """The ranks of each row (``_id``), those that no broadcast table had looked up among ``ranks``."""
    cells = [F.struct(F.lit(c).alias(NAME), F.when(F.col(f"_r_{c}").isNull(), F.col(c)).alias(VALUE)) for c in large]
    rare = rows.select("_id", F.inline(F.array(*cells))).where(F.col(VALUE).isNotNull())
    found = rare.join(ranks.select(NAME, VALUE, "rank"), [NAME, VALUE]).select("_id", NAME, "rank")
    known = rows.select("_id", *[f"_r_{c}" for c in columns])
    together = known.unionByName(found, allowMissingColumns=True)
    return together.groupBy("_id").agg(*[
        F.max(F.coalesce(f"_r_{c}", F.when(F.col(NAME) == c, F.col("rank")))).alias(f"_r_{c}") for c in columns])


def nullity_correlation(df: DataFrame) -> DataFrame:
    """Correlation of the NULL flags of column pairs; pairs without variation are left out.

    Only the names of NULL cells are counted, which are few, not all pairs of all rows.
    """
    names = F.filter(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in df.columns]), lambda x: x.isNotNull())
    seen = (df.select(names.alias("a")).where(F.size("a") > 0)
            .select("a", F.explode("a").alias("c1")).select("c1", F.explode("a").alias("c2"))
            .groupBy("c1", "c2").agg(F.count("*").alias("n")))
    lookup = seen.agg(F.map_from_entries(F.collect_list(F.struct(F.concat_ws("|", "c1", "c2"), "n")))).scalar()
    total = df.agg(F.count("*").cast("double").alias("n"), lookup.alias("m"))

    def n_of(a: str, b: str) -> str:
        return f"CAST(coalesce(try_element_at(m, '{a}|{b}'), 0) AS DOUBLE)"

    cells = ", ".join(
        f"named_struct('column_1', '{a}', 'column_2', '{b}', 'n1', {n_of(a, a)}, 'n2', {n_of(b, b)}, 'n12', {n_of(a, b)})"
        for a, b in combinations(df.columns, 2))
    n, n1, n2, n12 = (F.col(c) for c in ("n", "n1", "n2", "n12"))
    phi = F.try_divide(n * n12 - n1 * n2, F.sqrt(n1 * (n - n1) * n2 * (n - n2)))
    return (total.selectExpr("n", f"inline(array({cells}))")
            .select("column_1", "column_2", phi.alias("nullity_correlation"))
            .where(F.col("nullity_correlation").isNotNull()))


def duplicate_share(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier row, and their share of all rows."""
    rows = df.agg(F.count("*").alias("n")).scalar()
    surplus = exact_duplicate_groups(df).agg(
        (F.coalesce(F.sum("copies"), F.lit(0)) - F.count("*")).alias("n_duplicates"))
    return surplus.select("n_duplicates", safe_rate(F.col("n_duplicates"), rows).alias("p_duplicates"))


def head_tail(df: DataFrame, order: list[str], n: int = 5) -> DataFrame:
    """First and last n rows of an order."""
    head = df.orderBy(*[F.asc_nulls_first(c) for c in order]).limit(n).withColumn("side", F.lit("head"))
    tail = df.orderBy(*[F.desc_nulls_last(c) for c in order]).limit(n).withColumn("side", F.lit("tail"))
    return head.unionByName(tail)


def text_lengths(df: DataFrame, text: str, *keep: str) -> DataFrame:
    """Characters and blank-separated words of each whole text."""
    words = F.split(F.trim(F.col(text)), "[ \t\n\r]+")
    return df.select(*keep, F.length(text).alias("text_length"),
                     F.when(F.length(F.trim(F.col(text))) > 0, F.size(words)).otherwise(
                         F.when(F.col(text).isNotNull(), 0)).alias("word_count"))


def interactions(df: DataFrame, targets: list[str], bins: int = 10) -> DataFrame:
    """2-D bucket counts of every pair of targets, all pairs in one pass; NULL and NaN are in no bucket."""
    values = df.select([F.nullif(F.col(c).cast("double"), F.lit(float("nan"))).alias(c) for c in targets])
    ends = values.agg(F.struct(*[f(c).alias(f"{n}_{c}") for c in targets
                                 for n, f in (("lo", F.min), ("hi", F.max))]).alias("ends")).scalar()
    binned = values.select([F.when(F.col(c).isNotNull(), _bin(
        F.col(c), ends.getField(f"lo_{c}"), ends.getField(f"hi_{c}"), bins)).alias(c) for c in targets])
    cells = [F.struct(F.lit(a).alias("target_x"), F.lit(b).alias("target_y"), F.col(a).alias("x_bucket"),
                      F.col(b).alias("y_bucket")) for a, b in combinations(targets, 2)]
    return (binned.select(F.inline(F.array(*cells)))
            .where(F.col("x_bucket").isNotNull() & F.col("y_bucket").isNotNull())
            .groupBy("target_x", "target_y", "x_bucket", "y_bucket").agg(F.count("*").alias("n")))


def rejected_columns(df: DataFrame, id_share: float = 0.95) -> DataFrame:
    """Why a column would be left out of a profile: constant, all NULL, or close to one value per row."""
    rows = df.agg(F.count("*").alias("n")).scalar()
    known = long_form(df.selectExpr(*[f"count(`{c}`) AS `{c}`" for c in df.columns]), df.columns, {"n_known": "{c}"})
    # texts are told apart by their 128-bit digests: whole texts aren't shuffled
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    unique = distinct_counts(df.withColumns({c: F.md5(c) for c in texts}), df.columns)
    return known.join(unique, NAME).select(
        NAME, "n_known", "n_unique",
        ((F.col("n_known") == 0) & (rows > 0)).alias("all_null"),
        (F.col("n_unique") == 1).alias("constant"),
        F.coalesce(safe_rate(F.col("n_unique"), F.col("n_known")) > id_share, F.lit(False)).alias("id_like"))


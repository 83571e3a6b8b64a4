"""Data-health audit: rules are data, and all row rules are counted in one pass.

Every rule gives a summary row (name, count, rate) and, lazily, the rows behind it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emberline import schema as S
from emberline.functions.columns import count_each, long_form, rate_sql, safe_rate, union_all
from emberline.operators import duplicates
from emberline.operators.quantiles import NAME, VALUE, describe, value_counts


@dataclass(frozen=True)
class Rule:
    """A row-level rule. A NULL predicate is no violation. ``columns`` are shown for violations."""

    name: str
    predicate: str
    columns: tuple[str, ...]


_ID = (S.USER, S.APP)

CONSISTENCY_RULES = [
    Rule("timestamp_created_gt_timestamp_updated", f"{S.CREATED} > {S.UPDATED}", (*_ID, S.CREATED, S.UPDATED)),
    Rule("author_playtime_at_review_gt_author_playtime_forever",
         "author_playtime_at_review > author_playtime_forever",
         (*_ID, S.CREATED, "author_playtime_at_review", "author_playtime_forever")),
    Rule("author_playtime_last_two_weeks_gt_author_playtime_forever",
         "author_playtime_last_two_weeks > author_playtime_forever",
         (*_ID, S.CREATED, "author_playtime_last_two_weeks", "author_playtime_forever")),
]
VALIDITY_RULES = [
    *[Rule(f"{c}_negative", f"{c} < 0", (*_ID, S.CREATED, c)) for c in S.COUNT_COLUMNS],
    Rule("weighted_vote_score_out_of_range", "weighted_vote_score < 0 OR weighted_vote_score > 1",
         (*_ID, S.CREATED, S.SCORE_COLUMN)),
]
ANOMALY_RULES = [
    Rule("playtime_2w_near_limit", f"author_playtime_last_two_weeks >= {S.NEAR_TWO_WEEKS_MINUTES}",
         (*_ID, S.CREATED, "author_playtime_last_two_weeks")),
    Rule("playtime_2w_exceeds_limit", f"author_playtime_last_two_weeks > {S.TWO_WEEKS_MINUTES}",
         (*_ID, S.CREATED, "author_playtime_last_two_weeks")),
    Rule("votes_funny_is_uint32_artifact", f"votes_funny >= {S.UINT32_ARTIFACT_FROM}", (*_ID, S.CREATED, "votes_funny")),
    Rule("votes_funny_near_exact_uint32_artifact_max",
         f"votes_funny BETWEEN {S.UINT32_ARTIFACT_FROM} AND {S.UINT32_MAX - 1}", (*_ID, S.CREATED, "votes_funny")),
    Rule("votes_funny_exact_uint32_max", f"votes_funny = {S.UINT32_MAX}", (*_ID, S.CREATED, "votes_funny")),
]
ROW_RULES = [*CONSISTENCY_RULES, *VALIDITY_RULES, *ANOMALY_RULES]

ZERO_REVIEW_RULE = "users_with_min_author_num_reviews_eq_0"
DECREASE_RULE = "author_playtime_forever_decreases_over_time"
_BUCKET_DAYS = 30


def rule(name: str) -> Rule:
    return next(r for r in ROW_RULES if r.name == name)


def violations(df: DataFrame, name: str) -> DataFrame:
    """Rows that break one row-level rule; the filter reaches the scan."""
    found = rule(name)
    return df.where(F.expr(found.predicate)).select(*found.columns)


def row_rule_summary(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """(issue_name, violation_count, violation_rate) of all rules from a single aggregate."""
    return _counts_and_rates(df, {r.name: r.predicate for r in rules}, "issue_name", "violation")


def _counts_and_rates(df: DataFrame, tests: dict[str, str], name_column: str, measure: str) -> DataFrame:
    return long_form(count_each(df, tests), list(tests), {
        f"{measure}_count": "{c}", f"{measure}_rate": rate_sql("{c}", "_rows")}, name_column)


def _null_tests(columns: list[str]) -> dict[str, str]:
    return {c: f"`{c}` IS NULL" for c in columns}


def _noise_tests() -> dict[str, str]:
    return {**{c: f"{c} = 0" for c in S.NUMERIC_COLUMNS}, **{c: f"NOT {c}" for c in S.BOOLEAN_COLUMNS}}


def structure_report(df: DataFrame) -> DataFrame:
    width = len(df.columns)
    return df.agg(F.count("*").alias("row_count")).select(
        "row_count", F.lit(width).cast("long").alias("column_count"),
        (F.col("row_count") * width).alias("cell_count"))


def schema_audit(df: DataFrame, expected: dict[str, T.DataType] = S.REVIEW_SCHEMA) -> DataFrame:
    """Expected against actual column types; reads no data."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    rows = [(i, name, name in actual, kind.simpleString(), actual.get(name),
             actual.get(name) == kind.simpleString()) for i, (name, kind) in enumerate(expected.items())]
    return df.sparkSession.createDataFrame(
        rows, "position int, column_name string, present boolean, expected_type string, "
              "actual_type string, type_matches boolean")


def null_report(df: DataFrame) -> DataFrame:
    return _counts_and_rates(df, _null_tests(df.columns), "column_name", "null").orderBy(
        F.desc("null_rate"), "column_name")


def noise_report(df: DataFrame) -> DataFrame:
    """How often a numeric column is zero or a boolean column is false."""
    return _counts_and_rates(df, _noise_tests(), "column_name", "zero_or_false").orderBy(
        F.desc("zero_or_false_rate"), "column_name")


def distinct_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, n_unique): (column, value) pairs are made unique before and after one shuffle,
    instead of one expanded copy of every row per distinct aggregate."""
    pairs = value_counts(df, columns, "string").groupBy(NAME).agg(F.count(VALUE).alias("n_unique"))
    names = df.sparkSession.createDataFrame([(c,) for c in columns], f"{NAME} string")
    return names.join(pairs, NAME, "left").select(NAME, F.coalesce("n_unique", F.lit(0)).alias("n_unique"))


def uniqueness_report(df: DataFrame) -> DataFrame:
    columns = [*S.NUMERIC_COLUMNS, *S.BOOLEAN_COLUMNS]
    rows = df.agg(F.count("*").alias("n")).scalar()
    return (distinct_counts(df, columns).withColumn("unique_rate", safe_rate(F.col("n_unique"), rows))
            .orderBy("n_unique", "column_name"))


def users_with_zero_reviews(df: DataFrame) -> DataFrame:
    return (_user_minimum(df).where(F.col("min_author_num_reviews") <= 0)
            .select(S.USER, "min_author_num_reviews"))


def _user_minimum(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    return (df.where(F.col(S.USER).isNotNull())
            .groupBy(*by or [], S.USER).agg(F.min("author_num_reviews").alias("min_author_num_reviews")))


def playtime_decreases(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Reviews whose lifetime playtime is below that of the previous review of the same user and app (and ``by``).

    The order is (created, updated, playtime, votes_up). Rows equal in all four have equal playtime
    and can never differ from each other, so copies collapse before the window. A (user, app) pair
    that holds a large part of the data is cut into 30-day buckets: the window runs inside a bucket,
    and the step from one bucket to the next compares the buckets' last and first rows.
    """
    order = [S.CREATED, S.UPDATED, "author_playtime_forever", "votes_up"]
    pair = [*(by or []), S.USER, S.APP]
    needed = [*pair, S.CREATED, "author_playtime_forever"]
    steps = df.select(*pair, *order)
    for c in needed:
        steps = steps.where(F.col(c).isNotNull())
    steps = (steps.distinct()
             .withColumn("bucket", F.floor(F.col(S.CREATED) / (_BUCKET_DAYS * S.SECONDS_PER_DAY))))
    playtime = "author_playtime_forever"
    inside = Window.partitionBy(*pair, "bucket").orderBy(*order)
    whole = inside.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    steps = steps.select(
        *needed, F.lag(playtime).over(inside).alias("prev_playtime_forever"),
        F.last(playtime).over(whole).alias("closing"), (F.row_number().over(inside) == 1).alias("opens"))
    # One narrow row per pair and bucket, its first with the playtime of its last, is left for the window over whole pairs.
    across = Window.partitionBy(*pair).orderBy(S.CREATED)
    between = steps.where("opens").select(*needed, "closing").withColumn("prev_playtime_forever", F.lag("closing").over(across))
    found = [rows.where(F.col(playtime) < F.col("prev_playtime_forever")).select(*needed, "prev_playtime_forever")
             for rows in (steps.where(~F.col("opens")), between)]
    return found[0].unionByName(found[1])


def consistency_report(df: DataFrame) -> DataFrame:
    """All consistency rules: row rules per row, the user rule per distinct user."""
    users = _user_minimum(df).agg(
        F.count("*").alias("users"), F.count_if(F.col("min_author_num_reviews") <= 0).alias("n"))
    rows = df.agg(F.count("*").alias("n")).scalar()
    return union_all([
        row_rule_summary(df, CONSISTENCY_RULES),
        users.select(F.lit(ZERO_REVIEW_RULE).alias("issue_name"), F.col("n").alias("violation_count"),
                     safe_rate(F.col("n"), F.col("users")).alias("violation_rate")),
        playtime_decreases(df).agg(F.count("*").alias("n")).select(
            F.lit(DECREASE_RULE).alias("issue_name"), F.col("n").alias("violation_count"),
            safe_rate(F.col("n"), rows).alias("violation_rate")),
    ])


def votes_funny_gap(df: DataFrame) -> DataFrame:
    """Largest vote count below the artifact range, and its share of the largest 32-bit value."""
    top = df.agg(F.max(F.when(F.col("votes_funny") < S.UINT32_ARTIFACT_FROM, F.col("votes_funny")))
                 .alias("max_non_artifact_votes_funny"))
    return top.withColumn("percent_of_uint32_max",
                          F.col("max_non_artifact_votes_funny") / F.lit(float(S.UINT32_MAX)) * 100)


def describe_report(df: DataFrame) -> DataFrame:
    return describe(df, S.NUMERIC_COLUMNS, [0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99])


def size_estimate(df: DataFrame) -> DataFrame:
    """In-memory size of the whole data from per-row widths: 8 bytes per fixed-width cell (NULL or
    not, as in an unsafe row) plus the bytes of the text cells."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    width = F.lit(8 * len(df.columns))
    for c in texts:
        width = width + F.coalesce(F.octet_length(c), F.lit(0))
    return df.agg(F.count("*").alias("row_count"), F.sum(width.cast("long")).alias("estimated_bytes"))


def full_audit(df: DataFrame) -> DataFrame:
    """Every report as one long table: (section, item, item_count, item_rate).

    Rows, nulls, zero values and all row rules come from one aggregate over the data; users,
    playtime order, distinct values and duplicates need a shuffle each.
    """
    return _audit(df, []).select("section", "item", "item_count", "item_rate")


def _audit(df: DataFrame, by: list[str]) -> DataFrame:
    """``full_audit`` for each value of the columns ``by`` at once, every report from one pass over all of them."""
    columns = [c for c in df.columns if c not in by]
    sections = {"null": _null_tests(columns), "noise": _noise_tests(),
                **{section: {r.name: r.predicate for r in rules} for section, rules in (
                    ("consistency", CONSISTENCY_RULES), ("validity", VALIDITY_RULES), ("anomaly", ANOMALY_RULES))}}
    counted = count_each(df, {f"{section}|{item}": test for section, tests in sections.items()
                              for item, test in tests.items()}, by)
    width, valued = len(columns), [*S.NUMERIC_COLUMNS, *S.BOOLEAN_COLUMNS]
    cells = [("structure", "rows", "_rows", "CAST(NULL AS BIGINT)"),
             ("structure", "columns", f"CAST({width} AS BIGINT)", "CAST(NULL AS BIGINT)"),
             ("structure", "cells", f"_rows * {width}", "CAST(NULL AS BIGINT)"),
             *[(section, item, f"`{section}|{item}`", "_rows") for section, tests in sections.items() for item in tests],
             # Zero where the reports below have nothing to say.
             *[(section, item, "0L", total) for section, item, total in [
                 ("consistency", ZERO_REVIEW_RULE, "0L"), ("consistency", DECREASE_RULE, "_rows"),
                 *[("uniqueness", c, "_rows") for c in valued],
                 *[("duplicates", f"{kind}_{n}", "_rows") for kind in ("exact", "key")
                   for n in ("duplicate_groups", "duplicate_group_rows", "duplicate_surplus_rows")]]]]
    table = counted.selectExpr(*by, "inline(array(" + ", ".join(
        f"named_struct('section', '{section}', 'item', '{item}', 'item_count', {count}, 'denominator', {total})"
        for section, item, count, total in cells) + "))")

    def part(source: DataFrame, section: str, item: str, count: str, denominator: str = "0") -> DataFrame:
        return source.selectExpr(*by, f"'{section}' AS section", f"{item} AS item", f"CAST({count} AS BIGINT) AS item_count",
                                 f"CAST({denominator} AS BIGINT) AS denominator")

    users = _user_minimum(df, by).groupBy(*by).agg(
        F.count("*").alias("users"), F.count_if(F.col("min_author_num_reviews") <= 0).alias("n"))
    decreases = playtime_decreases(df, by).groupBy(*by).agg(F.count("*").alias("n"))
    distinct = value_counts(df, valued, "string", by).groupBy(*by, NAME).agg(F.count(VALUE).alias("n_unique"))
    found = union_all([
        table,
        part(users, "consistency", f"'{ZERO_REVIEW_RULE}'", "n", "users"),
        part(decreases, "consistency", f"'{DECREASE_RULE}'", "n"),
        part(distinct, "uniqueness", "column_name", "n_unique"),
        part(duplicates.duplicate_totals(df, by=by), "duplicates", "item", "item_count"),
    ])
    # Of two rows for an item one is a zero or has no denominator.
    total = found.groupBy(*by, "section", "item").agg(F.sum("item_count").alias("item_count"), F.sum("denominator").alias("denominator"))
    return total.withColumn("item_rate", safe_rate(F.col("item_count"), F.col("denominator")))


def compare_with_sample(df: DataFrame, in_sample: Column) -> DataFrame:
    """The same rules on all rows and on those of a sample, side by side, from one pass per report over both.

    A row of the sample is read once and counted in both datasets, so that the comparison costs the audit of all rows
    and that of the sample's share of them.
    """
    datasets = F.when(in_sample, F.array(F.lit("full"), F.lit("sample"))).otherwise(F.array(F.lit("full")))
    audited = _audit(df.withColumn("_dataset", F.explode(datasets)), ["_dataset"])
    both = audited.groupBy("section", "item").agg(*[
        F.max(F.when(F.col("_dataset") == d, F.col(f"item_{m}"))).alias(f"{d}_{m}") for d in ("full", "sample") for m in ("count", "rate")])
    return both.select("section", "item", "full_count", "full_rate", "sample_count", "sample_rate",
                       (F.col("sample_rate") - F.col("full_rate")).alias("rate_difference"))


def compare_audits(sample: DataFrame, full: DataFrame) -> DataFrame:
    """The same rules on two tables, side by side. ``compare_with_sample`` costs half where one is part of the other."""
    left = full_audit(full).withColumnsRenamed({"item_count": "full_count", "item_rate": "full_rate"})
    right = full_audit(sample).withColumnsRenamed({"item_count": "sample_count", "item_rate": "sample_rate"})
    return left.join(right, ["section", "item"], "left").select(
        "section", "item", "full_count", "full_rate", "sample_count", "sample_rate",
        (F.col("sample_rate") - F.col("full_rate")).alias("rate_difference"))

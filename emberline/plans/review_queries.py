"""Audit, duplicate, cleaning, preparation and source queries with their oracle SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emberline import schema as S
from emberline.functions.columns import union_all, utc_day
from emberline.functions.storage import scratch_path
from emberline.operators import audit, cleaning, duplicates, prepare
from emberline.plans.oracle import per_column, with_reviews
from emberline.plans.registry import Query, rounded
from emberline.sources import readers, sinks
from emberline.sources.testdata import reviews, reviews_view, table

N = S.NUMERIC_COLUMNS
NB = [*S.NUMERIC_COLUMNS, *S.BOOLEAN_COLUMNS]
ALL = list(S.REVIEW_SCHEMA)
PCTS = {"p1": 0.01, "p5": 0.05, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p95": 0.95, "p99": 0.99}
TS_RULE, REVIEW_RULE, TWO_WEEK_RULE = [r.name for r in audit.CONSISTENCY_RULES]
KEYS = ", ".join(S.KEY_COLUMNS)
COLS = ", ".join(ALL)

_DECREASES = """steps AS (
SELECT DISTINCT author_steamid, appid, timestamp_created, timestamp_updated, author_playtime_forever, votes_up FROM reviews
WHERE author_steamid IS NOT NULL AND appid IS NOT NULL AND timestamp_created IS NOT NULL AND author_playtime_forever IS NOT NULL
), lagged AS (
SELECT *, LAG(author_playtime_forever) OVER (PARTITION BY author_steamid, appid
  ORDER BY timestamp_created, timestamp_updated, author_playtime_forever, votes_up) AS prev_playtime_forever FROM steps
), decreases AS (SELECT * FROM lagged WHERE author_playtime_forever < prev_playtime_forever)"""
_USERS = """user_min AS (SELECT author_steamid, MIN(author_num_reviews) AS min_author_num_reviews
 FROM reviews WHERE author_steamid IS NOT NULL GROUP BY 1)"""

_RULE_SQL = {
    "consistency": {
        "timestamp_created_gt_timestamp_updated": "timestamp_created > timestamp_updated",
        "author_playtime_at_review_gt_author_playtime_forever": "author_playtime_at_review > author_playtime_forever",
        "author_playtime_last_two_weeks_gt_author_playtime_forever":
            "author_playtime_last_two_weeks > author_playtime_forever",
    },
    "validity": {
        **{f"{c}_negative": f"{c} < 0" for c in S.COUNT_COLUMNS},
        "weighted_vote_score_out_of_range": "weighted_vote_score NOT BETWEEN 0 AND 1",
    },
    "anomaly": {
        "playtime_2w_near_limit": "author_playtime_last_two_weeks >= 18144",
        "playtime_2w_exceeds_limit": "author_playtime_last_two_weeks > 20160",
        "votes_funny_is_uint32_artifact": "votes_funny >= 4000000000",
        "votes_funny_near_exact_uint32_artifact_max": "votes_funny >= 4000000000 AND votes_funny < 4294967295",
        "votes_funny_exact_uint32_max": "votes_funny = 4294967295",
    },
}


def _rule_rows(section: str) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{name}' AS issue_name, COUNT(*) FILTER (WHERE {test}) AS violation_count, "
        f"ROUND(COUNT(*) FILTER (WHERE {test}) * 1.0::DOUBLE / COUNT(*), 6) AS violation_rate FROM reviews"
        for name, test in _RULE_SQL[section].items())


_CONSISTENCY_TAIL = f"""
UNION ALL SELECT '{audit.ZERO_REVIEW_RULE}', COUNT(*) FILTER (WHERE min_author_num_reviews <= 0),
 ROUND(COUNT(*) FILTER (WHERE min_author_num_reviews <= 0)::DOUBLE / COUNT(*), 6) FROM user_min
UNION ALL SELECT '{audit.DECREASE_RULE}', (SELECT COUNT(*) FROM decreases),
 ROUND((SELECT COUNT(*) FROM decreases)::DOUBLE / (SELECT COUNT(*) FROM reviews), 6)"""


def _false_test(column: str) -> str:
    return f"{column} = FALSE" if column in S.BOOLEAN_COLUMNS else f"{column} = 0"


def full_audit_select(source: str, users: str, decreases: str) -> str:
    """Oracle text of the long audit table over ``source`` and its user and decrease tables."""
    rows = f"(SELECT COUNT(*) FROM {source})"
    parts = [
        f"SELECT 'structure' AS section, 'rows' AS item, {rows} AS item_count, {rows} AS denominator",
        f"SELECT 'structure', 'columns', 18, {rows}", f"SELECT 'structure', 'cells', {rows} * 18, {rows}",
        *[f"SELECT 'null', '{c}', (SELECT COUNT(*) FROM {source} WHERE {c} IS NULL), {rows}" for c in ALL],
        *[f"SELECT 'noise', '{c}', (SELECT COUNT(*) FROM {source} WHERE {_false_test(c)}), {rows}" for c in NB],
        *[f"SELECT '{section}', '{name}', (SELECT COUNT(*) FROM {source} WHERE {test}), {rows}"
          for section, tests in _RULE_SQL.items() for name, test in tests.items()],
        f"SELECT 'consistency', '{audit.ZERO_REVIEW_RULE}', "
        f"(SELECT COUNT(*) FROM {users} WHERE min_author_num_reviews <= 0), (SELECT COUNT(*) FROM {users})",
        f"SELECT 'consistency', '{audit.DECREASE_RULE}', (SELECT COUNT(*) FROM {decreases}), {rows}",
        *[f"SELECT 'uniqueness', '{c}', (SELECT COUNT(DISTINCT {c}) FROM {source}), {rows}" for c in NB],
    ]
    for kind, keys in (("exact", COLS), ("key", KEYS)):
        groups = f"(SELECT COUNT(*) AS n FROM {source} GROUP BY {keys} HAVING COUNT(*) > 1)"
        for name, value in (("groups", "COUNT(*)"), ("group_rows", "COALESCE(SUM(n), 0)"),
                            ("surplus_rows", "COALESCE(SUM(n), 0) - COUNT(*)")):
            parts.append(f"SELECT 'duplicates', '{kind}_duplicate_{name}', (SELECT {value} FROM {groups}), {rows}")
    body = "\nUNION ALL ".join(parts)
    return (f"SELECT section, item, CAST(item_count AS BIGINT) AS item_count, CASE WHEN section <> 'structure' "
            f"THEN ROUND(item_count::DOUBLE / denominator, 6) END AS item_rate FROM ({body})")


def _audit_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(audit.null_report(reviews(spark, sf_dir)), 6)


def audit_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(audit.full_audit(reviews(spark, sf_dir)), 6)


def _describe_sql(columns: list[str], pcts: dict[str, float]) -> str:
    pieces = {"count": "COUNT({c})::DOUBLE", "mean": "AVG({c}::DOUBLE)", "min": "MIN({c})::DOUBLE",
              "max": "MAX({c})::DOUBLE", "stddev": "STDDEV_SAMP({c}::DOUBLE)",
              **{k: f"QUANTILE_CONT({{c}}::DOUBLE, {q})" for k, q in pcts.items()}}
    return "\nUNION ALL ".join(
        per_column(columns, f"SELECT '{{c}}' AS column_name, '{m}' AS measure, ROUND({e}, 3) AS measure_value FROM reviews")
        for m, e in pieces.items())


def _viol(rule_name: str):
    return lambda spark, sf_dir: audit.violations(reviews(spark, sf_dir), rule_name)


def _viol_sql(rule_name: str) -> str:
    test = next(t[rule_name] for t in _RULE_SQL.values() if rule_name in t)
    return with_reviews(f"SELECT {', '.join(audit.rule(rule_name).columns)} FROM reviews WHERE {test}")


# --- sources and sinks ---------------------------------------------------------------------

_PART_SCHEMA = {"p_partkey": T.LongType(), "p_name": T.StringType(), "p_brand": T.StringType(),
                "p_type": T.StringType(), "p_size": T.IntegerType(), "p_retailprice": T.DoubleType()}


def _csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    table(spark, sf_dir, "part").write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    return readers.read_csv_typed(spark, path, _PART_SCHEMA)


def _raw_reviews_path(spark: SparkSession, sf_dir: str) -> str:
    """The review table as a raw dump: quotes and line breaks in texts, user ids that are no numbers."""
    raw = reviews(spark, sf_dir).withColumns({
        S.USER: F.expr(f"CASE WHEN {_BROKEN} THEN 'n/a' ELSE CAST({S.USER} AS STRING) END"),
        "review": F.expr("concat('He said \"', review, '\",\nthen left')")})
    return sinks.write_report(raw, scratch_path(spark, "raw"), "reviews", "csv")


def _raw_reviews_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.read_reviews_csv(spark, _raw_reviews_path(spark, sf_dir), multi_line=True)


def _csv_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every cell of the raw dump that didn't cast, and the lines of reviews that a scan by lines can't put together."""
    path = _raw_reviews_path(spark, sf_dir)
    whole = readers.read_csv_rejects(spark, path, S.REVIEW_SCHEMA, S.KEY_COLUMNS, multi_line=True)
    return whole.select("key", "column_name", "raw_text")


def _report_sinks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One report in each of the formats, read back."""
    report = audit.row_rule_summary(reviews(spark, sf_dir), audit.ROW_RULES).withColumn("violation_rate", F.round("violation_rate", 9))
    root, schema = scratch_path(spark, "reports"), report.schema
    read = {"csv": lambda p: spark.read.schema(schema).option("header", True).csv(p),
            "json": lambda p: spark.read.schema(schema).json(p), "parquet": lambda p: spark.read.parquet(p)}
    return union_all([load(sinks.write_report(report, f"{root}/{fmt}", "rules", fmt)).select(
        F.lit(fmt).alias("format"), *report.columns) for fmt, load in read.items()])


#: Rows whose user id is written as text that is no number.
_BROKEN = "timestamp_created % 86400 = 0 AND appid % 101 = 0"


def _ingested_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV to typed Parquet and back, with the trace that broken rows leave."""
    path = scratch_path(spark, "ingested")
    sinks.write_parquet(_raw_reviews_csv(spark, sf_dir), path)
    stored = readers.read_parquet(spark, path)
    sums = stored.agg(F.sum(F.length("review")).alias("review_chars"), F.count_if(F.col("review").contains("\n")).alias("broken_lines"),
                      F.sum("votes_funny").alias("sum_votes_funny"), F.count(S.CREATED).alias("with_time"))
    counts = readers.broken_key_rows(stored, S.KEY_COLUMNS)
    return counts.select("*", *[sums.select(c).scalar().alias(c) for c in sums.columns])


def _ingest_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Builds the review table and writes it as typed Parquet, anew at each call."""
    path = scratch_path(spark, "ingest")
    sinks.write_parquet(reviews_view(spark, sf_dir), path)
    return readers.read_parquet(spark, path, [S.USER]).agg(F.count("*").alias("row_count"), F.count(S.USER).alias("with_user"))


def _deviating_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The schema in the footers of a stored table that lacks a column and has two others of another type."""
    path = scratch_path(spark, "deviating")
    sinks.write_parquet(reviews(spark, sf_dir).drop("language").withColumns(
        {"votes_up": F.col("votes_up").cast("string"), "voted_up": F.col("voted_up").cast("int")}), path)
    return audit.schema_audit(spark.read.parquet(path))


def _deviating_schema_sql() -> str:
    other = {"language": None, "votes_up": "string", "voted_up": "int"}
    rows = []
    for i, (name, kind) in enumerate(S.REVIEW_SCHEMA.items()):
        actual = other.get(name, kind.simpleString())
        text = "NULL" if actual is None else f"'{actual}'"
        rows.append(f"({i}, '{name}', {actual is not None}, '{kind.simpleString()}', {text}, "
                    f"{actual == kind.simpleString()})")
    return ("SELECT CAST(p AS INT) AS position, c AS column_name, b AS present, e AS expected_type, CAST(a AS VARCHAR) AS actual_type, "
            f"m AS type_matches FROM (VALUES {', '.join(rows)}) t(p, c, b, e, a, m)")


def _scalar_showcase(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scalar, array, map and JSON functions of the pipelines, side by side: a row per word and positive vote count."""
    df = reviews(spark, sf_dir)
    day = utc_day(df, S.CREATED)
    days = F.array(F.lit(1), F.lit(2), F.lit(3))
    votes = F.to_json(F.struct("votes_up", "comment_count"))
    kinds = F.create_map(F.lit("up"), F.col("votes_up").cast("long"), F.lit("funny"), F.col("votes_funny"))
    # All that depends on the review alone is worked out once a review, before its words and votes are multiplied.
    once = rounded(df.select(
        S.USER, S.APP, S.CREATED, F.split(F.coalesce("review", F.lit("none")), " ").alias("words"),
        F.map_filter(kinds, lambda _, n: n > 0).alias("kinds"), F.col("votes_up").cast("double").alias("votes_up_double"),
        F.col("review").isNull().alias("no_review"),
        F.coalesce("review", F.lit("none")).alias("review_or_none"),
        F.when(F.col("voted_up"), "up").otherwise("down").alias("vote"),
        F.length(F.trim(F.concat(F.lit("  "), "language", F.lit(" ")))).alias("language_length"),
        F.upper("language").alias("language_upper"), F.lower(F.upper("language")).alias("language_lower"),
        F.coalesce(F.lower("review").contains("urgent"), F.lit(False)).alias("is_urgent"),
        F.regexp_replace("language", "[aeiou]", "_").alias("no_vowels"),
        F.log1p(F.col("author_playtime_forever").cast("double")).alias("log_playtime"),
        day.cast("string").alias("created_day"), F.year(day).alias("created_year"),
        F.unix_timestamp(F.timestamp_seconds(S.CREATED)).alias("created_epoch"),
        F.try_to_date(F.when(F.col("voted_up"), day.cast("string")).otherwise(F.col("language")), "yyyy-MM-dd").cast("string").alias("parsed_day"),
        ((F.col(S.UPDATED) - F.col(S.CREATED)) / 86400.0).alias("days_to_update"),
        F.col("votes_up").between(1, 3).alias("few_votes"), F.col("language").isin("english", "french").alias("latin"),
        F.array_contains(days, F.col("author_num_reviews")).alias("one_to_three"),
        votes.alias("votes_json"), F.from_json(votes, "votes_up int, comment_count int")["comment_count"].alias("comments"),
        F.array_join(F.from_json(F.concat(F.lit("['"), "language", F.lit("', 'it\\'s']")), "array<string>"), " | ").alias("joined"),
        F.array_join(F.map_keys(F.from_json(F.concat(F.lit("{'"), "language", F.lit("': 1}")), "map<string,int>")), "").alias("map_key"),
        F.round(F.col(S.SCORE_COLUMN).cast("double"), 2).alias("score_rounded")), 6)
    words = once.select("*", F.explode("words").alias("word"))
    counted = words.select("*", F.explode_outer("kinds").alias("vote_kind", "vote_count"))
    first = [S.USER, S.APP, S.CREATED, "word", "vote_kind", "vote_count"]
    return counted.select(*first, *[c for c in once.columns if c not in (*first, "words", "kinds")])


_SCALAR_SQL = with_reviews("""SELECT author_steamid, appid, timestamp_created, word, entry.kind AS vote_kind, entry.n AS vote_count,
 votes_up::DOUBLE AS votes_up_double, review IS NULL AS no_review,
 COALESCE(review, 'none') AS review_or_none, CASE WHEN voted_up THEN 'up' ELSE 'down' END AS vote,
 CAST(LENGTH(language) AS INT) AS language_length, UPPER(language) AS language_upper, language AS language_lower,
 COALESCE(LOWER(review) LIKE '%urgent%', FALSE) AS is_urgent, regexp_replace(language, '[aeiou]', '_', 'g') AS no_vowels,
 ROUND(LN(1 + author_playtime_forever::DOUBLE), 6) AS log_playtime, strftime(make_timestamp(timestamp_created * 1000000), '%Y-%m-%d') AS created_day,
 CAST(year(make_timestamp(timestamp_created * 1000000)) AS INT) AS created_year, timestamp_created AS created_epoch,
 CASE WHEN voted_up THEN strftime(make_timestamp(timestamp_created * 1000000), '%Y-%m-%d') END AS parsed_day,
 ROUND((timestamp_updated - timestamp_created) / 86400.0::DOUBLE, 6) AS days_to_update, votes_up BETWEEN 1 AND 3 AS few_votes,
 language IN ('english', 'french') AS latin, author_num_reviews IN (1, 2, 3) AS one_to_three,
 '{"votes_up":' || votes_up || ',"comment_count":' || comment_count || '}' AS votes_json, comment_count AS comments,
 language || ' | it''s' AS joined, language AS map_key,
 ROUND(weighted_vote_score::DOUBLE, 2) AS score_rounded FROM (
 SELECT *, unnest(CASE WHEN len(entries) = 0 THEN [NULL] ELSE entries END) AS entry FROM (
  SELECT *, [x for x in [{'kind': 'up', 'n': votes_up::BIGINT}, {'kind': 'funny', 'n': votes_funny}] if x.n > 0] AS entries FROM (
   SELECT *, unnest(string_split(COALESCE(review, 'none'), ' ')) AS word FROM reviews)))""")


def _parquet_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "parquet")
    sinks.write_parquet(reviews(spark, sf_dir), path)
    return (readers.read_parquet(spark, path).groupBy("language")
            .agg(F.count("*").alias("row_count"), F.sum("votes_funny").alias("sum_votes_funny"),
                 F.sum(S.CREATED).alias("sum_created")))


def _parquet_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.read_parquet(spark, f"{sf_dir}/orders.parquet", ["o_orderkey", "o_custkey", "o_orderpriority"])


# --- preparation ---------------------------------------------------------------------------

def _ensure_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = reviews(spark, sf_dir).drop("language", "comment_count").withColumn(
        "votes_up", F.col("votes_up").cast("string"))
    return prepare.ensure_columns(part, S.REVIEW_SCHEMA).groupBy("language", "comment_count").agg(
        F.count("*").alias("row_count"), F.sum("votes_up").alias("sum_votes_up"))


def _type_conversion(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = reviews(spark, sf_dir).select(
        F.coalesce(F.col(S.USER).cast("string"), F.lit("not a number")).alias(S.USER),
        F.col(S.APP).cast("string").alias(S.APP), F.col("voted_up").cast("string").alias("voted_up"),
        F.col(S.SCORE_COLUMN).cast("string").alias(S.SCORE_COLUMN), F.col(S.CREATED).cast("string").alias(S.CREATED))
    out = prepare.convert_types(text, {S.USER: "Int64", S.APP: "Int32", "voted_up": "boolean",
                                       S.SCORE_COLUMN: "Float32", S.CREATED: "datetime"})
    return out.withColumn(S.CREATED, F.unix_seconds(S.CREATED))


def _epochs_for_compare(df: DataFrame) -> DataFrame:
    return df.withColumns({f"{c}_ts": F.unix_seconds(f"{c}_ts") for c in S.EPOCH_COLUMNS})


def _derived(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _epochs_for_compare(prepare.add_derived(reviews(spark, sf_dir)))
    return rounded(out.select(S.USER, S.APP, *[f"{c}_ts" for c in S.EPOCH_COLUMNS], "review_length",
                              *[f"log_{c}" for c in prepare.LOG_SOURCES]), 6)


_LOGS = ", ".join(f"CASE WHEN {c} > -1 THEN ROUND(LN(1 + {c}::DOUBLE), 6) END AS log_{c}" for c in S.COUNT_COLUMNS)
_DERIVED_SQL = (f"author_last_played AS author_last_played_ts, timestamp_created AS timestamp_created_ts, "
                f"timestamp_updated AS timestamp_updated_ts, CAST(LENGTH(review) AS INT) AS review_length, {_LOGS}, "
                f"ROUND(LN(1 + LENGTH(review)::DOUBLE), 6) AS log_review_length")
_INDICATORS = {"has_comments": "comment_count", "has_votes_up": "votes_up", "has_funny_votes": "votes_funny",
               "has_recent_playtime": "author_playtime_last_two_weeks", "has_weighted_vote_score": S.SCORE_COLUMN}
_INDICATOR_SQL = ", ".join(f"{old} > 0 AS {new}" for new, old in _INDICATORS.items())
_FLAGS = [r.name for r in audit.ANOMALY_RULES if r.name != "votes_funny_exact_uint32_max"]
_FLAG_SQL = ", ".join(f"({_RULE_SQL['anomaly'][f]}) AS {f}" for f in _FLAGS)

_COMPLETE = " AND ".join(f"{c} IS NOT NULL" for c in ALL)
_LATEST = ", ".join(f"{c} DESC NULLS LAST" for c in [S.UPDATED, *[c for c in ALL if c not in (*S.KEY_COLUMNS, S.UPDATED)]])
CLEAN = f"""complete AS (SELECT * FROM reviews WHERE {_COMPLETE}),
artifact_free AS (SELECT * FROM complete WHERE votes_funny < 4000000000),
no_copies AS (SELECT DISTINCT * FROM artifact_free),
versions AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY {KEYS} ORDER BY {_LATEST}) AS version FROM no_copies),
cleaned AS (SELECT {COLS} FROM versions WHERE version = 1)"""


def clean_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_reviews(reviews(spark, sf_dir))


def _feat_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _epochs_for_compare(prepare.build_features(clean_full(spark, sf_dir)))
    return rounded(out.select(*S.KEY_COLUMNS, *[f"{c}_ts" for c in S.EPOCH_COLUMNS], "review_length",
                              *[f"log_{c}" for c in prepare.LOG_SOURCES], *_INDICATORS), 6)


_DIAGNOSTICS = """d AS (SELECT author_steamid, appid, timestamp_created, COUNT(*) AS n_rows,
 COUNT(DISTINCT ROW({cols})) AS n_distinct_rows, COUNT(DISTINCT review) AS n_distinct_texts,
 COUNT(DISTINCT language) AS n_distinct_languages, COUNT(DISTINCT timestamp_updated) AS n_distinct_updated,
 COUNT(DISTINCT author_playtime_forever) AS n_distinct_playtime, COUNT(DISTINCT votes_up) AS n_distinct_votes_up,
 COUNT(DISTINCT weighted_vote_score) AS n_distinct_scores
 FROM reviews GROUP BY 1, 2, 3 HAVING COUNT(*) > 1)""".replace("{cols}", COLS)


def _on_reviews(operator):
    return lambda spark, sf_dir: operator(reviews(spark, sf_dir))


def _rounded_on_reviews(operator, places: int = 6):
    return lambda spark, sf_dir: rounded(operator(reviews(spark, sf_dir)), places)


QUERIES = {
    "src_csv_typed": Query(_csv_round_trip,
                           "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part"),
    "src_csv_reviews": Query(_ingested_csv, with_reviews(
        f"SELECT COUNT(*) AS row_count, COUNT(*) FILTER (WHERE author_steamid IS NULL OR ({_BROKEN})) AS broken_key_rows, "
        "CAST(SUM(LENGTH(review) + 21) AS BIGINT) AS review_chars, COUNT(review) AS broken_lines, "
        "CAST(SUM(votes_funny) AS BIGINT) AS sum_votes_funny, COUNT(timestamp_created) AS with_time FROM reviews")),
    "src_csv_rejects": Query(_csv_rejects, with_reviews(
        "SELECT concat_ws('|', 'n/a', appid::VARCHAR, timestamp_created::VARCHAR) AS key, 'author_steamid' AS column_name, 'n/a' AS raw_text "
        f"FROM reviews WHERE {_BROKEN}")),
    "snk_report_formats": Query(_report_sinks, with_reviews(
        "SELECT format, issue_name, violation_count, ROUND(violation_count::DOUBLE / (SELECT COUNT(*) FROM reviews), 9) AS violation_rate FROM ("
        + " UNION ALL ".join(f"SELECT '{r.name}' AS issue_name, COUNT(*) FILTER ({next(t[r.name] for t in _RULE_SQL.values() if r.name in t)}) "
                             "AS violation_count FROM reviews" for r in audit.ROW_RULES)
        + "), (VALUES ('csv'), ('json'), ('parquet')) f(format)")),
    "ingest_reviews": Query(_ingest_reviews, with_reviews(
        "SELECT COUNT(*) AS row_count, COUNT(author_steamid) AS with_user FROM reviews")),
    "scalar_showcase": Query(_scalar_showcase, _SCALAR_SQL),
    "src_parquet_scan": Query(_parquet_scan, "SELECT o_orderkey, o_custkey, o_orderpriority FROM orders"),
    "snk_parquet_roundtrip": Query(_parquet_round_trip, with_reviews(
        "SELECT language, COUNT(*) AS row_count, CAST(SUM(votes_funny) AS BIGINT) AS sum_votes_funny, "
        "CAST(SUM(timestamp_created) AS BIGINT) AS sum_created FROM reviews GROUP BY 1")),

    "audit_structure": Query(_on_reviews(audit.structure_report), with_reviews(
        "SELECT COUNT(*) AS row_count, CAST(18 AS BIGINT) AS column_count, COUNT(*) * 18 AS cell_count FROM reviews")),
    "audit_schema": Query(_deviating_schema, _deviating_schema_sql()),
    "audit_nulls": Query(_audit_nulls, with_reviews(per_column(
        ALL, "SELECT '{c}' AS column_name, COUNT(*) FILTER (WHERE {c} IS NULL) AS null_count, "
             "ROUND(COUNT(*) FILTER (WHERE {c} IS NULL)::DOUBLE / COUNT(*), 6) AS null_rate FROM reviews"))),
    "audit_consistency_summary": Query(_rounded_on_reviews(audit.consistency_report), with_reviews(
        _rule_rows("consistency") + _CONSISTENCY_TAIL, _USERS, _DECREASES)),
    "audit_viol_ts_order": Query(_viol(TS_RULE), _viol_sql(TS_RULE)),
    "audit_viol_playtime_review": Query(_viol(REVIEW_RULE), _viol_sql(REVIEW_RULE)),
    "audit_viol_playtime_2w": Query(_viol(TWO_WEEK_RULE), _viol_sql(TWO_WEEK_RULE)),
    "audit_users_zero_reviews": Query(_on_reviews(audit.users_with_zero_reviews), with_reviews(
        "SELECT author_steamid, min_author_num_reviews FROM user_min WHERE min_author_num_reviews <= 0", _USERS)),
    "audit_playtime_decreases": Query(_on_reviews(audit.playtime_decreases), with_reviews(
        "SELECT author_steamid, appid, timestamp_created, author_playtime_forever, prev_playtime_forever FROM decreases",
        _DECREASES)),
    "audit_validity_summary": Query(
        _rounded_on_reviews(lambda df: audit.row_rule_summary(df, audit.VALIDITY_RULES)),
        with_reviews(_rule_rows("validity"))),
    "audit_viol_score_range": Query(_viol("weighted_vote_score_out_of_range"),
                                    _viol_sql("weighted_vote_score_out_of_range")),
    "audit_anomaly_summary": Query(
        _rounded_on_reviews(lambda df: audit.row_rule_summary(df, audit.ANOMALY_RULES)),
        with_reviews(_rule_rows("anomaly"))),
    "audit_viol_uint32_max": Query(_viol("votes_funny_exact_uint32_max"), _viol_sql("votes_funny_exact_uint32_max")),
    "audit_votes_funny_gap": Query(_rounded_on_reviews(audit.votes_funny_gap, 9), with_reviews(
        "SELECT MAX(votes_funny) AS max_non_artifact_votes_funny, "
        "ROUND(MAX(votes_funny) / 4294967295::DOUBLE * 100, 9) AS percent_of_uint32_max "
        "FROM reviews WHERE votes_funny < 4000000000")),
    "audit_describe": Query(_rounded_on_reviews(audit.describe_report, 3), with_reviews(_describe_sql(N, PCTS))),
    "audit_noise": Query(_rounded_on_reviews(audit.noise_report), with_reviews("\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, COUNT(*) FILTER (WHERE {_false_test(c)}) AS zero_or_false_count, "
        f"ROUND(COUNT(*) FILTER (WHERE {_false_test(c)})::DOUBLE / COUNT(*), 6) AS zero_or_false_rate FROM reviews"
        for c in NB))),
    "audit_uniqueness": Query(_rounded_on_reviews(audit.uniqueness_report), with_reviews(per_column(
        NB, "SELECT '{c}' AS column_name, COUNT(DISTINCT {c}) AS n_unique, "
            "ROUND(COUNT(DISTINCT {c})::DOUBLE / COUNT(*), 6) AS unique_rate FROM reviews"))),
    "audit_size_estimate": Query(_on_reviews(audit.size_estimate), with_reviews(
        "SELECT COUNT(*) AS row_count, CAST(SUM(144 + COALESCE(strlen(review), 0) + COALESCE(strlen(language), 0)) "
        "AS BIGINT) AS estimated_bytes FROM reviews")),
    "audit_all": Query(audit_all, with_reviews(
        full_audit_select("reviews", "user_min", "decreases"), _USERS, _DECREASES)),

    "dup_summary": Query(_on_reviews(duplicates.duplicate_totals), with_reviews("\nUNION ALL ".join(
        f"SELECT '{kind}_duplicate_{name}' AS item, CAST({value} AS BIGINT) AS item_count FROM "
        f"(SELECT COUNT(*) AS n FROM reviews GROUP BY {keys} HAVING COUNT(*) > 1)"
        for kind, keys in (("exact", COLS), ("key", KEYS))
        for name, value in (("groups", "COUNT(*)"), ("group_rows", "COALESCE(SUM(n), 0)"),
                            ("surplus_rows", "COALESCE(SUM(n), 0) - COUNT(*)"))))),
    "dup_exact_groups": Query(_on_reviews(duplicates.exact_duplicate_groups), with_reviews(
        f"SELECT {COLS}, COUNT(*) AS copies FROM reviews GROUP BY ALL HAVING COUNT(*) > 1")),
    "dup_key_groups": Query(_on_reviews(duplicates.key_duplicate_groups), with_reviews(
        f"SELECT {KEYS}, COUNT(*) AS copies FROM reviews GROUP BY ALL HAVING COUNT(*) > 1")),
    "dup_diagnostics": Query(_on_reviews(duplicates.duplicate_diagnostics), with_reviews(
        "SELECT * FROM d", _DIAGNOSTICS)),
    "dup_conflicting_rows": Query(_on_reviews(duplicates.conflicting_rows), with_reviews(
        f"SELECT {', '.join('r.' + c for c in ALL)} FROM reviews r JOIN d ON "
        + " AND ".join(f"r.{k} IS NOT DISTINCT FROM d.{k}" for k in S.KEY_COLUMNS)
        + " WHERE d.n_distinct_rows > 1", _DIAGNOSTICS)),

    "clean_dropna": Query(_on_reviews(cleaning.drop_incomplete), with_reviews(f"SELECT * FROM complete", CLEAN)),
    "clean_artifacts": Query(_on_reviews(cleaning.drop_artifacts), with_reviews(
        f"SELECT {COLS} FROM reviews WHERE votes_funny < 4000000000")),
    "clean_exact_dups": Query(_on_reviews(cleaning.drop_exact_duplicates), with_reviews(
        f"SELECT DISTINCT {COLS} FROM reviews")),
    "clean_keep_latest": Query(_on_reviews(cleaning.keep_latest), with_reviews(
        f"SELECT {COLS} FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY {KEYS} ORDER BY {_LATEST}) AS version "
        f"FROM reviews) WHERE version = 1")),
    "clean_full": Query(clean_full, with_reviews(f"SELECT {COLS} FROM cleaned", CLEAN)),
    "clean_step_counts": Query(_on_reviews(cleaning.step_counts), with_reviews("\nUNION ALL ".join(
        f"SELECT CAST({i} AS INT) AS step, '{name}' AS step_name, COUNT(*) AS row_count FROM {source}"
        for i, (name, source) in enumerate([
            ("input", "reviews"), ("drop_incomplete", "complete"), ("drop_artifacts", "artifact_free"),
            ("drop_exact_duplicates", "no_copies"), ("keep_latest", "cleaned")])), CLEAN)),

    "prep_ensure_columns": Query(_ensure_columns, with_reviews(
        "SELECT CAST(NULL AS VARCHAR) AS language, CAST(NULL AS INT) AS comment_count, COUNT(*) AS row_count, "
        "CAST(SUM(votes_up) AS BIGINT) AS sum_votes_up FROM reviews")),
    "prep_type_conversion": Query(_type_conversion, with_reviews(
        "SELECT author_steamid, appid, voted_up, weighted_vote_score, timestamp_created FROM reviews")),
    "prep_derived": Query(_derived, with_reviews(f"SELECT author_steamid, appid, {_DERIVED_SQL} FROM reviews")),
    "prep_indicators": Query(
        lambda spark, sf_dir: prepare.add_indicators(reviews(spark, sf_dir)).select(*S.KEY_COLUMNS, *_INDICATORS),
        with_reviews(f"SELECT {KEYS}, {_INDICATOR_SQL} FROM reviews")),
    "prep_quality_flags": Query(
        lambda spark, sf_dir: prepare.add_quality_flags(reviews(spark, sf_dir)).select(*S.KEY_COLUMNS, *_FLAGS),
        with_reviews(f"SELECT {KEYS}, {_FLAG_SQL} FROM reviews")),
    "feat_full": Query(_feat_full, with_reviews(
        f"SELECT {KEYS}, {_DERIVED_SQL}, {_INDICATOR_SQL} FROM cleaned", CLEAN)),
}

"""Exploration, coverage, sampling, split and churn queries with their oracle SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from emberline import schema as S
from emberline.functions.columns import union_all
from emberline.functions.storage import scratch_path
from emberline.operators import audit, churn, coverage, explore, sampling, timeline
from emberline.operators.quantiles import approx_cutoffs, rank_errors, sketched_cutoffs, time_sketches
from emberline.plans.oracle import per_column, with_both, with_reviews
from emberline.plans.registry import Query, rounded
from emberline.plans.review_queries import (
    COLS, _DECREASES, _USERS, _describe_sql, _on_reviews, _rounded_on_reviews, full_audit_select)
from emberline.sources import readers, sinks
from emberline.sources.testdata import DELISTED, UNREVIEWED, UNREVIEWED_SHIFT, catalog_dump, reviews, reviews_by_month, table

_BUCKET = "('0x' || substr(md5({id}::VARCHAR), 1, 8))::BIGINT % 10000"
_USER_BUCKET = _BUCKET.format(id="author_steamid")

# --- exploration ---------------------------------------------------------------------------

_EXTREMES = ["author_playtime_forever", "votes_up", "votes_funny"]

# --- coverage: all reviews against two overlapping catalogue dumps, read from CSV -------------
# One dump holds what was out by the end of 2012, the other what came out from 2005 on, both what has no date.

_FIRST_YEARS, _SECOND_YEARS = "release_date < '2013-01-01'", "release_date >= '2005-01-01'"


def _dump(spark, sf_dir, years):
    path = sinks.write_report(catalog_dump(spark, sf_dir, years), scratch_path(spark, "dumps"), "catalog", "csv")
    return readers.read_catalog_csv(spark, path)


def _first_dump(spark, sf_dir):
    return _dump(spark, sf_dir, _FIRST_YEARS)


def _second_dump(spark, sf_dir):
    return _dump(spark, sf_dir, _SECOND_YEARS)


def _catalog(spark, sf_dir):
    return coverage.catalog_union(_first_dump(spark, sf_dir), _second_dump(spark, sf_dir))


def _saved(df):
    """Written and read back, as the set is handed on."""
    path = scratch_path(df.sparkSession, "coverage")
    sinks.write_parquet(df, path)
    return readers.read_parquet(df.sparkSession, path)


_COVERAGE = f"""unreviewed AS (SELECT CAST(appid + {UNREVIEWED_SHIFT} AS INT) AS appid FROM games WHERE {UNREVIEWED}),
first_dump AS (SELECT appid FROM games WHERE NOT ({DELISTED}) AND (release_date IS NULL OR {_FIRST_YEARS}) UNION SELECT appid FROM unreviewed),
second_dump AS (SELECT appid FROM games WHERE NOT ({DELISTED}) AND (release_date IS NULL OR {_SECOND_YEARS}) UNION SELECT appid FROM unreviewed),
catalog AS (SELECT appid FROM first_dump UNION SELECT appid FROM second_dump),
reviewed AS (SELECT DISTINCT appid FROM reviews WHERE appid IS NOT NULL)"""

# --- sampling and splits -------------------------------------------------------------------

_SAMPLE = f"""cut AS (SELECT QUANTILE_DISC(timestamp_created, 0.95) AS cutoff FROM reviews),
sampled AS (SELECT {COLS} FROM reviews, cut WHERE {_USER_BUCKET} < 200 AND timestamp_created <= cutoff)"""


def _sample(spark, sf_dir):
    return sampling.sample_users_until(reviews_by_month(spark, sf_dir)).drop(timeline.MONTH)


#: A given user table, with users who have no reviews and users who are listed more than once.
_GIVEN_USERS = "SELECT o_custkey AS author_steamid FROM orders WHERE o_orderpriority = '1-URGENT'"


def _given_users(spark, sf_dir):
    urgent = table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'")
    return urgent.select(F.col("o_custkey").alias(S.USER))


def _split_given(spark, sf_dir):
    """Train rows by a given user table, test rows by all other users."""
    df, users = reviews(spark, sf_dir), _given_users(spark, sf_dir)
    rest = df.where(F.col(S.USER).isNotNull()).select(S.USER).distinct().join(users, S.USER, "left_anti")
    return sampling.size_report(train=sampling.rows_of_users(df, users), test=sampling.rows_of_users(df, rest))


def _cutoff_errors(spark, sf_dir):
    """Cutoffs by Spark's sketch and by stored monthly ones: whether their ranks are within a thousandth of the rows."""
    df, path = reviews(spark, sf_dir), scratch_path(spark, "sketches")
    sinks.write_parquet(time_sketches(df, S.CREATED, timeline.month_of(F.col(S.CREATED))), path)
    found = {"approx": approx_cutoffs(df, S.CREATED, _FRACTIONS), "merged": sketched_cutoffs(spark.read.parquet(path), _FRACTIONS)}
    return union_all([rank_errors(df, S.CREATED, cutoffs.first().asDict(), _FRACTIONS).select(
        F.lit(method).alias("method"), "cutoff_name", "row_count", (F.col("rank_error") <= 0.001).alias("within_limit"))
        for method, cutoffs in found.items()])


def _sample_vs_full(spark, sf_dir):
    df = reviews(spark, sf_dir)
    compared = audit.compare_with_sample(df, sampling.in_sample(df))
    return rounded(compared.withColumn("rate_difference", F.round("rate_difference", 4)), 6)


_SAMPLE_AUDIT = ", ".join([
    _SAMPLE, _USERS, _DECREASES,
    "s_user_min AS (SELECT author_steamid, MIN(author_num_reviews) AS min_author_num_reviews "
    "FROM sampled WHERE author_steamid IS NOT NULL GROUP BY 1)",
    _DECREASES.replace("steps", "s_steps").replace("lagged", "s_lagged").replace("decreases AS", "s_decreases AS")
    .replace("FROM reviews", "FROM sampled"),
    f"full_audit AS ({full_audit_select('reviews', 'user_min', 'decreases')})",
    f"sample_audit AS ({full_audit_select('sampled', 's_user_min', 's_decreases')})"])

_ROW_ORDER = ", ".join(f"{c} NULLS FIRST" for c in [*S.KEY_COLUMNS, *[c for c in S.REVIEW_SCHEMA if c not in S.KEY_COLUMNS]])
_KEY_TEXT = "concat_ws('|', " + ", ".join(f"COALESCE({k}::VARCHAR, '')" for k in S.KEY_COLUMNS) + ")"

# --- churn ---------------------------------------------------------------------------------

_CUTS = """cuts AS (SELECT 'train' AS snapshot, QUANTILE_DISC(timestamp_created, 0.70) AS cutoff FROM reviews
UNION ALL SELECT 'val', QUANTILE_DISC(timestamp_created, 0.80) FROM reviews
UNION ALL SELECT 'test', QUANTILE_DISC(timestamp_created, 0.90) FROM reviews)"""
_SNAPSHOTS = """past AS (
SELECT snapshot, cutoff, author_steamid, COUNT(*) AS n_reviews_before_T, COUNT(DISTINCT appid) AS n_games_reviewed_before_T,
 MAX(timestamp_created) AS last_review_ts_before_T, MIN(timestamp_created) AS first_review_ts_before_T,
 MAX(author_last_played) AS last_played_ts_before_T, MAX(author_playtime_forever) AS max_playtime_forever_before_T,
 ROUND(AVG(author_playtime_at_review), 6) AS avg_playtime_at_review_before_T,
 MAX(author_playtime_at_review) AS max_playtime_at_review_before_T,
 ROUND(AVG(voted_up::INT), 6) AS positive_review_rate_before_T,
 ROUND(AVG(weighted_vote_score::DOUBLE), 6) AS avg_weighted_vote_score_before_T,
 CAST(SUM(votes_up) AS BIGINT) AS total_votes_up_before_T, CAST(SUM(comment_count) AS BIGINT) AS total_comments_before_T,
 ROUND((cutoff - MAX(timestamp_created)) / 86400.0::DOUBLE, 6) AS days_since_last_review,
 ROUND((cutoff - MAX(author_last_played)) / 86400.0::DOUBLE, 6) AS days_since_last_played,
 ROUND((MAX(timestamp_created) - MIN(timestamp_created)) / 86400.0::DOUBLE, 6) AS account_observed_days
FROM reviews JOIN cuts ON timestamp_created <= cutoff WHERE author_steamid IS NOT NULL GROUP BY snapshot, cutoff, author_steamid
), future AS (
SELECT DISTINCT snapshot, author_steamid FROM reviews JOIN cuts ON timestamp_created > cutoff AND timestamp_created <= cutoff + 2592000
WHERE author_steamid IS NOT NULL
), labelled AS (
SELECT past.*, CASE WHEN future.author_steamid IS NULL THEN 1 ELSE 0 END AS churn
FROM past LEFT JOIN future ON past.snapshot = future.snapshot AND past.author_steamid = future.author_steamid)"""


# Snapshots read most of the log: storing it by month first would move more than its pruning saves.


def snapshots_all(spark, sf_dir):
    return rounded(churn.churn_snapshots_at_quantiles(reviews(spark, sf_dir)), 6)


def _snapshot(name: str):
    def run(spark, sf_dir):
        return rounded(churn.churn_snapshots_at_quantiles(
            reviews(spark, sf_dir), {name: churn.SNAPSHOTS[name]}), 6)
    return Query(run, with_reviews(f"SELECT * FROM labelled WHERE snapshot = '{name}'", _CUTS, _SNAPSHOTS))


def _features(spark, sf_dir):
    df = reviews_by_month(spark, sf_dir)
    cutoff = churn.temporal_cutoffs(df, {"train": 0.70}).scalar()
    return rounded(churn.churn_features(df, cutoff), 6)


def _leak_safe(spark, sf_dir):
    return rounded(churn.churn_snapshots_at_quantiles(reviews(spark, sf_dir), leak_safe=True), 6)


_LEAK_SAFE_SQL = with_reviews(
    "SELECT * EXCLUDE (last_played_ts_before_T, days_since_last_played, max_playtime_forever_before_T, "
    "avg_weighted_vote_score_before_T, total_votes_up_before_T, total_comments_before_T), "
    "p.last_played_ts_before_T, ROUND((cutoff - p.last_played_ts_before_T) / 86400.0::DOUBLE, 6) AS days_since_last_played "
    "FROM labelled JOIN played p USING (snapshot, author_steamid)",
    _CUTS, _SNAPSHOTS,
    "played AS (SELECT snapshot, author_steamid, MAX(CASE WHEN author_last_played <= cutoff THEN author_last_played END) "
    "AS last_played_ts_before_T FROM reviews JOIN cuts ON timestamp_created <= cutoff "
    "WHERE author_steamid IS NOT NULL GROUP BY 1, 2)")

_FRACTIONS = churn.SNAPSHOTS

QUERIES = {
    "eda_cardinality": Query(_on_reviews(explore.cardinality), with_reviews(
        "SELECT COUNT(*) AS row_count, COUNT(DISTINCT author_steamid) AS user_count, COUNT(DISTINCT appid) AS app_count FROM reviews")),
    "eda_playtime_stats": Query(
        _rounded_on_reviews(lambda df: explore.extremes(df, _EXTREMES), 4), with_reviews(per_column(
            _EXTREMES, "SELECT '{c}' AS column_name, MIN({c})::DOUBLE AS min_value, MAX({c})::DOUBLE AS max_value, "
                       "ROUND(AVG({c}), 4) AS mean_value FROM reviews"))),
    "eda_time_range": Query(_on_reviews(explore.time_range), with_reviews(
        "SELECT MIN(timestamp_created) AS first_ts, MAX(timestamp_created) AS last_ts FROM reviews")),
    "eda_summary": Query(_rounded_on_reviews(explore.summary, 3), with_reviews(
        _describe_sql(explore.SUMMARY_COLUMNS, {"p25": 0.25, "p50": 0.5, "p75": 0.75}))),
    "eda_votes": Query(_on_reviews(lambda df: explore.value_frequencies(df, "voted_up")), with_reviews(
        "SELECT voted_up, COUNT(*) AS review_count FROM reviews GROUP BY 1")),
    "eda_top_users": Query(_on_reviews(explore.top_users), with_reviews(
        "SELECT author_steamid, COUNT(*) AS review_count FROM reviews GROUP BY 1 "
        "ORDER BY review_count DESC, author_steamid NULLS LAST LIMIT 10")),
    "eda_top_users_games": Query(_on_reviews(explore.top_users_by_games), with_reviews(
        "SELECT author_steamid, COUNT(DISTINCT appid) AS games FROM reviews GROUP BY 1 "
        "ORDER BY games DESC, author_steamid NULLS LAST LIMIT 10")),
    "eda_top_apps": Query(_on_reviews(explore.top_apps), with_reviews(
        "SELECT appid, COUNT(*) AS review_count FROM reviews GROUP BY 1 ORDER BY review_count DESC, appid LIMIT 10")),
    "eda_preview": Query(
        _on_reviews(lambda df: explore.preview(df.select(*S.KEY_COLUMNS, "review"), [S.CREATED, S.USER, S.APP, "review"])),
        with_reviews("SELECT author_steamid, appid, timestamp_created, review FROM reviews ORDER BY timestamp_created "
                     "NULLS FIRST, author_steamid NULLS FIRST, appid NULLS FIRST, review NULLS FIRST LIMIT 5")),
    "eda_language_counts": Query(
        _on_reviews(lambda df: explore.value_frequencies(df, "language", drop_null=True)), with_reviews(
            "SELECT language, COUNT(*) AS review_count FROM reviews WHERE language IS NOT NULL GROUP BY 1")),

    "cov_catalog_union": Query(_catalog, with_both("SELECT appid FROM catalog", _COVERAGE)),
    "cov_reviews_not_in_catalog": Query(
        lambda spark, sf_dir: coverage.reviews_not_in_catalog(reviews(spark, sf_dir), _catalog(spark, sf_dir)),
        with_both("SELECT DISTINCT appid FROM reviews WHERE appid NOT IN (SELECT appid FROM catalog)", _COVERAGE)),
    "cov_games_not_reviewed": Query(
        lambda spark, sf_dir: _saved(coverage.games_not_reviewed(reviews(spark, sf_dir), _catalog(spark, sf_dir))),
        with_both("SELECT appid FROM catalog WHERE appid NOT IN (SELECT appid FROM reviewed)", _COVERAGE)),
    "cov_summary": Query(
        lambda spark, sf_dir: coverage.coverage_summary(
            reviews(spark, sf_dir), _first_dump(spark, sf_dir), _second_dump(spark, sf_dir)),
        with_both(
            "SELECT (SELECT COUNT(*) FROM first_dump) AS first_snapshot, (SELECT COUNT(*) FROM second_dump) AS second_snapshot, "
            "(SELECT COUNT(*) FROM catalog) AS catalog_apps, (SELECT COUNT(*) FROM reviewed) AS reviewed_apps, "
            "(SELECT COUNT(*) FROM (SELECT appid FROM reviewed EXCEPT SELECT appid FROM catalog)) AS reviewed_not_in_catalog, "
            "(SELECT COUNT(*) FROM (SELECT appid FROM catalog EXCEPT SELECT appid FROM reviewed)) AS catalog_not_reviewed, "
            "(SELECT COUNT(*) FROM (SELECT appid FROM catalog INTERSECT SELECT appid FROM reviewed)) AS in_both", _COVERAGE)),

    "sample_user_time": Query(_sample, with_reviews("SELECT * FROM sampled", _SAMPLE)),
    "sample_given_users": Query(
        lambda spark, sf_dir: sampling.rows_of_users(reviews(spark, sf_dir), _given_users(spark, sf_dir)),
        with_reviews(f"SELECT {COLS} FROM reviews WHERE author_steamid IN ({_GIVEN_USERS})")),
    "split_given_users": Query(_split_given, with_reviews(
        f"SELECT CASE WHEN author_steamid IN ({_GIVEN_USERS}) THEN 'train' ELSE 'test' END AS dataset, COUNT(*) AS row_count, "
        "COUNT(DISTINCT author_steamid) AS user_count FROM reviews WHERE author_steamid IS NOT NULL GROUP BY 1")),
    "split_cutoffs_error": Query(_cutoff_errors, with_reviews(
        "SELECT method, cutoff_name, COUNT(timestamp_created) AS row_count, TRUE AS within_limit FROM reviews, "
        "(VALUES ('approx'), ('merged')) m(method), (VALUES ('train'), ('val'), ('test')) c(cutoff_name) GROUP BY 1, 2")),
    "sample_report": Query(
        lambda spark, sf_dir: sampling.size_report(full=reviews(spark, sf_dir), sample=_sample(spark, sf_dir)),
        with_reviews("SELECT 'full' AS dataset, COUNT(*) AS row_count, COUNT(DISTINCT author_steamid) AS user_count FROM reviews "
                     "UNION ALL SELECT 'sample', COUNT(*), COUNT(DISTINCT author_steamid) FROM sampled", _SAMPLE)),
    "sample_n_rows": Query(_on_reviews(lambda df: sampling.sample_rows(df, 50_000)), with_reviews(
        f"SELECT {COLS} FROM reviews ORDER BY md5({_KEY_TEXT}), {_ROW_ORDER} LIMIT 50000")),
    "audit_sample_vs_full": Query(_sample_vs_full, with_reviews(
        "SELECT section, item, f.item_count AS full_count, f.item_rate AS full_rate, s.item_count AS sample_count, "
        "s.item_rate AS sample_rate, ROUND(s.item_rate - f.item_rate, 4) AS rate_difference "
        "FROM full_audit f LEFT JOIN sample_audit s USING (section, item)", _SAMPLE_AUDIT)),
    "split_user_train": Query(
        lambda spark, sf_dir: sampling.split_users(reviews(spark, sf_dir))[0],
        with_reviews(f"SELECT {COLS} FROM reviews WHERE {_USER_BUCKET} < 8000")),
    "split_user_test": Query(
        lambda spark, sf_dir: sampling.split_users(reviews(spark, sf_dir))[1],
        with_reviews(f"SELECT {COLS} FROM reviews WHERE {_USER_BUCKET} >= 8000")),
    "split_report": Query(_on_reviews(sampling.split_report), with_reviews(
        f"SELECT CASE WHEN {_USER_BUCKET} < 8000 THEN 'train' ELSE 'test' END AS dataset, COUNT(*) AS row_count, "
        "COUNT(DISTINCT author_steamid) AS user_count FROM reviews WHERE author_steamid IS NOT NULL GROUP BY 1")),
    "split_cutoffs": Query(_on_reviews(churn.temporal_cutoffs), with_reviews(
        "SELECT QUANTILE_DISC(timestamp_created, 0.70) AS train, QUANTILE_DISC(timestamp_created, 0.80) AS val, "
        "QUANTILE_DISC(timestamp_created, 0.90) AS test FROM reviews")),
    "split_cutoffs_approx": Query(
        _on_reviews(lambda df: approx_cutoffs(df, S.CREATED, _FRACTIONS)), None),

    "churn_features": Query(_features, with_reviews(
        "SELECT * EXCLUDE (snapshot, churn) FROM labelled WHERE snapshot = 'train'", _CUTS, _SNAPSHOTS)),
    "churn_snapshot_train": _snapshot("train"),
    "churn_snapshot_val": _snapshot("val"),
    "churn_snapshot_test": _snapshot("test"),
    "churn_snapshots_all": Query(snapshots_all, with_reviews("SELECT * FROM labelled", _CUTS, _SNAPSHOTS)),
    "churn_snapshots_leak_safe": Query(_leak_safe, _LEAK_SAFE_SQL),
}

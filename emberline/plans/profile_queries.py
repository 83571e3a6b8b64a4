"""Profiling, retention and model queries with their oracle SQL."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from emberline import schema as S
from emberline.functions.columns import union_all
from emberline.functions.storage import materialize
from emberline.operators import churn, models, profiling, retention
from emberline.operators.quantiles import nan_counts
from emberline.plans.oracle import per_column, with_reviews
from emberline.plans.registry import Query, rounded
from emberline.plans.review_queries import ALL, COLS, N, _on_reviews, _rounded_on_reviews
from emberline.plans.user_queries import _CUTS, _SNAPSHOTS
from emberline.sources.testdata import reviews, reviews_once, table

CATEGORIES = [*S.BOOLEAN_COLUMNS, "language", "author_num_reviews"]
TARGETS = ["author_playtime_forever", "author_playtime_at_review", S.SCORE_COLUMN, "review_length", "review_word_count"]

_COUNTS = "value_counts AS (" + per_column(
    N, "SELECT '{c}' AS column_name, {c}::DOUBLE AS value, COUNT(*) AS value_count FROM reviews WHERE {c} IS NOT NULL GROUP BY 2") + ")"
_TEXT_COUNTS = "text_counts AS (" + per_column(
    CATEGORIES, "SELECT '{c}' AS column_name, {c}::VARCHAR AS value, COUNT(*) AS value_count FROM reviews WHERE {c} IS NOT NULL GROUP BY 2") + ")"
_ENDS = "ends AS (SELECT column_name, MIN(value) AS lo, MAX(value) AS hi FROM value_counts GROUP BY 1)"


def _pairs(body: str, measure: str, source: str = "reviews", columns: list[str] = N) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{a}' AS column_1, '{b}' AS column_2, ROUND({body.format(a=a, b=b)}, 6) AS {measure}, "
        f"ABS({body.format(a=a, b=b)}) > 0.9 AS highly_correlated FROM {source}" for a, b in combinations(columns, 2))


_RANKS = "ranks AS (SELECT " + ", ".join(
    f"RANK() OVER (ORDER BY {c}) + (COUNT(*) OVER (PARTITION BY {c}) - 1) / 2.0::DOUBLE AS {c}" for c in N) + " FROM reviews)"
_NULLS = "null_flags AS (SELECT " + ", ".join(f"({c} IS NULL)::INT::DOUBLE AS {c}" for c in ALL) + " FROM reviews)"


def _interactions(spark, sf_dir):
    df = reviews(spark, sf_dir)
    lengths = profiling.text_lengths(df, "review", *TARGETS[:3])
    return profiling.interactions(lengths.withColumnsRenamed(
        {"text_length": "review_length", "word_count": "review_word_count"}), TARGETS)


def _interactions_sql() -> str:
    def bucket(c):
        return f"CAST(LEAST(FLOOR(({c} - lo_{c}) / (hi_{c} - lo_{c}) * 10), 9) AS INT)"
    ends = ", ".join(f"MIN({c})::DOUBLE AS lo_{c}, MAX({c})::DOUBLE AS hi_{c}" for c in TARGETS)
    body = "\nUNION ALL ".join(
        f"SELECT '{a}' AS target_x, '{b}' AS target_y, {bucket(a)} AS x_bucket, {bucket(b)} AS y_bucket, COUNT(*) AS n "
        f"FROM t, e WHERE {a} IS NOT NULL AND {b} IS NOT NULL GROUP BY 3, 4" for a, b in combinations(TARGETS, 2))
    return with_reviews(body, "t AS (SELECT *, LENGTH(review) AS review_length, "
                              "len(string_split_regex(TRIM(review), '[ \t\n\r]+')) AS review_word_count FROM reviews)",
                        f"e AS (SELECT {ends} FROM t)")


# The exact checks of the metrics use a fixed score: the longer ago the last review, the higher.
_SCORED = """scored AS (SELECT author_steamid, n_reviews_before_T, churn AS label,
 ROUND(((cutoff - last_review_ts_before_T) / 86400.0::DOUBLE) / ((cutoff - last_review_ts_before_T) / 86400.0::DOUBLE + 30), 6) AS score
 FROM labelled WHERE snapshot = 'test')"""


def _scored(spark, sf_dir):
    rows = churn.churn_snapshots_at_quantiles(reviews(spark, sf_dir), {"test": churn.SNAPSHOTS["test"]})
    days = F.col("days_since_last_review")
    return rows.select(S.USER, "n_reviews_before_T", F.col("churn").alias("label"), F.round(days / (days + 30), 6).alias("score"))


def _fit(kind: str):
    def run(spark, sf_dir):
        # Fitting reads its input many times, so the snapshots are stored first.
        rows = materialize(churn.churn_snapshots_at_quantiles(reviews(spark, sf_dir), leak_safe=True), "snapshots")
        return models.fit_and_score(rows.where(F.col("snapshot") == "train"), rows.where(F.col("snapshot") == "test"), kind)
    return Query(run, None)


def _model_scores(spark, sf_dir):
    """Every user of the test snapshot with the label, from all three models; scores are probabilities that agree with the prediction."""
    rows = materialize(churn.churn_snapshots_at_quantiles(reviews(spark, sf_dir), leak_safe=True), "snapshots")
    train, test = rows.where(F.col("snapshot") == "train"), rows.where(F.col("snapshot") == "test")
    agrees = (F.col("score").between(0, 1)) & ((F.col("score") > 0.5) == (F.col("predicted") == 1))
    return union_all([models.fit_and_score(train, test, kind).select(
        F.lit(kind).alias("model"), S.USER, F.col("label").cast("int").alias("label"), agrees.alias("consistent"))
        for kind in ("logreg", "rf", "gbt")])


def _pca_variance(spark, sf_dir):
    """Variances of all components: their sum is that of the scaled features, they fall, and components don't correlate."""
    rows = materialize(churn.churn_snapshots_at_quantiles(
        reviews(spark, sf_dir), {"train": churn.SNAPSHOTS["train"]}, leak_safe=True), "snapshots")
    k = len(models.FEATURES)
    parts = models.principal_components(rows, k)
    names = [f"pc{i + 1}" for i in range(k)]
    found = parts.agg(F.count("*").alias("n_users"), F.array(*[F.var_samp(c) for c in names]).alias("v"),
                      F.array(*[F.abs(F.covar_samp(a, b)) for a, b in combinations(names, 2)]).alias("c"))
    falls = F.forall(F.sequence(F.lit(2), F.lit(k)), lambda i: F.element_at("v", i) <= F.element_at("v", i - 1) + 1e-9)
    return found.select("n_users", F.round(F.aggregate("v", F.lit(0.0), lambda s, x: s + x), 4).alias("total_variance"),
                        falls.alias("in_order"), (F.array_max("c") < 1e-6).alias("uncorrelated"))


def _als_fit(spark, sf_dir):
    """ALS against the mean of all training ratings, on the pairs it was fitted to and in squared error."""
    found = models.playtime_factors(reviews_once(spark, sf_dir), held_out=False)
    return found.agg(F.count("*").alias("n_pairs"), F.count("prediction").alias("n_predicted"),
                     (F.avg(F.pow(F.col("rating") - F.col("prediction"), 2)) < F.var_pop("rating")).alias("better_than_mean"))


def _pca(spark, sf_dir):
    return models.principal_components(materialize(churn.churn_snapshots_at_quantiles(
        reviews(spark, sf_dir), {"train": churn.SNAPSHOTS["train"]}, leak_safe=True), "snapshots"))


_SLICE = "LEAST(n_reviews_before_T // 10, 9)"

QUERIES = {
    "prof_quantiles": Query(_rounded_on_reviews(lambda df: profiling.quantile_table(df, N)), with_reviews("\nUNION ALL ".join(
        per_column(N, f"SELECT '{{c}}' AS column_name, {q}::DOUBLE AS q, ROUND(QUANTILE_CONT({{c}}::DOUBLE, {q}), 6) AS quantile FROM reviews")
        for q in profiling.QUANTILES))),
    "prof_nan_counts": Query(_on_reviews(lambda df: nan_counts(df, N)), with_reviews(per_column(
        N, "SELECT '{c}' AS column_name, COUNT(*) FILTER (WHERE isnan({c}::DOUBLE)) AS nan_count FROM reviews"))),
    "prof_skewness": Query(_rounded_on_reviews(lambda df: profiling.skewness(df, N), 5), with_reviews(
        "SELECT column_name, ROUND(m3 / POWER(m2, 1.5), 5) AS skewness, ABS(m3 / POWER(m2, 1.5)) > 20 AS highly_skewed FROM ("
        "SELECT column_name, SUM(value_count * POWER(value - mean, 2)) / SUM(value_count) AS m2, "
        "SUM(value_count * POWER(value - mean, 3)) / SUM(value_count) AS m3 FROM value_counts JOIN "
        "(SELECT column_name, SUM(value * value_count) / SUM(value_count) AS mean FROM value_counts GROUP BY 1) USING (column_name) GROUP BY 1)",
        _COUNTS)),
    "prof_histogram": Query(_rounded_on_reviews(lambda df: profiling.histogram(df, N)), with_reviews(
        "SELECT column_name, bin, ROUND(MAX(lo + (hi - lo) * bin / 50), 6) AS bin_start, CAST(SUM(value_count) AS BIGINT) AS bin_count FROM "
        "(SELECT *, CAST(LEAST(FLOOR((value - lo) / (hi - lo) * 50), 49) AS INT) AS bin FROM value_counts JOIN ends USING (column_name)) GROUP BY 1, 2",
        _COUNTS, _ENDS)),
    "prof_boxplot": Query(_rounded_on_reviews(lambda df: profiling.boxplot(df, N)), with_reviews(per_column(
        N, "SELECT '{c}' AS column_name, ROUND(q1, 6) AS q1, ROUND(median, 6) AS median, ROUND(q3, 6) AS q3, "
           "ROUND(MIN({c}::DOUBLE) FILTER (WHERE {c} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), 6) AS whisker_low, "
           "ROUND(MAX({c}::DOUBLE) FILTER (WHERE {c} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), 6) AS whisker_high, "
           "COUNT(*) FILTER (WHERE {c} NOT BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS n_outliers "
           "FROM reviews, (SELECT QUANTILE_CONT({c}::DOUBLE, 0.25) AS q1, QUANTILE_CONT({c}::DOUBLE, 0.5) AS median, "
           "QUANTILE_CONT({c}::DOUBLE, 0.75) AS q3 FROM reviews) GROUP BY q1, median, q3"))),
    "prof_categories": Query(_on_reviews(lambda df: profiling.categories(df, CATEGORIES)), with_reviews(
        "SELECT * FROM (SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY column_name ORDER BY value_count DESC, value) AS INT) AS position "
        "FROM text_counts) WHERE position <= 10", _TEXT_COUNTS)),
    "prof_imbalance": Query(_rounded_on_reviews(lambda df: profiling.imbalance(df, CATEGORIES)), with_reviews(
        "SELECT column_name, n_values, ROUND(i, 6) AS imbalance, i > 0.5 AS is_imbalanced, n_values > 50 AS high_cardinality FROM ("
        "SELECT column_name, COUNT(*) AS n_values, CASE WHEN COUNT(*) > 1 THEN 1 + SUM(p * LOG2(p)) / LOG2(COUNT(*)) ELSE 1 END AS i FROM "
        "(SELECT column_name, value_count / (SUM(value_count) OVER (PARTITION BY column_name))::DOUBLE AS p FROM text_counts) GROUP BY 1)",
        _TEXT_COUNTS)),
    "prof_extremes": Query(_rounded_on_reviews(lambda df: profiling.extreme_values(df, N)), with_reviews("\nUNION ALL ".join(
        f"SELECT column_name, ROUND(value, 6) AS value, value_count, position, '{side}' AS side FROM (SELECT *, CAST(ROW_NUMBER() OVER "
        f"(PARTITION BY column_name ORDER BY value {order}) AS INT) AS position FROM value_counts) WHERE position <= 5"
        for side, order in (("lowest", "ASC"), ("highest", "DESC"))), _COUNTS)),
    "prof_pearson": Query(_rounded_on_reviews(lambda df: profiling.pearson(df, N)), with_reviews(
        _pairs("CORR({a}::DOUBLE, {b}::DOUBLE)", "pearson"))),
    "prof_spearman": Query(_rounded_on_reviews(lambda df: profiling.spearman(df, N)), with_reviews(
        _pairs("CORR({a}, {b})", "spearman", "ranks"), _RANKS)),
    "prof_nullity_corr": Query(_rounded_on_reviews(profiling.nullity_correlation), with_reviews(
        "SELECT column_1, column_2, nullity_correlation FROM (" + "\nUNION ALL ".join(
            f"SELECT '{a}' AS column_1, '{b}' AS column_2, CASE WHEN MIN({a}) < MAX({a}) AND MIN({b}) < MAX({b}) "
            f"THEN ROUND(CORR({a}, {b}), 6) END AS nullity_correlation FROM null_flags" for a, b in combinations(ALL, 2))
        + ") WHERE nullity_correlation IS NOT NULL", _NULLS)),
    "prof_duplicates": Query(_rounded_on_reviews(profiling.duplicate_share), with_reviews(
        f"SELECT (SELECT COUNT(*) FROM reviews) - n AS n_duplicates, ROUND(((SELECT COUNT(*) FROM reviews) - n)::DOUBLE / "
        f"(SELECT COUNT(*) FROM reviews), 6) AS p_duplicates FROM (SELECT COUNT(*) AS n FROM (SELECT DISTINCT {COLS} FROM reviews))")),
    "prof_head_tail": Query(
        _on_reviews(lambda df: profiling.head_tail(
            df.select(*S.KEY_COLUMNS, S.UPDATED), [S.CREATED, S.USER, S.APP, S.UPDATED])), with_reviews("\nUNION ALL ".join(
                f"SELECT * FROM (SELECT author_steamid, appid, timestamp_created, timestamp_updated, '{side}' AS side FROM reviews ORDER BY "
                + ", ".join(f"{c} {order}" for c in (S.CREATED, S.USER, S.APP, S.UPDATED)) + " LIMIT 5)"
                for side, order in (("head", "ASC NULLS FIRST"), ("tail", "DESC NULLS LAST"))))),
    "prof_text_lengths": Query(
        lambda spark, sf_dir: profiling.text_lengths(table(spark, sf_dir, "documents"), "text", "doc_id"),
        "SELECT doc_id, CAST(LENGTH(text) AS INT) AS text_length, CAST(CASE WHEN LENGTH(TRIM(text)) > 0 THEN "
        "len(string_split_regex(TRIM(text), '[ \t\n\r]+')) WHEN text IS NOT NULL THEN 0 END AS INT) AS word_count FROM documents"),
    "prof_interactions": Query(_interactions, _interactions_sql()),
    "prof_rejects": Query(_on_reviews(profiling.rejected_columns), with_reviews(per_column(
        ALL, "SELECT '{c}' AS column_name, COUNT({c}) AS n_known, COUNT(DISTINCT {c}) AS n_unique, "
             "COUNT({c}) = 0 AND COUNT(*) > 0 AS all_null, COUNT(DISTINCT {c}) = 1 AS constant, "
             "COALESCE(COUNT(DISTINCT {c})::DOUBLE / NULLIF(COUNT({c}), 0) > 0.95, FALSE) AS id_like FROM reviews"))),

    "retention_curve": Query(
        lambda spark, sf_dir: retention.retention_curve(table(spark, sf_dir, "events")),
        "WITH active AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events WHERE user_id IS NOT NULL), "
        "firsts AS (SELECT user_id, MIN(day) AS cohort FROM active GROUP BY 1), "
        "d AS (SELECT CAST(unnest([1, 7, 14, 21, 30]) AS INT) AS day_number) "
        "SELECT cohort, day_number, COUNT(*) AS cohort_users, CASE WHEN cohort + day_number <= (SELECT MAX(day) FROM active) "
        "THEN COUNT(a.user_id) END AS retained_users FROM firsts f CROSS JOIN d "
        "LEFT JOIN active a ON a.user_id = f.user_id AND a.day = f.cohort + d.day_number GROUP BY 1, 2"),
    "ml_logreg": _fit("logreg"),
    "ml_rf": _fit("rf"),
    "ml_gbt": _fit("gbt"),
    "ml_pca": Query(_pca, None),
    "ml_als": Query(lambda spark, sf_dir: models.playtime_factors(reviews_once(spark, sf_dir)), None),
    "ml_scores": Query(_model_scores, with_reviews(
        "SELECT model, author_steamid, churn AS label, TRUE AS consistent FROM labelled, (VALUES ('logreg'), ('rf'), ('gbt')) m(model) "
        "WHERE snapshot = 'test'", _CUTS, _SNAPSHOTS)),
    "ml_pca_variance": Query(_pca_variance, with_reviews(
        "SELECT COUNT(*) AS n_users, ROUND(" + " + ".join(f"CASE WHEN VAR_SAMP(COALESCE({c}, 0)::DOUBLE) > 0 THEN 1.0::DOUBLE ELSE 0 END" for c in models.FEATURES)
        + ", 4) AS total_variance, TRUE AS in_order, TRUE AS uncorrelated FROM labelled WHERE snapshot = 'train'", _CUTS, _SNAPSHOTS)),
    "ml_als_fit": Query(_als_fit, with_reviews(
        "SELECT COUNT(*) AS n_pairs, COUNT(*) AS n_predicted, TRUE AS better_than_mean FROM (SELECT DISTINCT author_steamid, appid FROM reviews "
        "WHERE author_steamid IS NOT NULL AND ('0x' || substr(md5(author_steamid::VARCHAR || '|' || appid::VARCHAR), 1, 8))::BIGINT "
        "% 10000 >= 2000)")),
    "ml_als_held_out": Query(
        lambda spark, sf_dir: rounded(models.playtime_factors(reviews_once(spark, sf_dir)).select(S.USER, S.APP, "rating"), 6), with_reviews(
            "SELECT author_steamid, appid, ROUND(MAX(LN(1 + author_playtime_forever::DOUBLE)), 6) AS rating FROM reviews "
            "WHERE author_steamid IS NOT NULL AND ('0x' || substr(md5(author_steamid::VARCHAR || '|' || appid::VARCHAR), 1, 8))::BIGINT "
            "% 10000 < 2000 GROUP BY 1, 2")),
    "ml_metrics": Query(lambda spark, sf_dir: rounded(models.classification_metrics(_scored(spark, sf_dir)), 6), with_reviews(
        "SELECT ROUND((tp + tn)::DOUBLE / (tp + tn + fp + fn), 6) AS accuracy, ROUND(tp::DOUBLE / (tp + fp), 6) AS precision, "
        "ROUND(tp::DOUBLE / (tp + fn), 6) AS recall, ROUND(2.0::DOUBLE * tp / (2 * tp + fp + fn), 6) AS f1, ROUND(auc, 6) AS roc_auc FROM ("
        "SELECT COUNT(*) FILTER (WHERE score >= 0.5 AND label = 1) AS tp, COUNT(*) FILTER (WHERE score >= 0.5 AND label = 0) AS fp, "
        "COUNT(*) FILTER (WHERE score < 0.5 AND label = 1) AS fn, COUNT(*) FILTER (WHERE score < 0.5 AND label = 0) AS tn FROM scored), "
        "(SELECT AVG(CASE WHEN a.score > b.score THEN 1.0::DOUBLE WHEN a.score = b.score THEN 0.5 ELSE 0 END) AS auc "
        "FROM scored a JOIN scored b ON a.label = 1 AND b.label = 0)", _CUTS, _SNAPSHOTS, _SCORED)),
    "ml_error_slices": Query(
        lambda spark, sf_dir: rounded(models.error_slices(
            _scored(spark, sf_dir), F.least(F.floor(F.col("n_reviews_before_T") / 10), F.lit(9))), 6), with_reviews(
                f"SELECT {_SLICE} AS slice, COUNT(*) AS users, COUNT(*) FILTER (WHERE (score >= 0.5) <> (label = 1)) AS misclassified, "
                f"ROUND(AVG(((score >= 0.5) <> (label = 1))::INT), 6) AS error_rate FROM scored GROUP BY 1", _CUTS, _SNAPSHOTS, _SCORED)),
    "ml_threshold_sweep": Query(lambda spark, sf_dir: rounded(models.threshold_sweep(_scored(spark, sf_dir)), 6), with_reviews(
        "SELECT i / 100.0::DOUBLE AS threshold, COUNT(*) FILTER (WHERE bucket >= i AND label = 1) AS tp, "
        "COUNT(*) FILTER (WHERE bucket >= i) AS predicted_positive, "
        "ROUND((COUNT(*) FILTER (WHERE bucket >= i AND label = 1))::DOUBLE / NULLIF(COUNT(*) FILTER (WHERE bucket >= i), 0), 6) AS precision, "
        "ROUND((COUNT(*) FILTER (WHERE bucket >= i AND label = 1))::DOUBLE / NULLIF(COUNT(*) FILTER (WHERE label = 1), 0), 6) AS recall "
        "FROM (SELECT *, LEAST(FLOOR(score * 100), 100) AS bucket FROM scored), range(0, 101) r(i) GROUP BY i", _CUTS, _SNAPSHOTS, _SCORED)),
}

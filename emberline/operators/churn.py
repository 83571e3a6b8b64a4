"""Point-in-time churn snapshots: features up to a cutoff, label from the days after it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberline import schema as S
from emberline.functions.columns import epoch_seconds
from emberline.operators.quantiles import exact_cutoffs
from emberline.operators.timeline import until

SNAPSHOTS = {"train": 0.70, "val": 0.80, "test": 0.90}
HORIZON_DAYS = 30
# Values taken when the data was crawled, not when the review was written.
CRAWL_TIME_FEATURES = ["max_playtime_forever_before_T", "avg_weighted_vote_score_before_T",
                       "total_votes_up_before_T", "total_comments_before_T"]


def temporal_cutoffs(df: DataFrame, fractions: dict[str, float] = SNAPSHOTS) -> DataFrame:
    """One row with the exact discrete percentile of the event time per snapshot."""
    return exact_cutoffs(df.select(epoch_seconds(df, S.CREATED).alias(S.CREATED)), S.CREATED, fractions)


# Per snapshot: name -> aggregate over a user's rows, where {p} is "in the past of the cutoff".
_FEATURES = {
    "n_reviews_before_T": "count_if({p})",
    "last_review_ts_before_T": "max(CASE WHEN {p} THEN created END)",
    "first_review_ts_before_T": "min(CASE WHEN {p} THEN created END)",
    "last_played_ts_before_T": "max(CASE WHEN {p}{played} THEN played END)",
    "max_playtime_forever_before_T": "max(CASE WHEN {p} THEN author_playtime_forever END)",
    "avg_playtime_at_review_before_T": "avg(CASE WHEN {p} THEN author_playtime_at_review END)",
    "max_playtime_at_review_before_T": "max(CASE WHEN {p} THEN author_playtime_at_review END)",
    "positive_review_rate_before_T": "avg(CASE WHEN {p} THEN CAST(voted_up AS INT) END)",
    "avg_weighted_vote_score_before_T": "avg(CASE WHEN {p} THEN CAST(weighted_vote_score AS DOUBLE) END)",
    "total_votes_up_before_T": "sum(CASE WHEN {p} THEN votes_up END)",
    "total_comments_before_T": "sum(CASE WHEN {p} THEN comment_count END)",
}


def churn_snapshots(df: DataFrame, cutoffs: dict[str, int | Column], horizon_days: int = HORIZON_DAYS,
                    leak_safe: bool = False) -> DataFrame:
    """Features and label of every user seen up to each cutoff: one aggregate for all cutoffs.

    A review counts for a snapshot's past up to and including its cutoff T, and for its label in
    (T, T + horizon]. All snapshots are conditional sums of one aggregate per user, so a user with
    very many reviews reaches the shuffle as one row per input partition. The number of distinct apps
    per cutoff follows from the first review of each (user, app).

    ``leak_safe`` ignores last-played times after the cutoff and leaves out crawl-time features.
    """
    horizon = horizon_days * S.SECONDS_PER_DAY
    ends = {name: (t if isinstance(t, Column) else F.lit(t)).cast("long") for name, t in cutoffs.items()}
    last_end = F.greatest(*ends.values()) if len(ends) > 1 else next(iter(ends.values()))
    cut = F.struct(*[t.alias(name) for name, t in ends.items()])
    known = until(df, last_end + horizon).where(F.col(S.USER).isNotNull()).withColumns({
        "created": epoch_seconds(df, S.CREATED), "played": epoch_seconds(df, S.LAST_PLAYED), "cut": cut})
    features = {k: v for k, v in _FEATURES.items() if not (leak_safe and k in CRAWL_TIME_FEATURES)}
    parts = []
    for name in ends:
        past = f"created <= cut.`{name}`"
        played = f" AND played <= cut.`{name}`" if leak_safe else ""
        columns = [f"{text.replace('{p}', past).replace('{played}', played)} AS {feature}" for feature, text in features.items()]
        future = f"count_if(created > cut.`{name}` AND created <= cut.`{name}` + {horizon}L) > 0"
        parts.append(f"struct('{name}' AS snapshot, max(cut.`{name}`) AS cutoff, {', '.join(columns)}, "
                     f"CASE WHEN {future} THEN 0 ELSE 1 END AS churn) AS `s_{name}`")
    per_user = known.groupBy(S.USER).agg(*map(F.expr, parts))
    per_app = known.where(F.col(S.APP).isNotNull()).groupBy(S.USER, S.APP).agg(
        F.min("created").alias("first")).withColumn("cut", cut)
    games = per_app.groupBy(S.USER).agg(*[
        F.expr(f"count_if(first <= cut.`{name}`)").alias(f"g_{name}") for name in ends])
    rows = ", ".join(f"named_struct('s', `s_{name}`, 'g', coalesce(`g_{name}`, 0L))" for name in ends)
    long = (per_user.join(games, S.USER, "left").selectExpr(S.USER, f"inline(array({rows}))")
            .selectExpr(S.USER, "s.*", "g AS n_games_reviewed_before_T").where("n_reviews_before_T > 0"))
    day = float(S.SECONDS_PER_DAY)
    return long.selectExpr(
        *[c for c in long.columns if c != "churn"],
        f"(cutoff - last_review_ts_before_T) / {day}D AS days_since_last_review",
        f"(cutoff - last_played_ts_before_T) / {day}D AS days_since_last_played",
        f"(last_review_ts_before_T - first_review_ts_before_T) / {day}D AS account_observed_days", "churn")


def churn_snapshots_at_quantiles(df: DataFrame, fractions: dict[str, float] = SNAPSHOTS, **options) -> DataFrame:
    """Snapshots at time quantiles. The few cutoffs are computed first: as literals they reach the scan."""
    found = temporal_cutoffs(df, fractions).first()
    if any(found[name] is None for name in fractions):  # no events: no cutoff, and no snapshot
        return churn_snapshots(df.limit(0), dict.fromkeys(fractions, 0), **options)
    return churn_snapshots(df, {name: found[name] for name in fractions}, **options)


def churn_features(df: DataFrame, cutoff: int | Column) -> DataFrame:
    """Features alone at one cutoff."""
    return churn_snapshots(df, {"snapshot": cutoff}).drop("snapshot", "churn")

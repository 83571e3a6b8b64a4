from pyspark.sql import functions as F

from emberline import schema as S
from emberline.operators import churn, coverage, explore, sampling
from emberline.operators.quantiles import (
    approx_cutoffs, exact_cutoffs, percentiles, percentiles_disc, ranked_values, value_counts)
from helpers import rows_frame

DAY = S.SECONDS_PER_DAY


def test_label_borders(spark):
    t, h = 100 * DAY, 30 * DAY
    after = {1: t + 1, 2: t + h, 3: t + h + 1, 4: t}
    rows = [{S.USER: u, S.CREATED: t} for u in after] + [{S.USER: u, S.CREATED: c, S.APP: 2} for u, c in after.items()]
    out = {r[S.USER]: (r.churn, r.n_reviews_before_T, r.n_games_reviewed_before_T)
           for r in churn.churn_snapshots(rows_frame(spark, rows), {"x": t}).collect()}
    assert out == {1: (0, 1, 1), 2: (0, 1, 1), 3: (1, 1, 1), 4: (1, 2, 2)}


def test_users_without_past_are_absent_and_null_users_ignored(spark):
    df = rows_frame(spark, [{S.USER: 1, S.CREATED: 200}, {S.USER: None, S.CREATED: 5}, {S.USER: 2, S.CREATED: 5}])
    assert [r[S.USER] for r in churn.churn_snapshots(df, {"x": 100}).collect()] == [2]


def test_several_cutoffs_equal_single_ones_and_timestamps_equal_longs(spark):
    df = rows_frame(spark, [{S.USER: i % 7, S.APP: i % 5, S.CREATED: i * DAY, "weighted_vote_score": (i % 10) / 10}
                            for i in range(120)])
    cuts = {"a": 30 * DAY, "b": 60 * DAY, "c": 90 * DAY}
    both = churn.churn_snapshots(df, cuts)
    for name, cut in cuts.items():
        one = churn.churn_snapshots(df, {name: cut})
        assert sorted(map(str, both.where(F.col("snapshot") == name).collect())) == sorted(map(str, one.collect()))
    stamped = df.withColumns({c: F.timestamp_seconds(c) for c in S.EPOCH_COLUMNS})
    assert sorted(map(str, churn.churn_snapshots(stamped, cuts).collect())) == sorted(map(str, both.collect()))


def test_leak_safe_ignores_the_future(spark):
    df = rows_frame(spark, [{S.USER: 1, S.CREATED: 10, S.LAST_PLAYED: 500}])
    leaky = churn.churn_snapshots(df, {"x": 100}).first()
    safe = churn.churn_snapshots(df, {"x": 100}, leak_safe=True)
    assert leaky.days_since_last_played < 0
    assert safe.first().days_since_last_played is None
    assert not set(churn.CRAWL_TIME_FEATURES) & set(safe.columns)


def test_quantiles_against_numpy_and_partitioning(spark):
    import numpy as np
    rng = np.random.default_rng(3)
    # A third of the rows share one value, and there are more distinct values than bucket borders.
    values = np.concatenate([np.zeros(1000), rng.integers(-500, 100_000, 2000)]).astype(float)
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    fractions = [0.0, 0.01, 0.25, 0.5, 0.75, 0.9, 0.99, 1.0]
    for parts in (1, 16):
        ranked = ranked_values(value_counts(df.repartition(parts), ["x"]))
        got = {r.q: r.quantile for r in percentiles(ranked, fractions).collect()}
        for q in fractions:
            assert abs(got[q] - np.quantile(values, q)) < 1e-6
        disc = {r.q: r.quantile for r in percentiles_disc(ranked, fractions).collect()}
        for q in fractions:
            assert disc[q] == np.quantile(values, q, method="inverted_cdf")
        last = ranked.agg(F.max("hi"), F.sum("value_count")).first()
        assert last[0] == last[1] == 3000


def test_approximate_cutoffs_are_close(spark):
    df = spark.range(100_000).withColumnRenamed("id", "x")
    exact, near = exact_cutoffs(df, "x", {"c": 0.7}).first().c, approx_cutoffs(df, "x", {"c": 0.7}).first().c
    assert exact == 69_999 and abs(near - exact) <= 200


def test_split_is_disjoint_complete_and_stable(spark):
    df = rows_frame(spark, [{S.USER: i % 300, S.CREATED: i} for i in range(900)] + [{S.USER: None}])
    train, test = sampling.split_users(df)
    left = {r[0] for r in train.select(S.USER).collect()}
    right = {r[0] for r in test.select(S.USER).collect()}
    assert not left & right and left | right == set(range(300)) and 200 < len(left) < 270
    again, _ = sampling.split_users(df.repartition(16))
    assert {r[0] for r in again.select(S.USER).collect()} == left
    report = {r.dataset: (r.row_count, r.user_count) for r in sampling.split_report(df).collect()}
    assert report == {"train": (train.count(), len(left)), "test": (test.count(), len(right))}
    users = train.select(S.USER).distinct()
    assert sampling.rows_of_users(df, users).count() == train.count()


def test_samples(spark):
    df = rows_frame(spark, [{S.USER: i, S.CREATED: i} for i in range(1000)])
    sample = sampling.sample_users_until(df, share=0.5, quantile=0.9)
    rows = sample.collect()
    assert rows and max(r[S.CREATED] for r in rows) <= 899
    assert sample.exceptAll(df).count() == 0
    picked = sampling.sample_rows(df, 10)
    assert picked.count() == 10 and picked.collect() == sampling.sample_rows(df.repartition(4), 10).collect()
    assert sampling.sample_rows(df, 5000).count() == 1000


def test_coverage(spark):
    reviews = rows_frame(spark, [{S.APP: a} for a in (1, 1, 2, 3)] + [{S.APP: None}])
    first = spark.createDataFrame([(1,), (4,)], "appid int")
    second = spark.createDataFrame([(4,), (2,), (None,)], "appid int")
    catalog = coverage.catalog_union(first, second)
    assert sorted(r[0] for r in catalog.collect()) == [1, 2, 4]
    assert [r[0] for r in coverage.reviews_not_in_catalog(reviews, catalog).collect()] == [3]
    assert [r[0] for r in coverage.games_not_reviewed(reviews, catalog).collect()] == [4]
    assert tuple(coverage.coverage_summary(reviews, first, second).first()) == (2, 2, 3, 3, 1, 1, 2)


def test_exploration(spark):
    df = rows_frame(spark, [{S.USER: u, S.APP: a} for u, a in ((1, 1), (1, 1), (1, 2), (2, 1), (3, 1), (None, 9))])
    assert tuple(explore.cardinality(df).first()) == (6, 3, 3)
    assert [r[0] for r in explore.top_users(df, 2).collect()] == [1, 2]
    assert [tuple(r) for r in explore.top_users_by_games(df, 1).collect()] == [(1, 2)]
    one = {(r.column_name, r.measure): r.measure_value for r in explore.summary(df, ["votes_up"]).collect()}
    assert one[("votes_up", "count")] == 6 and one[("votes_up", "stddev")] == 0


def test_snapshots_of_no_reviews_are_empty(spark):
    out = churn.churn_snapshots_at_quantiles(rows_frame(spark, []))
    assert out.count() == 0 and "churn" in out.columns


def test_snapshots_read_the_log_as_it_was_ingested(spark):
    """They need most of it; a copy by month would shuffle and write more than they themselves do."""
    from emberline.plans import all_queries
    queries = all_queries()
    for name in ("churn_snapshot_train", "churn_snapshot_val", "churn_snapshot_test", "churn_snapshots_all"):
        files = queries[name].run(spark, "/root/testdata/sf0.001").inputFiles()
        assert files and all("/reviews-" in f and "by-month" not in f for f in files), name

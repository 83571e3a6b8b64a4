from pyspark.sql import functions as F

from emberline import schema as S
from emberline.operators import audit, cleaning, duplicates, prepare
from helpers import rows_frame


def counts(df, key="issue_name", value="violation_count"):
    return {r[key]: r[value] for r in df.collect()}


def test_row_rules_at_their_limits(spark):
    df = rows_frame(spark, [
        {"votes_funny": v} for v in (3_999_999_999, 4_000_000_000, 4_294_967_294, 4_294_967_295, None)
    ] + [{"author_playtime_last_two_weeks": v, "author_playtime_forever": 50_000} for v in (18_143, 18_144, 20_160, 20_161)])
    found = counts(audit.row_rule_summary(df, audit.ANOMALY_RULES))
    assert found == {"votes_funny_is_uint32_artifact": 3, "votes_funny_near_exact_uint32_artifact_max": 2,
                     "votes_funny_exact_uint32_max": 1, "playtime_2w_near_limit": 3, "playtime_2w_exceeds_limit": 1}


def test_null_is_no_violation_and_summary_matches_violations(spark):
    df = rows_frame(spark, [
        {S.CREATED: 10, S.UPDATED: 5}, {S.CREATED: 5, S.UPDATED: 5}, {S.CREATED: None, S.UPDATED: 5},
        {"weighted_vote_score": 1.5}, {"weighted_vote_score": -0.1}, {"weighted_vote_score": 1.0}, {"votes_up": -1}])
    summary = counts(audit.row_rule_summary(df, audit.ROW_RULES))
    assert summary["timestamp_created_gt_timestamp_updated"] == 1
    assert summary["weighted_vote_score_out_of_range"] == 2
    assert summary["votes_up_negative"] == 1
    for rule in audit.ROW_RULES:
        assert audit.violations(df, rule.name).count() == summary[rule.name], rule.name


def test_rates_of_an_empty_frame_are_null(spark):
    df = rows_frame(spark, [])
    for report in (audit.null_report(df), audit.noise_report(df), audit.consistency_report(df)):
        assert all(r[2] is None for r in report.collect())
    assert audit.full_audit(df).where("item_rate IS NOT NULL").count() == 0


def test_zero_review_users_count_against_users(spark):
    df = rows_frame(spark, [{S.USER: 1, "author_num_reviews": 0}, {S.USER: 1, "author_num_reviews": 4},
                            {S.USER: 2, "author_num_reviews": 3}, {S.USER: None, "author_num_reviews": 0},
                            {S.USER: 3, "author_num_reviews": -1}])
    assert {r[0] for r in audit.users_with_zero_reviews(df).collect()} == {1, 3}
    rate = counts(audit.consistency_report(df), value="violation_rate")[audit.ZERO_REVIEW_RULE]
    assert abs(rate - 2 / 3) < 1e-12


def test_playtime_decreases_across_buckets_copies_and_ties(spark):
    day = S.SECONDS_PER_DAY
    steps = [(1, 0, 100), (1, 0, 100), (1, 5 * day, 90), (1, 70 * day, 80), (1, 200 * day, 85), (1, 201 * day, 84)]
    df = rows_frame(spark, [{S.USER: u, S.CREATED: t, S.UPDATED: t, "author_playtime_forever": p} for u, t, p in steps])
    found = sorted((r[S.CREATED] // day, r["author_playtime_forever"], r["prev_playtime_forever"])
                   for r in audit.playtime_decreases(df).collect())
    assert found == [(5, 90, 100), (70, 80, 90), (201, 84, 85)]


def test_playtime_decreases_against_plain_window(spark):
    import random
    rng = random.Random(7)
    data = [{S.USER: rng.choice([1, 1, 1, 2]), S.APP: 1, S.CREATED: rng.randrange(0, 400) * S.SECONDS_PER_DAY,
             S.UPDATED: rng.randrange(3), "author_playtime_forever": rng.randrange(50), "votes_up": rng.randrange(3)}
            for _ in range(600)]
    df = rows_frame(spark, data)
    order = [S.CREATED, S.UPDATED, "author_playtime_forever", "votes_up"]
    seen, expected = {}, 0
    for row in sorted(data, key=lambda r: (r[S.USER], *[r[c] for c in order])):
        last = seen.get(row[S.USER])
        expected += last is not None and row["author_playtime_forever"] < last
        seen[row[S.USER]] = row["author_playtime_forever"]
    assert audit.playtime_decreases(df).count() == expected
    assert audit.playtime_decreases(df.repartition(16)).count() == expected


def test_uniqueness_and_schema(spark):
    df = rows_frame(spark, [{"votes_up": 1, "voted_up": None}, {"votes_up": 2, "voted_up": None}, {"votes_up": 2, "voted_up": None}])
    found = counts(audit.uniqueness_report(df), "column_name", "n_unique")
    assert found["votes_up"] == 2 and found["voted_up"] == 0
    audited = audit.schema_audit(df.drop("language").withColumn("appid", F.lit("x"))).collect()
    assert {r.column_name for r in audited if not r.type_matches} == {"language", "appid"} or \
        {r.column_name for r in audited if r.type_matches is not True} == {"language", "appid"}


def test_duplicates_and_conflicts(spark):
    same = {S.USER: 1, S.APP: 1, S.CREATED: 1, "review": "a"}
    df = rows_frame(spark, [same, same, {**same, "review": "b"}, {**same, S.APP: 2}, {**same, S.USER: None, "language": None},
                            {**same, S.USER: None, "language": None}])
    assert sorted(r.copies for r in duplicates.exact_duplicate_groups(df).collect()) == [2, 2]
    assert sorted(r.copies for r in duplicates.key_duplicate_groups(df).collect()) == [2, 3]
    assert duplicates.conflicting_rows(df).count() == 3
    totals = counts(duplicates.duplicate_totals(df), "item", "item_count")
    assert totals["exact_duplicate_surplus_rows"] == 2 and totals["key_duplicate_group_rows"] == 5


def test_clean_keeps_latest_and_is_idempotent(spark):
    base = {S.USER: 1, S.APP: 1, S.CREATED: 1}
    df = rows_frame(spark, [{**base, S.UPDATED: 5, "votes_up": 1}, {**base, S.UPDATED: 9, "votes_up": 2},
                            {**base, S.UPDATED: 9, "votes_up": 3}, {**base, S.APP: 2, "review": None},
                            {**base, S.APP: 3, "votes_funny": 4_000_000_000}, {**base, S.APP: 4, "weighted_vote_score": float("nan")}])
    once = cleaning.clean_reviews(df)
    assert [(r[S.APP], r[S.UPDATED], r["votes_up"]) for r in once.collect()] == [(1, 9, 3)]
    assert cleaning.clean_reviews(once).collect() == once.collect()
    assert [r.row_count for r in cleaning.step_counts(df).orderBy("step").collect()] == [6, 4, 3, 3, 1]


def test_prepare(spark):
    df = rows_frame(spark, [{S.CREATED: 86_400, "review": None, "votes_up": 0}])
    out = prepare.build_features(df).select(F.unix_seconds("timestamp_created_ts"), "log_votes_up", "log_review_length",
                                            "review_length", "has_votes_up").first()
    assert tuple(out) == (86_400, 0.0, None, None, False)
    kept = prepare.ensure_columns(df.drop("language").withColumn("appid", F.lit("oops")), S.REVIEW_SCHEMA)
    row = kept.select("language", "appid").first()
    assert row.language is None and row.appid is None
    assert {f.name: f.dataType for f in kept.schema.fields} == S.REVIEW_SCHEMA


def _shuffled_columns(df):
    """Per exchange of the final plan, the columns that it shuffles."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return [line for line in plan.splitlines() if "Exchange" in line or "Window [lag" in line]


def test_bucket_edges_meet_without_the_columns_that_order_a_bucket(spark):
    df = rows_frame(spark, [{S.USER: 1, S.CREATED: d * S.SECONDS_PER_DAY, "author_playtime_forever": 500 - d} for d in (0, 1, 45, 90)])
    found = audit.playtime_decreases(df)
    across = [line for line in _shuffled_columns(found) if "Window [lag" in line and "bucket" not in line]
    assert len(across) == 1 and "votes_up" not in across[0]
    assert found.count() == 3


def test_whole_rows_are_not_shuffled_to_find_exact_copies(spark):
    # By its estimated size the table of hashes is too long for a broadcast, by its real one it isn't.
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    df = rows_frame(spark, [{S.USER: i % 3000, S.CREATED: i % 3000, "review": f"text {i % 3000}"} for i in range(3010)])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "4000")
    try:
        found = duplicates.exact_duplicate_groups(df)
        assert not any("hashpartitioning(_hash" in line for line in _shuffled_columns(found))
        assert found.count() == 10 and found.agg(F.sum("copies")).first()[0] == 20
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_exact_copies_are_the_same_with_thinned_rows(spark, monkeypatch):
    monkeypatch.setattr(duplicates, "UNTHINNED_HASHES", 0)
    df = rows_frame(spark, [{S.USER: i % 90, S.CREATED: i % 90, "review": None if i % 2 else "x"} for i in range(100)])
    assert sorted((r[S.USER], r["copies"]) for r in duplicates.exact_duplicate_groups(df).collect()) == [(i, 2) for i in range(10)]
    assert duplicates.exact_duplicate_groups(df.limit(0)).count() == 0

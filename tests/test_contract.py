"""The registered queries: every operator of the inventory is there and agrees with its oracle."""

import pytest

import __spark_entry__ as entry
from emberline.plans import all_queries
from oracle_check import compare, duckdb_session

SF = "/root/testdata/sf0.001"
INVENTORY = """
src_csv_typed src_parquet_scan snk_parquet_roundtrip prep_ensure_columns prep_type_conversion prep_derived
prep_indicators prep_quality_flags audit_anomaly_summary games_competitors_enriched games_name_search
games_missing_names cooc_genre clean_dropna clean_artifacts sample_user_time split_user_train split_user_test
games_dup_explorer cooc_tag cooc_genre_pairs cooc_tag_pairs dup_conflicting_rows dup_diagnostics
cov_reviews_not_in_catalog cov_games_not_reviewed sim_topk eda_cardinality audit_nulls games_missingness
eda_playtime_stats eda_time_range eda_summary audit_describe eda_votes eda_top_users eda_top_users_games
eda_top_apps audit_users_zero_reviews audit_uniqueness audit_noise dup_exact_groups dup_summary dup_key_groups
audit_votes_funny_gap churn_features games_playtime_by_genre games_playtime_by_tag games_genre_counts
games_tag_counts games_release_years games_dup_names games_dup_totals split_cutoffs split_cutoffs_approx
cooc_genre_matrix eda_language_counts audit_playtime_decreases clean_keep_latest eda_preview games_top_tags
games_competitors_similarity games_competitors_release games_competitors_hybrid cov_catalog_union
clean_exact_dups games_all_genres games_all_tags cov_summary audit_structure audit_schema
audit_consistency_summary audit_viol_ts_order audit_viol_playtime_review audit_viol_playtime_2w
audit_validity_summary audit_viol_score_range audit_viol_uint32_max audit_size_estimate audit_all
audit_sample_vs_full games_parse sim_tokens sim_tfidf sim_competitors_json sim_catalog sim_embeddings_topk
sim_overlap_at_k games_inspect games_engagement_sentiment games_popularity_engagement sample_report
sample_n_rows split_report churn_snapshot_train churn_snapshot_val churn_snapshot_test churn_snapshots_all
feat_full clean_full clean_step_counts prof_quantiles prof_skewness prof_histogram prof_boxplot prof_categories
prof_imbalance prof_extremes prof_pearson prof_spearman prof_nullity_corr prof_duplicates prof_text_lengths
prof_interactions prof_rejects ml_logreg ml_rf ml_gbt ml_metrics ml_error_slices ml_pca ml_threshold_sweep
retention_curve ml_als ml_als_held_out src_csv_reviews ingest_reviews scalar_showcase games_load_csv prof_nan_counts
sim_topk_work split_cutoffs_error sample_given_users split_given_users src_csv_rejects snk_report_formats ml_scores
ml_pca_variance ml_als_fit
""".split()
ROWS_ONLY = {"split_cutoffs_approx", "ml_logreg", "ml_rf", "ml_gbt", "ml_pca", "ml_als"}
#: What was wrong once or is intricate, and every third of the rest.
CHOSEN = ["audit_all", "audit_consistency_summary", "audit_playtime_decreases", "audit_schema", "dup_diagnostics", "clean_full",
          "churn_snapshots_all", "sim_topk", "sim_embeddings_topk", "cooc_genre_matrix", "prof_boxplot", "prof_rejects",
          "cov_catalog_union", "cov_reviews_not_in_catalog", "cov_games_not_reviewed", "cov_summary", "ml_als_held_out",
          "src_csv_reviews", "ingest_reviews", "scalar_showcase", "games_load_csv", "games_inspect", "sample_n_rows",
          "retention_curve", "sim_topk_work", "split_cutoffs_error", "sample_given_users", "split_given_users", "src_csv_rejects",
          "snk_report_formats", "audit_sample_vs_full", "prof_spearman", "prof_categories", "prof_extremes", "ml_als_fit"]
OWN = {name: query for name, query in all_queries().items()}
CHECKED = [*CHOSEN, *[n for n in sorted(n for n, q in OWN.items() if q.sql and n not in CHOSEN)][::3]]


def test_inventory_is_complete():
    names = set(OWN)
    assert names <= set(entry.queries())
    assert set(INVENTORY) <= names, set(INVENTORY) - names
    assert names - set(entry.oracle_sql()) == ROWS_ONLY


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.columns == ["section", "item", "item_count", "item_rate"] and df.count() > 60


@pytest.fixture(scope="module")
def oracle():
    return duckdb_session(SF)


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_oracle(spark, oracle, name):
    assert compare(entry.queries()[name](spark, SF), oracle, entry.oracle_sql()[name]) is None


def test_no_query_pairs_everything_with_everything(spark):
    for name in ("audit_all", "churn_snapshots_all", "cov_summary", "prof_interactions", "sim_topk"):
        plan = entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan, name


def test_filters_and_columns_reach_the_scan(spark):
    plan = entry.queries()["audit_viol_score_range"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(LessThan(weighted_vote_score" in plan
    scan = plan[plan.index("ReadSchema"):]
    assert "review:" not in scan
    latest = entry.queries()["clean_keep_latest"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert latest.count("WindowGroupLimit") == 2


def test_showcase_works_out_a_review_before_it_is_multiplied(spark):
    plan = entry.queries()["scalar_showcase"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate explode") == 2
    assert "from_json" not in plan[:plan.rindex("Generate explode")] and "from_json" in plan

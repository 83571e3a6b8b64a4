import numpy as np
from pyspark.sql import functions as F

from emberline import schema as S
from emberline.operators import models, profiling, retention
from emberline.sources import readers, sinks
from helpers import rows_frame


def ranks(x):
    order = np.sort(x)
    return (np.searchsorted(order, x, "left") + np.searchsorted(order, x, "right") + 1) / 2


def test_spearman_with_ties_and_hot_value(spark):
    rng = np.random.default_rng(1)
    a = np.where(rng.random(400) < 0.4, 0, rng.integers(0, 300, 400))
    b = a + rng.integers(-50, 50, 400)
    df = rows_frame(spark, [{"votes_up": int(x), "comment_count": int(y)} for x, y in zip(a, b)])
    got = profiling.spearman(df, ["votes_up", "comment_count"]).first()
    assert abs(got.spearman - np.corrcoef(ranks(a), ranks(b))[0, 1]) < 1e-9
    again = profiling.spearman(df.repartition(16), ["votes_up", "comment_count"]).first()
    assert abs(again.spearman - got.spearman) < 1e-12


def test_histogram_boxplot_and_extremes(spark):
    values = [*range(100), 1000]
    df = rows_frame(spark, [{"votes_up": v} for v in values])
    bins = profiling.histogram(df, ["votes_up"], 50)
    assert bins.agg(F.sum("bin_count"), F.max("bin")).first()[:] == (101, 49)
    box = profiling.boxplot(df, ["votes_up"]).first()
    assert (box.q1, box.median, box.q3, box.whisker_low, box.whisker_high, box.n_outliers) == (25, 50, 75, 0, 99, 1)
    found = {(r.side, r.position): r.value for r in profiling.extreme_values(df, ["votes_up"], 2).collect()}
    assert found == {("lowest", 1): 0, ("lowest", 2): 1, ("highest", 1): 1000, ("highest", 2): 99}
    constant = profiling.histogram(rows_frame(spark, [{}, {}]), ["votes_up"])
    assert [(r.bin, r.bin_count) for r in constant.collect()] == [(0, 2)]


def test_imbalance_rejects_and_nulls(spark):
    df = rows_frame(spark, [{"language": "a", "review": f"r{i}", S.USER: None if i == 0 else 1,
                             "voted_up": None if i == 0 else i % 2 == 0} for i in range(8)])
    rows = {r.column_name: r for r in profiling.imbalance(df, ["language", "review"]).collect()}
    assert rows["language"].imbalance == 1 and abs(rows["review"].imbalance) < 1e-12
    why = {r.column_name: (r.constant, r.all_null, r.id_like) for r in profiling.rejected_columns(df).collect()}
    assert why["language"] == (True, False, False) and why["review"] == (False, False, True)
    nulls = {(r.column_1, r.column_2): r.nullity_correlation for r in profiling.nullity_correlation(df).collect()}
    assert list(nulls) == [(S.USER, "voted_up")] and abs(nulls[(S.USER, "voted_up")] - 1) < 1e-12


def test_text_lengths_and_interactions(spark):
    texts = spark.createDataFrame([(1, " one  two\nthree "), (2, "   "), (3, None)], "id int, text string")
    got = {r.id: (r.text_length, r.word_count) for r in profiling.text_lengths(texts, "text", "id").collect()}
    assert got == {1: (16, 3), 2: (3, 0), 3: (None, None)}
    df = rows_frame(spark, [{"votes_up": i, "comment_count": 9 - i, "votes_funny": None} for i in range(10)])
    pairs = profiling.interactions(df, ["votes_up", "comment_count", "votes_funny"]).collect()
    assert {(r.x_bucket, r.y_bucket): r.n for r in pairs} == {(i, 9 - i): 1 for i in range(10)}


def test_retention(spark):
    days = {1: [0, 1, 7], 2: [0, 30], 3: [2, 3]}
    rows = [(u, d) for u, ds in days.items() for d in ds for _ in range(2)]
    events = spark.createDataFrame(rows, "user_id long, d int").select(
        "user_id", F.expr("TIMESTAMP_NTZ'2024-01-01 10:00:00' + make_interval(0, 0, 0, d)").alias("ts"))
    got = {(str(r.cohort), r.day_number): (r.cohort_users, r.retained_users)
           for r in retention.retention_curve(events).collect()}
    assert got[("2024-01-01", 1)] == (2, 1) and got[("2024-01-01", 30)] == (2, 1)
    assert got[("2024-01-03", 1)] == (1, 1) and got[("2024-01-03", 7)] == (1, 0)


def test_metrics_against_definitions(spark):
    rng = np.random.default_rng(2)
    label = rng.integers(0, 2, 300)
    score = np.round(np.clip(0.3 * label + rng.random(300) * 0.7, 0, 1), 2)
    df = spark.createDataFrame([(int(x), float(s)) for x, s in zip(label, score)], "label int, score double")
    got = models.classification_metrics(df).first()
    pos, neg = score[label == 1], score[label == 0]
    auc = ((pos[:, None] > neg[None, :]) + 0.5 * (pos[:, None] == neg[None, :])).mean()
    assert abs(got.roc_auc - auc) < 1e-9
    assert abs(got.accuracy - ((score >= 0.5) == (label == 1)).mean()) < 1e-9
    sweep = {round(r.threshold, 2): r for r in models.threshold_sweep(df).collect()}
    assert sweep[0.0].predicted_positive == 300 and abs(sweep[0.0].recall - 1) < 1e-12 and len(sweep) == 101
    assert sweep[0.5].recall <= sweep[0.4].recall
    wrong = models.error_slices(df, F.col("label")).agg(F.sum("misclassified")).first()[0]
    assert wrong == ((score >= 0.5) != (label == 1)).sum()


def test_sources_and_sinks(spark, tmp_path):
    path = str(tmp_path / "one.csv")
    with open(path, "w") as f:
        f.write('appid,review,author_steamid,extra\n7,"said ""hi"", left",12,x\noops,"two\nlines",13,y\n')
    wanted = {c: S.REVIEW_SCHEMA[c] for c in ("appid", "review", S.USER)}
    rows = readers.read_csv_typed(spark, path, wanted, multi_line=True).collect()
    assert [tuple(r) for r in rows] == [(7, 'said "hi", left', 12), (None, "two\nlines", 13)]
    # Without multi_line the text with a line break falls into two rows, both without a usable app.
    broken = readers.broken_key_rows(readers.read_csv_typed(spark, path, wanted), ["appid"])
    assert tuple(broken.first()) == (3, 2)
    df = rows_frame(spark, [{"votes_up": 3}, {"review": None}])
    for fmt in ("csv", "json", "parquet"):
        where = sinks.write_report(df, str(tmp_path), f"report_{fmt}", fmt)
        back = getattr(spark.read.option("header", True), fmt)(where)
        assert back.count() == 2 and set(back.columns) == set(df.columns)
    sinks.write_parquet(df, str(tmp_path / "parts"), ["language"])
    assert readers.read_parquet(spark, str(tmp_path / "parts"), ["votes_up"]).agg(F.sum("votes_up")).first()[0] == 4


def test_models_fit(spark):
    rows = [(u, int(u % 3 == 0), *[float((u * (i + 3)) % 11 + 5 * (u % 3 == 0)) for i in range(len(models.FEATURES))])
            for u in range(120)]
    snapshots = spark.createDataFrame(rows, f"{S.USER} long, churn int, " + ", ".join(f"{f} double" for f in models.FEATURES))
    for kind in ("logreg", "rf", "gbt"):
        scored = models.fit_and_score(snapshots, snapshots, kind)
        assert scored.count() == 120
        assert models.classification_metrics(scored).first().roc_auc > 0.6
    assert models.principal_components(snapshots).select("pc1", "pc2").dropna().count() == 120


def test_csv_reports_come_in_files_of_bounded_size(spark, tmp_path, monkeypatch):
    """A file with line breaks inside texts can't be split, so that a task reads as much as the largest file holds."""
    monkeypatch.setattr(sinks, "CSV_FILE_ROWS", 100)
    texts = spark.range(0, 1_000, 1, 2).select("id", F.concat(F.lit('a "b"\n'), "id").alias("text"))
    path = sinks.write_report(texts, str(tmp_path), "texts", "csv")
    read = spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(path)
    assert read.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0] == 100
    assert sorted((int(r.id), r.text) for r in read.collect()) == sorted((r.id, r.text) for r in texts.collect())

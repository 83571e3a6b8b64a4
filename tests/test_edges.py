"""Inputs that the given tables don't hold: NaN, -0.0, 64-bit ids, undeclared genres, young cohorts, no shared folder."""

import math
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from emberline.functions import layout, storage
from emberline.operators import audit, catalog, cleaning, cooccurrence, models, profiling, quantiles, retention, sampling, similarity
from emberline.plans import all_queries
from emberline.sources import testdata

NAN = float("nan")


@pytest.fixture(scope="module")
def numbers(spark):
    rows = [(1.0, 0.0), (2.0, -0.0), (3.0, NAN), (NAN, 5.0), (None, None), (2.0, 0.0)]
    return spark.createDataFrame(rows, "a double, b double").cache()


def by_column(df, key="column_name"):
    return {r[key]: r for r in df.collect()}


def test_nan_is_counted_and_is_no_value(numbers):
    assert {r.column_name: r.nan_count for r in quantiles.nan_counts(numbers, ["a", "b"]).collect()} == {"a": 1, "b": 1}
    median = {r.column_name: r.quantile for r in profiling.quantile_table(numbers, ["a", "b"]).collect() if r.q == 0.5}
    assert median == {"a": 2.0, "b": 0.0}
    measures = {(r.column_name, r.measure): r.measure_value for r in quantiles.describe(numbers, ["a"], [0.5]).collect()}
    assert measures["a", "count"] == 4 and measures["a", "mean"] == 2.0 and measures["a", "max"] == 3.0
    assert all(not math.isnan(v) for v in measures.values())
    assert by_column(profiling.skewness(numbers, ["a"]))["a"].skewness == 0.0
    bins = [(r.bin, r.bin_start, r.bin_count) for r in profiling.histogram(numbers, ["a"], 2).collect()]
    assert sorted(bins) == [(0, 1.0, 1), (1, 2.0, 3)]
    box = by_column(profiling.boxplot(numbers, ["a"]))["a"]
    assert (box.median, box.whisker_low, box.whisker_high, box.n_outliers) == (2.0, 1.0, 3.0, 0)
    top = [r.value for r in profiling.extreme_values(numbers, ["a"], 1).collect()]
    assert sorted(top) == [1.0, 3.0]
    cells = [(r.x_bucket, r.y_bucket, r.n) for r in profiling.interactions(
        numbers.withColumn("b", F.lit(1.0)), ["a", "b"], 2).collect()]
    assert sorted(cells) == [(0, 0, 1), (1, 0, 3)]
    pairs = catalog.paired_buckets(numbers.withColumn("b", F.lit(1.0)), "a", "b", 2).collect()
    assert sum(r.n for r in pairs) == 4


def test_negative_zero_is_zero(numbers):
    assert {r.column_name: r.n_unique for r in audit.distinct_counts(numbers, ["a", "b"]).collect()} == {"a": 3, "b": 2}


def test_rejects_shuffle_no_texts(spark):
    df = spark.createDataFrame([(i, "x" * 50 + str(i), "same") for i in range(20)], "id int, text string, kind string")
    found = by_column(profiling.rejected_columns(df))
    assert found["text"].id_like and found["kind"].constant and found["id"].n_unique == 20
    plan = profiling.rejected_columns(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "md5" in plan


def test_als_takes_64_bit_ids_and_keeps_every_held_out_pair(spark):
    base = 76561190000000000
    rows = [(base + u, a, 10 * (u + a) % 97) for u in range(60) for a in range(1, 9)] + [(base + 10**9, 99, 5)]
    reviews = spark.createDataFrame(rows, "author_steamid long, appid int, author_playtime_forever int")
    found = models.playtime_factors(reviews).collect()
    assert {r.author_steamid for r in found} <= {u for u, _, _ in rows} and len(found) > 50
    held = reviews.filter(models.hash_bucket(F.concat_ws("|", "author_steamid", "appid")) < 2000).count()
    assert len(found) == held
    assert all(r.prediction is None or not math.isnan(r.prediction) for r in found)


def test_als_beats_the_mean_where_users_share_many_apps(spark):
    """No structure and many ratings each: whatever is drawn towards zero by the penalty does worse than the mean."""
    reviews = spark.range(400 * 400).select(
        (F.col("id") % 400).alias("author_steamid"), F.floor(F.col("id") / 400).cast("int").alias("appid"),
        (F.pmod(F.xxhash64("id"), F.lit(50)) * 60 + 60).cast("int").alias("author_playtime_forever"))
    found = models.playtime_factors(reviews, held_out=False)
    error, variance = found.agg(F.avg(F.pow(F.col("rating") - F.col("prediction"), 2)), F.var_pop("rating")).first()
    assert error < variance


def test_als_deals_rows_once_for_their_numbers_and_their_pairs(spark, monkeypatch):
    """Rows meet their user's number and are grouped after one exchange, however few the users are."""
    plans, materialize = {}, models.materialize

    def noted(df, kind):
        plans[kind] = df._jdf.queryExecution().executedPlan().toString()
        return materialize(df, kind)

    monkeypatch.setattr(models, "materialize", noted)
    reviews = spark.createDataFrame([(2 ** 40 * u, a, 10 * (u + a) % 97) for u in range(60) for a in range(1, 9)],
                                    "author_steamid long, appid int, author_playtime_forever int")
    found = models.playtime_factors(reviews, held_out=False).collect()
    assert len(found) > 300 and all(r.prediction is not None for r in found)
    # One for the rows and one for the users.
    assert "SortMergeJoin" in plans["ratings"] and plans["ratings"].count("Exchange hashpartitioning") == 2
    assert "Exchange" not in plans["rated"]


def test_als_does_not_deal_or_write_columns_that_it_does_not_read(spark, monkeypatch):
    monkeypatch.setattr(testdata, "_ingested", {})
    seen, fit = {}, models.playtime_factors
    monkeypatch.setattr(models, "playtime_factors", lambda reviews: seen.update(reviews=reviews) or fit(reviews))
    all_queries()["ml_als_held_out"].run(spark, "/root/testdata/sf0.001")
    assert not testdata._ingested
    plan = seen["reviews"].select("author_steamid", "appid", "author_playtime_forever")._jdf.queryExecution().optimizedPlan().toString()
    assert "l_suppkey" not in plan[plan.index("Repartition"):plan.index("Relation")] and "o_orderpriority" not in plan.split("Relation")[0]


def test_dense_ids_are_dense_and_ordered(spark):
    ids = spark.range(0, 5000, 7).select((F.col("id") * 10**12).alias("u")).union(spark.range(3).select(F.lit(None).cast("long")))
    found = sorted((r.u, r.i) for r in models.dense_ids(ids.repartition(5), "u", "i").collect())
    assert [i for _, i in found] == list(range(715)) and [u for u, _ in found] == sorted(u for u, _ in found)


def test_matrix_has_every_genre_of_the_data(spark):
    parsed = spark.createDataFrame([(1, ["A", "New"]), (2, ["A"])], "appid int, genres_array array<string>")
    rows = {r.genre_1: r.asDict() for r in cooccurrence.genre_matrix(parsed).collect()}
    assert rows["A"] == {"genre_1": "A", "A": 2, "New": 1} and rows["New"] == {"genre_1": "New", "A": 1, "New": 1}


def test_young_cohorts_are_censored(spark):
    events = spark.createDataFrame([(1, "2024-01-01"), (1, "2024-01-02"), (2, "2024-01-08"), (3, "2024-01-02")],
                                   "user_id long, ts string").withColumn("ts", F.to_timestamp_ntz("ts"))
    found = {(str(r.cohort), r.day_number): r.retained_users for r in retention.retention_curve(events).collect()}
    assert found["2024-01-01", 1] == 1 and found["2024-01-01", 7] == 0 and found["2024-01-02", 1] == 0
    assert found["2024-01-02", 7] is None and found["2024-01-08", 1] is None and found["2024-01-01", 30] is None


def test_sample_rows_sorts_only_what_it_needs(spark):
    rows = spark.range(5000).select((F.col("id") % 50).alias("author_steamid"), F.col("id").cast("int").alias("appid"),
                                    F.lit(1).cast("long").alias("timestamp_created"), F.lit("text").alias("review"))
    keys = ["author_steamid", "appid", "timestamp_created"]
    text = F.md5(F.concat_ws("|", *keys))
    want = {r.appid for r in rows.orderBy(text, *keys).limit(700).collect()}
    assert {r.appid for r in sampling.sample_rows(rows, 700).collect()} == want
    assert sampling.sample_rows(rows, 10_000).count() == 5000


def test_dense_pairs_are_multiplied_once(spark, monkeypatch):
    monkeypatch.setattr(similarity, "HELD_BYTES", 20 * 1_000)
    n = 97
    df = spark.range(n).select(F.col("id").alias("vec_id"), F.array(*[
        (F.pmod(F.xxhash64("id", F.lit(i)), F.lit(1000)) - 500).cast("float") for i in range(6)]).alias("embedding"))
    rows = {r.vec_id: [x for x in r.embedding] for r in df.collect()}

    def cosine(a, b):
        return sum(x * y for x, y in zip(a, b)) / math.sqrt(sum(x * x for x in a) * sum(y * y for y in b))

    found = similarity.similar_vectors(df, 5).collect()
    for v in range(0, n, 13):
        best = sorted(((-round(cosine(rows[v], rows[o]), 4), o) for o in rows if o != v and cosine(rows[v], rows[o]) > 0))[:5]
        got = sorted((r.rank, r.similarity) for r in found if r.vec_id == v)
        assert [s for _, s in got] == pytest.approx([-s for s, _ in best], abs=1e-4)
    blocks = similarity._top_vector_shapes(df.select(F.col("vec_id").alias("shape"), F.col("embedding").cast("array<double>").alias("vector")), 5)
    plan = blocks._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and plan.count("REPARTITION_BY_NUM") == 1 and "Cartesian" not in plan and "NestedLoop" not in plan


def test_a_cluster_without_a_shared_folder_is_an_error(spark, monkeypatch):
    class Conf:
        def get(self, *_):
            return ""

    class Context:
        applicationId = "app"

        def __init__(self, master):
            self.master = master

        def getCheckpointDir(self):
            return None

    class Session:
        conf = Conf()

        def __init__(self, master):
            self.sparkContext = Context(master)

    for master in ("yarn", "spark://host:7077", "local-cluster[3,2,1000]", "k8s://x"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            storage.shared_folder(Session(master))
    assert storage.shared_folder(Session("local[2]")) == storage.shared_folder(Session("local[2]"))


def test_ranks_do_not_depend_on_the_number_of_buckets(spark, monkeypatch):
    df = spark.range(3000).select((F.pmod(F.xxhash64("id"), F.lit(700))).cast("double").alias("a"), F.lit(7.0).alias("b"))
    counts = quantiles.value_counts(df, ["a", "b"])
    one = sorted(map(tuple, quantiles.ranked_values(counts).collect()))
    monkeypatch.setattr(quantiles, "SPLIT_VALUES", 20)
    many = sorted(map(tuple, quantiles.ranked_values(counts).collect()))
    assert one == many and [r[3] for r in many if r[0] == "a"][0] == 0 and max(r[4] for r in many) == 3000


def test_scratch_goes_with_the_application(tmp_path):
    code = f"""
from pyspark.sql import SparkSession
from emberline.functions.storage import materialize
spark = (SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false")
         .config("spark.checkpoint.dir", "file://{tmp_path}/shared").getOrCreate())
import os
print("ROWS", materialize(spark.range(5)).count(), len([f for _, _, names in os.walk("{tmp_path}/shared") for f in names]) > 0)
spark.stop()
"""
    run = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300)
    assert "ROWS 5 True" in run.stdout, run.stderr[-800:]
    assert [f for _, _, names in os.walk(tmp_path / "shared") for f in names] == []


def test_parts_of_cleaning_do_not_grow_with_the_table(spark, monkeypatch):
    df = spark.range(4_000).select(
        (F.col("id") % 700).alias("author_steamid"), (F.col("id") % 3).cast("int").alias("appid"),
        (F.col("id") % 7).alias("timestamp_created"), (F.col("id") % 2_100).alias("timestamp_updated"))
    operators = [cleaning.keep_latest, cleaning.drop_exact_duplicates]
    whole = [sorted(map(tuple, operator(df).collect())) for operator in operators]
    monkeypatch.setattr(layout, "PART_ROWS", 100)
    for operator, rows in zip(operators, whole):
        found = operator(df)
        sizes = found.groupBy(F.spark_partition_id()).count().agg(F.count("*"), F.max("count")).first()
        assert sizes[0] > 30 and sizes[1] < 200
        assert sorted(map(tuple, found.collect())) == rows

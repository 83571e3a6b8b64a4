"""Mergeable summaries, pruned cuts, thinned joins, rejected input, and bounded similarity, each against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emberline import schema as S
from emberline.functions.bitmaps import may_contain
from emberline.operators import churn, explore, frequent, quantiles, sampling, similarity, timeline
from emberline.sources import readers
from emberline.sources.testdata import reviews_by_month
from helpers import rows_frame

SF = "/root/testdata/sf0.001"


def values_frame(spark, n, seed):
    """Few values that fill most rows, very many that occur once or twice, NULL and NaN."""
    r = random.Random(seed)
    rows = [(r.choice([1, 1, 1, 2, 2, 3, r.randint(10, 4000)]), r.choice([0.5, -0.0, 0.0, float("nan"), None, r.randint(1, 5000) / 2])) for _ in range(n)]
    return spark.createDataFrame(rows, "a long, b double").repartition(6)


@pytest.mark.parametrize("counters", [4, 8, 64, 100_000])
def test_frequent_values_are_exact_however_few_counters(spark, counters):
    df = values_frame(spark, 6000, 1)
    rows = df.collect()
    want = []
    for name, values in (("a", [str(r.a) for r in rows]), ("b", [str(r.b + 0.0) for r in rows if r.b is not None and r.b == r.b])):
        best = sorted(Counter(values).items(), key=lambda v: (-v[1], v[0]))[:5]
        want += [(name, v, n, i + 1) for i, (v, n) in enumerate(best)]
    got = frequent.frequent_values(df, ["a", "b"], 5, counters)
    assert sorted(map(tuple, got.select("column_name", "value", "value_count", "position").collect())) == sorted(want)


def test_extreme_values(spark):
    df = values_frame(spark, 3000, 2)
    counts = Counter(r.a for r in df.collect())
    got = {(r.side, r.position): (r.value, r.value_count) for r in frequent.extreme_values(df, ["a"], 3).collect()}
    for i in range(3):
        assert got["lowest", i + 1] == (sorted(counts)[i], counts[sorted(counts)[i]])
        assert got["highest", i + 1] == (sorted(counts)[-1 - i], counts[sorted(counts)[-1 - i]])
    assert frequent.extreme_values(df.limit(0), ["a"], 3).count() == 0
    assert frequent.frequent_values(df.limit(0), ["a"], 3).count() == 0


def test_top_users_count_null_and_order_ties_by_number(spark):
    df = rows_frame(spark, [{"author_steamid": u} for u in (None, None, None, 10, 10, 9, 9, 100)])
    assert [tuple(r) for r in explore.top_users(df, 3).collect()] == [(None, 3), (9, 2), (10, 2)]


def test_no_window_over_a_whole_column(spark):
    plan = frequent.extreme_values(values_frame(spark, 10, 3), ["a"], 3)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "_part" in plan


def test_sketches_of_parts_merge_to_cutoffs_within_a_thousandth(spark):
    df = spark.range(40_000).select((F.pow(F.col("id") % 9973, 2).cast("long")).alias("t"), (F.col("id") % 7).alias("p"))
    fractions = {"low": 0.1, "high": 0.9}
    stored = quantiles.time_sketches(df, "t", F.col("p"))
    assert stored.count() == 7
    some = stored.where("part < 4")
    for sketches, rows in ((stored, df), (some, df.where("p < 4"))):
        cutoffs = quantiles.sketched_cutoffs(sketches, fractions).first().asDict()
        assert all(r.rank_error <= 0.001 for r in quantiles.rank_errors(rows, "t", cutoffs, fractions).collect())
    wrong = quantiles.rank_errors(df, "t", {"low": 10 ** 9}, {"low": 0.1}).first()
    assert wrong.rank_error > 0.5


def test_cuts_prune_months(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", 10_000)
    df = reviews_by_month(spark, SF)
    sample = sampling.sample_users_until(df, 0.5, 0.3)
    def partition_filters(rows):
        plan = rows._jdf.queryExecution().executedPlan().toString()
        return re.findall(r"PartitionFilters: \[(.*?), PushedFilters", plan)

    assert any("event_month" in f and "Subq" in f for f in partition_filters(sample))
    early = partition_filters(churn.churn_snapshots(df, {"early": 800_000_000}))
    assert early and all("event_month" in f for f in early)
    plain = df.drop(timeline.MONTH)
    assert sorted(map(repr, sample.drop(timeline.MONTH).collect())) == sorted(map(repr, sampling.sample_users_until(plain, 0.5, 0.3).collect()))


def test_months_are_utc_and_null_times_are_kept(spark, tmp_path):
    rows = rows_frame(spark, [{"timestamp_created": t} for t in (0, -1, None, 951_782_399, 951_782_400)])
    timeline.write_by_month(rows, str(tmp_path / "log"))
    stored = {r.timestamp_created: r.event_month for r in spark.read.parquet(str(tmp_path / "log")).collect()}
    assert stored == {0: 1970 * 12, -1: 1969 * 12 + 11, None: None, 951_782_399: 2000 * 12 + 1, 951_782_400: 2000 * 12 + 1}


def test_rows_of_given_users(spark):
    df = rows_frame(spark, [{"author_steamid": u, "appid": i} for i, u in enumerate([1] * 300 + [2, 3, None, 4, 5] * 20)])
    users = spark.createDataFrame([(1,), (1,), (4,), (None,), (99,)], "author_steamid long")
    got = sampling.rows_of_users(df, users)
    assert got.columns == df.columns and Counter(r.author_steamid for r in got.collect()) == {1: 300, 4: 20}
    assert sampling.rows_of_users(df, users.limit(0)).count() == 0


def test_bitmap_filter_loses_nothing(spark, monkeypatch):
    keys = spark.range(0, 30_000, 3).withColumnRenamed("id", "k")
    test = may_contain(keys, "k")
    passed = spark.range(30_000).withColumnRenamed("id", "k").where(test)
    assert passed.where("k % 3 = 0").count() == 10_000 and passed.count() < 12_000
    monkeypatch.setattr("emberline.functions.bitmaps.MAX_BITS", 1000)
    assert may_contain(keys, "k") is None
    users = keys.select(F.col("k").alias("author_steamid"))
    df = rows_frame(spark, [{"author_steamid": u} for u in range(10)])
    assert sampling.rows_of_users(df, users).count() == 4


def test_rejected_cells_and_records(spark, tmp_path):
    (tmp_path / "x.csv").write_text('id,n,note\n1,2,a\nx,3,"b, ""c"""\n4,five,\n5,6\n7,8,d,e\n,9,f\n')
    schema = {"id": T.LongType(), "n": T.IntegerType(), "note": T.StringType()}
    got = sorted((r.key, r.column_name, r.raw_text) for r in readers.read_csv_rejects(spark, str(tmp_path), schema, ["id"]).collect()
                 if r.column_name)
    assert got == [("4", "n", "five"), ("x", "id", "x")]
    whole = {r.raw_text for r in readers.read_csv_rejects(spark, str(tmp_path), schema, ["id"]).where("column_name IS NULL").collect()}
    assert whole == {"5,6", "7,8,d,e"}
    assert {r.file for r in readers.read_csv_rejects(spark, str(tmp_path), schema, ["id"]).collect()} == {"x.csv"}


# ---- similarity

def brute_lists(tokens, k):
    """Neighbours with similarity above 0, by rounded similarity and id."""
    n, df = len(tokens), Counter(t for own in tokens.values() for t in set(own))
    vectors = {}
    for i, own in tokens.items():
        raw = {t: c * (np.log((1 + n) / (1 + df[t])) + 1) for t, c in Counter(own).items()}
        norm = np.sqrt(sum(w * w for w in raw.values()))
        vectors[i] = {t: w / norm for t, w in raw.items()}
    out = {}
    for i, a in vectors.items():
        scores = [(round(sum(w * b.get(t, 0) for t, w in a.items()), 4), j) for j, b in vectors.items() if j != i and set(a) & set(b)]
        out[i] = sorted((-s, j) for s, j in scores)[:k]
    return out


@pytest.mark.parametrize("seed, n, vocabulary, most, k", [(1, 150, 12, 5, 7), (2, 200, 60, 9, 5), (3, 120, 4, 2, 10), (4, 180, 300, 3, 4)])
def test_token_lists_equal_brute_force(spark, seed, n, vocabulary, most, k, monkeypatch):
    monkeypatch.setattr(similarity, "BLOCK_ROWS", 37)  # several blocks and groups
    r = random.Random(seed)
    tokens = {i: [f"t{min(int(r.expovariate(5 / vocabulary)), vocabulary)}" for _ in range(r.randint(1, most))] for i in range(n)}
    parsed = spark.createDataFrame([(i, f"g{i}", None, own, {}) for i, own in tokens.items()],
                                   "appid int, name string, release_dt date, genres_array array<string>, tags_map map<string,int>")
    got = {row.appid: [(-c.similarity, c.appid) for c in row.competitors] for row in similarity.similar_games(parsed, k).collect()}
    want = brute_lists(tokens, k)
    for i in tokens:
        own = got.get(i, [])  # games without a neighbour aren't listed
        assert [j for _, j in own] == [j for _, j in want[i]] and np.allclose([s for s, _ in own], [s for s, _ in want[i]], atol=1e-9), i


def test_dense_lists_and_copies_of_vectors(spark, monkeypatch):
    r = np.random.default_rng(5)
    vectors = {i: r.integers(-3, 4, 6).astype(float).tolist() for i in range(300)}
    vectors[7] = [0.0] * 6
    df = spark.createDataFrame(list(vectors.items()), "vec_id long, embedding array<double>")
    monkeypatch.setattr(similarity, "SCORES", 500)
    got = {(x.vec_id, x.rank): (x.neighbour_id, x.similarity) for x in similarity.similar_vectors(df, 5).collect()}
    unit = {i: np.array(v) / np.linalg.norm(v) for i, v in vectors.items() if any(v)}
    for i, a in unit.items():
        best = sorted((-round(float(a @ b), 4), j) for j, b in unit.items() if j != i and a @ b > 1e-12)[:5]
        for rank, (s, j) in enumerate(best):
            assert got[i, rank + 1] == (j, pytest.approx(-s)), i
    for n, blocks in ((1000, 3), (1000, 10)):
        units = spark.range(n).select(F.col("id").alias("shape"), F.array(F.lit(1.0)).alias("vector"))
        placed = similarity.place_pairs(units, blocks)
        assert placed.count() == n * blocks and placed.select("pair").distinct().count() == blocks * (blocks + 1) // 2
        assert {x.pair for x in placed.select("pair").distinct().collect()} == set(range(blocks * (blocks + 1) // 2))
    assert similarity.super_blocks(10 ** 9, 64, 50, 8, 128 << 20) < 10 ** 9 / 10_000


def test_spearman_with_more_values_than_are_broadcast(spark, monkeypatch):
    from emberline.operators import profiling
    r = np.random.default_rng(6)
    a, b, c = r.integers(0, 900, 2000), r.normal(size=2000), np.where(r.random(2000) < 0.6, 0, r.integers(0, 700, 2000))
    rows = [(int(x), float(y) if i % 9 else None, int(z)) for i, (x, y, z) in enumerate(zip(a, b, c))]
    df = spark.createDataFrame(rows, "a long, b double, c long")
    whole = {(x.column_1, x.column_2): x.spearman for x in profiling.spearman(df, ["a", "b", "c"]).collect()}
    monkeypatch.setattr(profiling, "RANKS", 800)
    monkeypatch.setattr(profiling, "FREQUENT", 10)
    split = {(x.column_1, x.column_2): x.spearman for x in profiling.spearman(df, ["a", "b", "c"]).collect()}
    assert whole.keys() == split.keys() and all(abs(whole[p] - split[p]) < 1e-12 for p in whole)

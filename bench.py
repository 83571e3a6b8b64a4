"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

from emberline.plans import all_queries

HEADLINE = [
    "ingest_reviews", "audit_all", "audit_consistency_summary", "audit_playtime_decreases", "audit_uniqueness", "audit_describe",
    "dup_summary", "dup_diagnostics", "clean_full", "feat_full", "sample_user_time", "split_cutoffs",
    "churn_snapshots_all", "cov_summary", "eda_summary", "eda_top_users_games", "games_tag_counts",
    "cooc_genre_pairs", "cooc_tag_pairs", "sim_topk", "sim_embeddings_topk", "prof_spearman", "prof_histogram",
    "retention_curve",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    wanted = sys.argv[1:] or HEADLINE
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("emberline-bench")
             .config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "12g")
             .config("spark.checkpoint.dir", f"file://{tempfile.mkdtemp(prefix='bench-')}")
             .config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    queries, times = all_queries(), {}
    queries["eda_votes"].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
    for name in wanted:
        start = time.perf_counter()
        queries[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()

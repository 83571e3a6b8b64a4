"""Compare registered queries with their oracle SQL in DuckDB.

Usage: python tests/oracle_check.py [SF_DIR] [query name or prefix ...]
"""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duckdb_session(sf_dir: str):
    import duckdb
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return float(f"{value:.9g}") + 0.0
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, (datetime, date)):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def _kind(value):
    return type(value).__name__


def compare(spark_df, connection, sql: str) -> str | None:
    """None when equal, else what differs."""
    columns = sorted(spark_df.columns)
    ours = [tuple(_plain(r[c]) for c in columns) for r in spark_df.select(*[f"`{c}`" for c in columns]).collect()]
    connection.execute(f"CREATE OR REPLACE TEMP VIEW checked AS {sql}")  # what can't be a view can't be compared by all
    cursor = connection.execute("SELECT * FROM checked")
    names = [d[0] for d in cursor.description]
    if sorted(names) != columns:
        return f"columns {columns} != {sorted(names)}"
    order = [names.index(c) for c in columns]
    theirs = [tuple(_plain(row[i]) for i in order) for row in cursor.fetchall()]
    if len(ours) != len(theirs):
        return f"rows {len(ours)} != {len(theirs)}"
    left, right = Counter(ours), Counter(theirs)
    if left != right:
        return f"{sum((left - right).values())} rows differ; ours {list((left - right))[:3]} theirs {list((right - left))[:3]}"
    for i, c in enumerate(columns):
        kinds = ({_kind(r[i]) for r in ours if r[i] is not None}, {_kind(r[i]) for r in theirs if r[i] is not None})
        if kinds[0] != kinds[1]:
            return f"kinds of {c} differ: {kinds}"
    return None


def main() -> int:
    from pyspark.sql import SparkSession
    sys.path.insert(0, os.path.join(os.path.dirname(__file__), ".."))
    import __spark_entry__ as entry
    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and "/" in args[0] else "/root/testdata/sf0.01"
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.driver.memory", "8g").config("spark.ui.enabled", "false")
             .config("spark.sql.session.timeZone", os.environ.get("CHECK_ZONE", "UTC")).getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    oracle, connection, bad = entry.oracle_sql(), duckdb_session(sf_dir), 0
    for name, run in entry.queries().items():
        if args and not any(name.startswith(a) for a in args):
            continue
        start = time.time()
        try:
            df = run(spark, sf_dir)
            if name in oracle:
                problem = compare(df, connection, oracle[name])
                state = "ok" if problem is None else f"MISMATCH {problem}"
            else:
                state = f"rows-only {df.count()}"
        except Exception as error:  # report and go on with the next query
            state = f"ERROR {type(error).__name__}: {str(error)[:600]}"
        if not state.startswith(("ok", "rows-only")):
            bad += 1
        print(f"{name:32s} {time.time() - start:6.2f}s {state}", flush=True)
    print("bad:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())

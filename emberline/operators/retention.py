"""Cohort retention from an event log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberline.functions.columns import utc_day

DAYS = [1, 7, 14, 21, 30]


def retention_curve(events: DataFrame, user: str = "user_id", ts: str = "ts", days: list[int] = DAYS) -> DataFrame:
    """Users of each first-seen day who are active again exactly d days (UTC) later; NULL where the log ends before.

    Events are reduced to distinct (user, day) before anything else; a user's first day is then a
    second, smaller aggregate, and the array of a user's days is bounded by the calendar.
    """
    active = events.where(F.col(user).isNotNull()).select(user, utc_day(events, ts).alias("day")).distinct()
    per_user = active.groupBy(user).agg(F.min("day").alias("cohort"), F.collect_set("day").alias("seen"))
    last = active.agg(F.max("day")).scalar()
    flags = per_user.select("cohort", F.inline(F.array(*[
        F.struct(F.lit(d).alias("day_number"), F.array_contains("seen", F.date_add("cohort", d)).alias("back"))
        for d in days])))
    return flags.groupBy("cohort", "day_number").agg(
        F.count("*").alias("cohort_users"), F.count_if("back").alias("back")).select(
        "cohort", "day_number", "cohort_users",
        F.when(F.date_add("cohort", F.col("day_number")) <= last, F.col("back")).alias("retained_users"))

"""Which reviewed apps the catalogue holds, and which catalogue apps have reviews."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberline import schema as S


def app_ids(df: DataFrame) -> DataFrame:
    return df.select(S.APP).where(F.col(S.APP).isNotNull()).distinct()


def catalog_union(*snapshots: DataFrame) -> DataFrame:
    """Distinct apps over all catalogue snapshots."""
    ids = snapshots[0].select(S.APP)
    for other in snapshots[1:]:
        ids = ids.unionByName(other.select(S.APP))
    return app_ids(ids)


def reviews_not_in_catalog(reviews: DataFrame, catalog: DataFrame) -> DataFrame:
    return app_ids(reviews).join(app_ids(catalog), S.APP, "left_anti")


def games_not_reviewed(reviews: DataFrame, catalog: DataFrame) -> DataFrame:
    return app_ids(catalog).join(app_ids(reviews), S.APP, "left_anti")


def coverage_summary(reviews: DataFrame, first: DataFrame, second: DataFrame) -> DataFrame:
    """Sizes of the sets and of their differences, from one row of membership flags per app."""
    tagged = (reviews.select(S.APP, F.lit(1).alias("r"), F.lit(0).alias("a"), F.lit(0).alias("b"))
              .unionByName(first.select(S.APP, F.lit(0).alias("r"), F.lit(1).alias("a"), F.lit(0).alias("b")))
              .unionByName(second.select(S.APP, F.lit(0).alias("r"), F.lit(0).alias("a"), F.lit(1).alias("b"))))
    member = tagged.where(F.col(S.APP).isNotNull()).groupBy(S.APP).agg(
        (F.max("r") == 1).alias("reviewed"), (F.max("a") == 1).alias("in_first"), (F.max("b") == 1).alias("in_second"))
    listed = F.col("in_first") | F.col("in_second")
    return member.agg(
        F.count_if("in_first").alias("first_snapshot"), F.count_if("in_second").alias("second_snapshot"),
        F.count_if(listed).alias("catalog_apps"), F.count_if("reviewed").alias("reviewed_apps"),
        F.count_if(F.col("reviewed") & ~listed).alias("reviewed_not_in_catalog"),
        F.count_if(listed & ~F.col("reviewed")).alias("catalog_not_reviewed"),
        F.count_if(listed & F.col("reviewed")).alias("in_both"))

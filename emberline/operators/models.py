"""Churn models on snapshot features with Spark ML, and their evaluation as plain aggregates."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.recommendation import ALS
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emberline import schema as S
from emberline.functions.columns import hash_bucket, safe_rate
from emberline.functions.storage import materialize
from emberline.operators.quantiles import VALUE, ranked_values, value_counts

FEATURES = ["n_reviews_before_T", "n_games_reviewed_before_T", "avg_playtime_at_review_before_T",
            "positive_review_rate_before_T", "days_since_last_review", "account_observed_days"]


def feature_rows(snapshots: DataFrame, features: list[str] = FEATURES) -> DataFrame:
    return snapshots.select(S.USER, F.col("churn").cast("double").alias("label"),
                            *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in features])


def with_class_weights(rows: DataFrame) -> DataFrame:
    """Weight each class by the inverse of its share, so that both classes count the same."""
    share = rows.agg(F.avg("label").alias("p")).scalar()
    weight = F.when(F.col("label") == 1, F.try_divide(F.lit(0.5), share)).otherwise(F.try_divide(F.lit(0.5), 1 - share))
    return rows.withColumn("weight", F.coalesce(weight, F.lit(1.0)))


def _assembled(features: list[str]) -> list:
    return [VectorAssembler(inputCols=features, outputCol="raw_features"),
            StandardScaler(inputCol="raw_features", outputCol="features", withMean=True)]


def classifier(kind: str):
    if kind == "logreg":
        return LogisticRegression(maxIter=50, regParam=0.01, weightCol="weight")
    if kind == "rf":
        return RandomForestClassifier(numTrees=20, maxDepth=6, seed=42, weightCol="weight")
    if kind == "gbt":
        return GBTClassifier(maxIter=10, maxDepth=4, seed=42, weightCol="weight")
    raise ValueError(f"unknown model: {kind}")


def fit_and_score(train: DataFrame, test: DataFrame, kind: str, features: list[str] = FEATURES) -> DataFrame:
    """(user, label, score, predicted) of the test snapshot from a model fitted on the train snapshot."""
    model = Pipeline(stages=[*_assembled(features), classifier(kind)]).fit(
        with_class_weights(feature_rows(train, features)))
    return model.transform(feature_rows(test, features)).select(
        S.USER, "label", vector_to_array("probability")[1].alias("score"), F.col("prediction").alias("predicted"))


def principal_components(snapshots: DataFrame, k: int = 2, features: list[str] = FEATURES) -> DataFrame:
    rows = feature_rows(snapshots, features)
    model = Pipeline(stages=[*_assembled(features), PCA(k=k, inputCol="features", outputCol="pca")]).fit(rows)
    parts = vector_to_array("pca")
    return model.transform(rows).select(S.USER, *[parts[i].alias(f"pc{i + 1}") for i in range(k)])


def classification_metrics(scored: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Accuracy, precision, recall, F1 and exact ROC-AUC of (label, score), as one row.

    The AUC is the rank sum of the positives, with average ranks for equal scores.
    """
    hit = F.col("score") >= threshold
    positive = F.col("label") == 1
    counts = scored.agg(F.count_if(hit & positive).alias("tp"), F.count_if(hit & ~positive).alias("fp"),
                        F.count_if(~hit & positive).alias("fn"), F.count_if(~hit & ~positive).alias("tn"))
    per_score = scored.groupBy(F.col("score").cast("double").alias(VALUE)).agg(F.count_if(positive).alias("positives"))
    ranks = ranked_values(value_counts(scored, ["score"])).select(
        VALUE, ((F.col("lo") + 1 + F.col("hi")) / 2.0).alias("rank"))
    rank_sum = per_score.join(ranks, VALUE).agg(F.sum(F.col("positives") * F.col("rank")).alias("s")).scalar()
    p, n = F.col("tp") + F.col("fn"), F.col("fp") + F.col("tn")
    precision, recall = safe_rate(F.col("tp"), F.col("tp") + F.col("fp")), safe_rate(F.col("tp"), p)
    return counts.select(
        safe_rate(F.col("tp") + F.col("tn"), p + n).alias("accuracy"), precision.alias("precision"),
        recall.alias("recall"), F.try_divide(2 * precision * recall, precision + recall).alias("f1"),
        safe_rate(rank_sum - p * (p + 1) / 2.0, p * n).alias("roc_auc"))


def threshold_sweep(scored: DataFrame, steps: int = 100) -> DataFrame:
    """Precision and recall at every threshold i / steps, from cumulative counts of score buckets."""
    bucket = F.least(F.floor(F.col("score") * steps), F.lit(steps)).cast("int")
    per_bucket = scored.groupBy(bucket.alias("bucket")).agg(
        F.count_if(F.col("label") == 1).alias("p"), F.count("*").alias("n"))
    grid = scored.sparkSession.range(steps + 1).select(F.col("id").cast("int").alias("bucket"))
    # At most steps + 1 rows from here on.
    upward = Window.partitionBy(F.lit(1)).orderBy(F.desc("bucket"))
    everything = Window.partitionBy(F.lit(1))
    rows = grid.join(per_bucket, "bucket", "left").na.fill(0, ["p", "n"]).select(
        (F.col("bucket") / F.lit(float(steps))).alias("threshold"), F.sum("p").over(upward).alias("tp"),
        F.sum("n").over(upward).alias("predicted_positive"), F.sum("p").over(everything).alias("positives"))
    return rows.select("threshold", "tp", "predicted_positive",
                       safe_rate(F.col("tp"), F.col("predicted_positive")).alias("precision"),
                       safe_rate(F.col("tp"), F.col("positives")).alias("recall"))


def error_slices(scored: DataFrame, slice_column: Column, threshold: float = 0.5) -> DataFrame:
    wrong = (F.col("score") >= threshold) != (F.col("label") == 1)
    return scored.groupBy(slice_column.alias("slice")).agg(
        F.count("*").alias("users"), F.count_if(wrong).alias("misclassified"),
        F.avg(wrong.cast("double")).alias("error_rate"))


def dense_ids(df: DataFrame, column: str, index: str) -> DataFrame:
    """(column, index) for each distinct value: whole numbers from 0 up, in the order of the values.

    Values are range-partitioned, counted per partition and numbered inside each; only the counts, one per
    partition, come together in one place.
    """
    spread = materialize(df.select(column).where(F.col(column).isNotNull()).distinct().repartitionByRange(column)
                         .withColumn("_part", F.spark_partition_id()), "ids")
    sizes = spread.groupBy("_part").agg(F.count("*").alias("_n"))
    before = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(column)) - 1
    return spread.join(F.broadcast(before), "_part").select(column, (F.col("_before") + inside).alias(index))


def playtime_factors(reviews: DataFrame, held_out: bool = True) -> DataFrame:
    """Predicted log playtime of held-out (user, app) pairs, or of those fitted to, from ALS on the user x app matrix.

    Every such pair is returned; its prediction is NULL where the user or the app isn't in the training part.
    Users are numbered densely for the fit, which takes 32-bit ids only. They get their numbers before pairs are grouped, so
    that rows are dealt once, by user, for both, and each user's are written together. Ratings are fitted as differences from their
    mean: the penalty, which grows with a user's number of ratings, would otherwise draw all predictions below it.
    As each iteration ends with the users' ridge regressions, the squared error on the training pairs is below the
    ratings' variance.
    """
    rated = materialize(reviews.where(F.col(S.USER).isNotNull()).select(
        S.USER, S.APP, F.log1p(F.col("author_playtime_forever").cast("double")).alias("rating")), "rated")
    users = materialize(dense_ids(rated, S.USER, "user"), "users")
    if users.count() > 2 ** 31 - 1:
        raise ValueError("more users than 32-bit ids: fit on a share of them")
    pairs = rated.join(users.hint("merge"), S.USER).groupBy(S.USER, F.col("user").cast("int").alias("user"), S.APP).agg(F.max("rating").alias("rating"))
    # The mean, the fit and the result all ask which pairs are left out.
    numbered = materialize(pairs.withColumn("left_out", hash_bucket(F.concat_ws("|", S.USER, S.APP)) < 2_000), "ratings")
    left_out = F.col("left_out")
    training = numbered.where(~left_out).where("rating IS NOT NULL")
    mean = training.agg(F.avg("rating")).first()[0] or 0.0
    model = ALS(userCol="user", itemCol=S.APP, ratingCol="difference", rank=8, maxIter=5, seed=42,
                coldStartStrategy="nan").fit(training.withColumn("difference", F.col("rating") - mean))
    found = (F.col("prediction") + mean).cast("float")
    return model.transform(numbered.where(left_out if held_out else ~left_out)).select(
        S.USER, S.APP, "rating", F.when(~F.isnan("prediction"), found).alias("prediction"))

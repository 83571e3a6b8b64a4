"""Quality classifier: regularised quadratic discriminant analysis over document statistics.

Each class is a Gaussian over transformed statistics of a text. Its covariance is shrunk towards the pooled one
and that towards its diagonal, so that it can be inverted however few rows there are. A score is the difference
of the two log densities, from Mahalanobis distances by Cholesky factors that are worked out once.

Training needs one aggregate per class (count, sums, sums of products: 2 rows in all), whatever the corpus' size.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from emberline.functions.storage import materialize
from emberline.llm.common import SLICE_ROWS, map_rows
from emberline.llm.text_stats import TextStats, text_stats

#: Fixed values of the result contract.
FOLDS = 5
THRESHOLD = 0.3

#: Shrinkage of a class covariance to the pooled one, of the result to its diagonal, and what is added to it.
TO_POOLED = 0.1
TO_DIAGONAL = 0.05
RIDGE = 1e-3


def features(s: TextStats) -> list[float]:
    """Logs of counts and of shares; a share is taken per word, line or letter and never divides by zero."""
    words, lines = s.n_words + 1, s.n_lines + 1
    letters = s.n_upper + s.n_lower + 1
    share = [s.n_symbols / words, s.n_repeat_words / words, s.n_dup_lines / lines, s.n_upper / letters,
             s.n_exclaim / words, s.n_same_as_before / words, s.n_digits / (s.word_chars + 1)]
    return [np.log1p(s.n_words), np.log((s.word_chars + 1) / words), np.log((s.n_distinct_words + 1) / np.sqrt(words)),
            np.log(words / lines), s.n_ended_lines / lines, *np.log(np.array(share) + 0.02)]


N_FEATURES = len(features(text_stats("")))


@dataclass(frozen=True)
class Gaussian:
    mean: np.ndarray
    inverse_factor: np.ndarray  # inverse of the lower Cholesky factor
    log_det: float

    def log_density(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.mean) @ self.inverse_factor.T
        return -0.5 * ((z * z).sum(axis=1) + self.log_det)


@dataclass(frozen=True)
class Discriminant:
    """``classes`` is None where training saw no rows of one class: the score is then the prior."""

    prior: float
    classes: tuple[Gaussian, Gaussian] | None

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.classes is None:
            return np.full(len(x), self.prior)
        bad, good = self.classes
        # the mean over the statistics: they depend on each other, so that their sum would be overconfident
        odds = (good.log_density(x) - bad.log_density(x)) / N_FEATURES + np.log(self.prior / (1 - self.prior))
        return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


def fit(counts: list[float], sums: list[np.ndarray], products: list[np.ndarray]) -> Discriminant:
    """From each class' number of rows, sum of vectors and sum of outer products; order: label 0, label 1."""
    total = sum(counts)
    if min(counts) < 1:
        return Discriminant(counts[1] / total if total else 0.5, None)
    means = [s / n for s, n in zip(sums, counts)]
    scatter = [p - n * np.outer(m, m) for p, n, m in zip(products, counts, means)]
    pooled = sum(scatter) / max(total - 2, 1)
    classes = []
    for n, m, s in zip(counts, means, scatter):
        own = s / max(n - 1, 1)
        weight = max(TO_POOLED, N_FEATURES / (N_FEATURES + n))
        cov = (1 - weight) * own + weight * pooled
        cov = (1 - TO_DIAGONAL) * cov + TO_DIAGONAL * np.diag(np.diag(cov)) + RIDGE * np.eye(len(m))
        factor = np.linalg.cholesky(cov)
        classes.append(Gaussian(m, np.linalg.inv(factor), 2 * float(np.log(np.diag(factor)).sum())))
    return Discriminant(counts[1] / total, tuple(classes))


def held_out() -> Column:
    """Rows whose crc32 of doc_id as text divides by five are never learnt from; nor are NULL ids."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == 0, F.lit(True))


def document_features(docs: DataFrame) -> DataFrame:
    def make():
        return lambda ids, texts: [(i, features(text_stats(t))) for i, t in zip(ids, texts)]

    return map_rows(docs, ["doc_id", "text"], "doc_id long, x array<double>", make)


def train(vectors: DataFrame, labels: DataFrame) -> Discriminant:
    """All labelled rows that aren't held out take part; labels other than 0 and 1 don't."""
    known = labels.select("doc_id", F.col("quality").alias("label")).filter("label IN (0, 1)")
    rows = vectors.filter(~held_out()).join(known, "doc_id")
    pairs = [(i, j) for i in range(N_FEATURES) for j in range(i + 1)]
    found = rows.groupBy("label").agg(
        F.count("*").alias("n"),
        F.array(*[F.sum(F.col("x")[i]) for i in range(N_FEATURES)]).alias("sums"),
        F.array(*[F.sum(F.col("x")[i] * F.col("x")[j]) for i, j in pairs]).alias("products")).collect()  # two rows
    counts, sums = [0.0, 0.0], [np.zeros(N_FEATURES)] * 2
    products = [np.zeros((N_FEATURES, N_FEATURES)) for _ in range(2)]
    for row in found:
        counts[row.label], sums[row.label] = float(row.n), np.array(row.sums)
        for (i, j), v in zip(pairs, row.products):
            products[row.label][i, j] = products[row.label][j, i] = v
    return fit(counts, sums, products)


def score(vectors: DataFrame, model: Discriminant) -> DataFrame:
    def make():
        return lambda ids, xs: zip(ids, model.score(np.array(xs, float)).tolist())

    return map_rows(vectors, ["doc_id", "x"], "doc_id long, score double", make)


def quality_classifier(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score (0 to 1) and predicted (score >= 0.3) for every row of ``docs`` (doc_id, text).

    ``labels`` (doc_id, quality): only rows that aren't held out are learnt from. NULL texts count as empty and
    are scored; repeated rows are scored each; very long texts are counted whole; an empty table gives an empty result; without labels of both
    classes each score is the share of label 1 (0.5 without any). Other columns are ignored.
    """
    vectors = materialize(document_features(docs), "quality-features")
    scored = score(vectors, train(vectors, labels))
    return scored.select("doc_id", held_out().alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all their columns, that are predicted as good.

    NULL and empty texts get the score of a text without words; an empty table gives an empty one; very long texts are
    counted whole. Texts are scored where they lie: no row is joined back, so that NULL and repeated ids don't matter.
    """
    model = train(materialize(document_features(docs), "quality-features"), labels)

    @pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        parts = [texts.iloc[i:i + SLICE_ROWS] for i in range(0, len(texts), SLICE_ROWS)]
        found = [model.score(np.array([features(text_stats(t)) for t in part])) for part in parts]
        return pd.Series(np.concatenate(found) if found else np.zeros(0))

    return docs.filter(scored(F.col("text")) >= THRESHOLD)

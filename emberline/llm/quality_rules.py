"""Quality rules by weak supervision.

Each rule votes for a document (1), against it (-1) or abstains (0). The accuracies of the rules aren't set by
hand: expectation-maximisation estimates them, with the share of good documents, from how the votes of all
documents that pass the base checks agree (those that fail are decided, and would teach only what is known). A document is kept by its posterior probability of being good, not by passing every rule.

Votes depend on counts only. The corpus is reduced to (vote pattern, number of documents) before anything leaves
the executors: with m rules there are 3^m patterns at most, however many documents there are.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from emberline.functions.storage import materialize
from emberline.llm.common import map_rows
from emberline.llm.text_stats import TextStats, text_stats

#: Fixed values of the result contract.
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20


@dataclass(frozen=True)
class Rule:
    """``bad`` and ``good`` are SQL conditions on the statistics; where neither holds, the rule abstains."""

    name: str
    bad: str
    good: str


RULES = (
    Rule("length", "n_words < 10", "n_words >= 40"),
    Rule("symbols", "n_symbols > 0.10 * n_words", "n_symbols <= 0.02 * n_words AND n_words > 0"),
    Rule("symbol_share", "n_symbols > 0.03 * word_chars", "n_symbols <= 0.005 * word_chars AND n_words > 0"),
    Rule("punctuation", "n_punctuation > 0.10 * word_chars", "n_punctuation <= 0.06 * word_chars AND n_words > 0"),
    Rule("repeats", "n_repeat_words > 0.20 * n_words", "n_repeat_words <= 0.05 * n_words AND n_words >= 10"),
    Rule("duplicate_lines", "n_dup_lines > 0.30 * n_lines", "n_dup_lines <= 0.05 * n_lines AND n_lines >= 3"),
    Rule("capitals", "n_upper > 0.50 * (n_upper + n_lower)", "n_upper <= 0.20 * (n_upper + n_lower) AND n_lower > 0"),
    Rule("shouting", "n_exclaim > 0.20 * n_words", "n_exclaim <= 0.02 * n_words AND n_words > 0"),
    Rule("word_length", "word_chars > 20 * n_words OR word_chars < 2 * n_words",
         "word_chars BETWEEN 3 * n_words AND 12 * n_words AND n_words > 0"),
    Rule("variety", "n_words >= 50 AND n_distinct_words < 1.5 * sqrt(n_words)",
         "n_words >= 50 AND n_distinct_words > 4 * sqrt(n_words)"),
    Rule("stutter", "n_same_as_before > 0.10 * n_words", "n_same_as_before <= 0.02 * n_words AND n_words >= 10"),
)

#: Where rules vote, at the start and as the prior of each estimate, they vote against so many of the good and of
#: the bad documents: a bad document breaks some rules, not most of them, and a good one hardly any.
START_AGAINST_GOOD = 0.02
START_AGAINST_BAD = 0.3
START_GOOD = 0.8
PRIOR_ROWS = 20.0
ROUNDS = 200


@dataclass(frozen=True)
class VoteModel:
    """Log odds of good before any vote, and for each rule the log of P(vote | good) / P(vote | bad).

    An abstention says nothing about the document: its ratio is 0.
    """

    log_prior_odds: float
    against: np.ndarray
    for_it: np.ndarray


def fit_votes(patterns: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS) -> VoteModel:
    """Expectation-maximisation over distinct vote patterns (rows x rules, of -1, 0, 1) weighted by ``counts``.

    The start says that a vote against is likelier for bad documents, which fixes which class is called good; the
    same values act as PRIOR_ROWS pseudo-documents per rule and class, so that an empty corpus gives them back.
    """
    up, down = (patterns > 0).astype(float), (patterns < 0).astype(float)
    start = np.array([1 - START_AGAINST_BAD, 1 - START_AGAINST_GOOD])[:, None]  # P(vote for | bad), P(vote for | good)
    share = np.repeat(start, patterns.shape[1], axis=1)
    prior = np.array([1 - START_GOOD, START_GOOD])
    for _ in range(rounds):
        logs = np.log(prior)[:, None] + np.log(share) @ up.T + np.log(1 - share) @ down.T
        weight = np.exp(logs - logs.max(axis=0, initial=-np.inf))
        weight = weight / weight.sum(axis=0) * counts
        before = share
        share = (weight @ up + PRIOR_ROWS * start) / (weight @ (up + down) + PRIOR_ROWS)
        total = weight.sum(axis=1) + PRIOR_ROWS * np.array([1 - START_GOOD, START_GOOD])
        prior = total / total.sum()
        if np.abs(share - before).max(initial=0) < 1e-9:
            break
    return VoteModel(float(np.log(prior[1] / prior[0])), np.log(1 - share[1]) - np.log(1 - share[0]),
                     np.log(share[1]) - np.log(share[0]))


def document_statistics(docs: DataFrame) -> DataFrame:
    """One row of counts per row of ``docs`` (doc_id, text); NULL texts count as empty."""
    schema = "doc_id long, " + ", ".join(f"{name} long" for name in TextStats._fields)

    def make():
        return lambda ids, texts: [(i, *text_stats(t)) for i, t in zip(ids, texts)]

    return map_rows(docs, ["doc_id", "text"], schema, make)


def _vote(rule: Rule) -> Column:
    return F.expr(f"CASE WHEN {rule.bad} THEN -1 WHEN {rule.good} THEN 1 ELSE 0 END").cast("int")


def learn(statistics: DataFrame, rules: tuple[Rule, ...] = RULES) -> VoteModel:
    names = [f"v{i}" for i in range(len(rules))]
    seen = (statistics.select(*[_vote(r).alias(n) for r, n in zip(rules, names)])
            .groupBy(*names).agg(F.count("*").alias("n")).collect())  # 3^rules rows at most
    seen = sorted(tuple(row) for row in seen)
    patterns = np.array([row[:-1] for row in seen], np.int64).reshape(len(seen), len(rules))
    return fit_votes(patterns, np.array([row[-1] for row in seen], float))


def posterior(model: VoteModel, rules: tuple[Rule, ...] = RULES) -> Column:
    """The probability that a document is good, as an expression over its statistics."""
    odds = F.lit(model.log_prior_odds)
    for rule, against, for_it in zip(rules, model.against, model.for_it):
        vote = _vote(rule)
        odds = odds + F.when(vote < 0, float(against)).when(vote > 0, float(for_it)).otherwise(0.0)
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-odds))


def quality_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Counts, base verdict, posterior and verdict for every row of ``docs`` (doc_id, text).

    ``base_failed``: fewer than ten words, or more than a fifth of the words in repeated five-word windows.
    ``kept``: not base_failed and posterior >= 0.5. NULL and empty texts have no words and fail; a NULL doc_id
    and repeated rows are judged like any other row; very long texts are counted whole; an empty table gives an empty
    result. Other columns of ``docs`` are ignored.
    """
    statistics = materialize(document_statistics(docs), "quality-statistics")
    return judge(statistics, learn(statistics.filter(~_base_failed()), rules), rules)


def _base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        F.lit(100) * F.col("n_repeat_words") > F.lit(MAX_REPEAT_PERCENT) * F.col("n_words"))


def judge(statistics: DataFrame, model: VoteModel, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``statistics`` with base_failed, posterior and kept."""
    judged = statistics.withColumn("base_failed", _base_failed()).withColumn("posterior", posterior(model, rules))
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= 0.5))


def keep_by_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``docs``, with all their columns, that are kept.

    NULL and empty texts are not kept; an empty table gives an empty one; very long texts are counted whole. Statistics are taken again beside each text: no row is joined back, so that NULL and repeated ids don't matter.
    """
    statistics = materialize(document_statistics(docs), "quality-statistics")
    model = learn(statistics.filter(~_base_failed()), rules)

    @pandas_udf(", ".join(f"{name} long" for name in TextStats._fields))
    def taken(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([text_stats(t) for t in texts], columns=TextStats._fields, dtype="int64")

    beside = docs.select(F.struct("*").alias("document"), taken(F.col("text")).alias("statistics"))
    return judge(beside.select("document", "statistics.*"), model, rules).filter("kept").select("document.*")

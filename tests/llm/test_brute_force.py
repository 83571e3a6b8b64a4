"""Verdicts and scores of whole queries against plain versions that share only the fixed values and the text statistics."""

import math
import zlib
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import pytest

import corpus_pipeline
from emberline.llm import quality_classifier, quality_rules, secret_scan
from emberline.llm.text_stats import TextStats, text_stats
from test_operators import MESSY, SF, given, labels, messy  # noqa: F401  (fixtures)


def plain_rules(texts):
    """(base_failed, posterior) of each text: votes in DuckDB, expectation and maximisation document by document."""
    frame = pd.DataFrame([text_stats(t) for t in texts], columns=TextStats._fields)
    votes = duckdb.sql("SELECT " + ", ".join(f"CASE WHEN {r.bad} THEN -1 WHEN {r.good} THEN 1 ELSE 0 END AS {r.name}" for r in quality_rules.RULES)
                       + " FROM frame").fetchall()
    failed = [w < 10 or 100 * r > 20 * w for w, r in zip(frame.n_words, frame.n_repeat_words)]
    learnt = [v for v, f in zip(votes, failed) if not f]
    rules = range(len(quality_rules.RULES))
    start = {"good": quality_rules.START_AGAINST_GOOD, "bad": quality_rules.START_AGAINST_BAD}
    against, good = {c: [p] * len(rules) for c, p in start.items()}, quality_rules.START_GOOD

    def chance(vote):
        odds = {"good": good, "bad": 1 - good}
        for c in odds:
            for i in rules:
                odds[c] *= against[c][i] if vote[i] < 0 else 1 - against[c][i] if vote[i] > 0 else 1
        return odds["good"] / (odds["good"] + odds["bad"])

    for _ in range(quality_rules.ROUNDS):
        belief = [chance(v) for v in learnt]
        weights = {"good": belief, "bad": [1 - b for b in belief]}
        before, rows = against, quality_rules.PRIOR_ROWS
        against = {c: [(sum(w for w, v in zip(weights[c], learnt) if v[i] < 0) + rows * start[c])
                       / (sum(w for w, v in zip(weights[c], learnt) if v[i]) + rows) for i in rules] for c in weights}
        good = (sum(belief) + rows * quality_rules.START_GOOD) / (len(belief) + rows)
        if max(abs(a - b) for c in against for a, b in zip(against[c], before[c])) < 1e-9:
            break
    return [(f, chance(v)) for f, v in zip(failed, votes)]


@pytest.mark.parametrize("table", ["messy", "given"])
def test_verdicts_of_rules(request, table):
    docs = request.getfixturevalue(table)
    texts = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    want = sorted(((i, f, not f and p >= 0.5, round(p, 6)) for (i, _), (f, p) in zip(texts, plain_rules([t for _, t in texts]))), key=repr)
    got = sorted(((r.doc_id, r.base_failed, r.kept, round(r.posterior, 6)) for r in quality_rules.quality_rules(docs).collect()), key=repr)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert np.allclose([g[3] for g in got], [w[3] for w in want], atol=2e-6)


def plain_scores(rows, quality):
    """Scores from covariances of numpy and densities by solving, without sums of products or factors."""
    x = {n: np.array(quality_classifier.features(text_stats(t))) for n, (_, t) in enumerate(rows)}
    learnt = {0: [], 1: []}
    for n, (i, _) in enumerate(rows):
        if i is not None and zlib.crc32(str(i).encode()) % 5 and quality.get(i) in (0, 1):
            learnt[quality[i]].append(x[n])
    counts, d = {c: len(v) for c, v in learnt.items()}, len(next(iter(x.values())))
    own = {c: np.cov(np.array(v).T) for c, v in learnt.items()}
    pooled = sum((counts[c] - 1) * own[c] for c in own) / (sum(counts.values()) - 2)

    def density(c, v):
        weight = max(quality_classifier.TO_POOLED, d / (d + counts[c]))
        cov = (1 - weight) * own[c] + weight * pooled
        cov = np.where(np.eye(d, dtype=bool), cov, (1 - quality_classifier.TO_DIAGONAL) * cov) + quality_classifier.RIDGE * np.eye(d)
        gap = v - np.mean(learnt[c], axis=0)
        return -0.5 * (gap @ np.linalg.solve(cov, gap) + np.linalg.slogdet(cov)[1])

    prior = counts[1] / sum(counts.values())
    return [1 / (1 + math.exp(-((density(1, v) - density(0, v)) / d + math.log(prior / (1 - prior))))) for v in x.values()]


def test_scores_of_the_classifier(given, labels):
    rows = [(r.doc_id, r.text) for r in given.select("doc_id", "text").collect()]
    want = {i: s for (i, _), s in zip(rows, plain_scores(rows, {r.doc_id: r.quality for r in labels.collect()}))}
    got = quality_classifier.quality_classifier(given, labels).collect()
    assert len(got) == len(rows)
    for r in got:
        assert abs(r.score - want[r.doc_id]) < 1e-6 and r.predicted == (want[r.doc_id] >= 0.3)


def test_stages_of_the_pipeline_on_messy_rows(spark, messy, labels):
    def ids(df):
        return Counter(r.doc_id for r in df.collect())

    good = corpus_pipeline.classify(spark, messy, SF)
    assert good.columns == messy.columns
    assert ids(good) == ids(quality_classifier.quality_classifier(messy, labels).filter("predicted = 1"))
    ruled = corpus_pipeline.apply_rules(spark, messy, SF)
    assert ruled.columns == messy.columns and ids(ruled) == ids(quality_rules.quality_rules(messy).filter("kept"))
    masked = corpus_pipeline.mask(spark, messy, SF)
    scanner = secret_scan.Scanner((*secret_scan.BASE_RULES, *secret_scan.MORE_RULES))
    texts = [t and secret_scan.masked(t, scanner.scan([t])[0]) for _, t, _ in MESSY]
    assert masked.columns == messy.columns and Counter(r.text for r in masked.collect()) == Counter(texts)
    assert all(r.n_chars == len(r.text) for r in masked.filter("text IS NOT NULL").collect())
    once = corpus_pipeline.drop_near_duplicates(spark, messy, SF)
    assert once.columns == messy.columns and all(n == 1 for n in Counter(
        " ".join(r.text.lower().split()) for r in once.filter("trim(text) <> ''").collect() if len(r.text.split()) > 0).values())
    packed = corpus_pipeline.pack(spark, messy, SF).collect()
    assert Counter(r.doc_id for r in packed if r.piece == 0) == Counter(i for i, _, _ in MESSY)
    for stage in (corpus_pipeline.classify, corpus_pipeline.apply_rules, corpus_pipeline.drop_near_duplicates, corpus_pipeline.mask, corpus_pipeline.pack):
        assert stage(spark, messy.limit(0), SF).count() == 0

"""The two text classifiers against sums by hand, and column names that clash with the operators' own."""

import collections
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from test_operators import as_bag, chunks, frame, labels, prose  # noqa: F401

from trasvase.llm import labelled, mixing, ngram_join, quality_classifier, substring_dedup, toxicity


def test_count_ratios_by_hand(monkeypatch):
    monkeypatch.setattr(quality_classifier, "BUCKETS", 64)
    draw = np.random.default_rng(3)
    y = draw.integers(0, 2, 60)
    rows = [np.unique(np.append(draw.integers(0, 64, 12), label)).astype(np.int32) for label in y]
    model = quality_classifier.fit(rows, y)
    held = {0: collections.Counter(), 1: collections.Counter()}
    for i, (at, label) in enumerate(zip(rows, y.tolist())):
        if i % 5:  # every fifth is for the curve
            held[label].update(at.tolist())
    for bucket in range(64):
        good, bad = ((held[c][bucket] + 1) / (sum(held[c].values()) + 64) for c in (1, 0))
        seen = held[0][bucket] + held[1][bucket]
        assert model.ratio[bucket] == pytest.approx(math.log(good / bad) if seen >= quality_classifier.LEAST else 0, abs=1e-6)


def test_descent_solves_the_dual():
    draw = np.random.default_rng(9)
    size, n = 12, 30
    rows = [np.sort(draw.choice(size, 5, replace=False)) for _ in range(n)]
    rows = [(at, draw.normal(0, 1, 5)) for at in rows]
    y, cost = draw.choice([-1.0, 1.0], n), draw.uniform(0.2, 1.5, n)
    weight, bias = quality_classifier.descend(rows, y, size, cost, passes=3000)
    dense = np.zeros((n, size + 1))
    dense[:, size] = 1
    for i, (at, v) in enumerate(rows):
        dense[i, at] = v
    signed = dense * y[:, None]
    gram = signed @ signed.T
    alpha, step = np.zeros(n), 1 / np.linalg.eigvalsh(gram)[-1]
    for _ in range(200_000):  # whole gradient, all rows at once
        alpha = np.clip(alpha - step * (gram @ alpha - 1), 0, cost)
    assert np.append(weight, bias) == pytest.approx(alpha @ signed, abs=1e-4)


def counted(tokens):
    """Counts of single tokens as the model takes them: pairs of counts and how many tokens have them."""
    pairs = collections.Counter(tokens)
    return pd.DataFrame([(y, x, k) for (y, x), k in sorted(pairs.items())], columns=["toxic", "other", "tokens"])


TOKENS = [(40, 2), (30, 300), (0, 1), (1, 0), (1, 0), (0, 1), (0, 1), (25, 0), (5, 900), (0, 250), (12, 12), (60, 1), (3, 30)]


def test_token_scores_by_hand():
    counts = counted(TOKENS)
    found = {(y, x): s for y, x, s in zip(counts["toxic"], counts["other"], toxicity.scores_of(counts))}
    ys, xs = sum(y for y, _ in TOKENS), sum(x for _, x in TOKENS)
    prior = {t: toxicity.LEAST_PRIOR + toxicity.PRIOR * sum(t) / (ys + xs) for t in TOKENS}
    weight = sum(prior[t] for t in TOKENS)
    for y, x in TOKENS:
        a = prior[y, x]
        odds = math.log((y + a) / (ys + weight - y - a)) - math.log((x + a) / (xs + weight - x - a))
        error = toxicity.ERRORS * math.sqrt(1 / (y + a) + 1 / (x + a))
        if abs(odds) - error <= toxicity.EFFECT:
            assert math.isnan(found[y, x])
        else:
            shrunk = max(-toxicity.TOP, min(toxicity.TOP, odds / (1 + error**2 / odds**2)))
            assert found[y, x] == pytest.approx(shrunk - toxicity.DRIFT, abs=1e-6)
    assert any(s > 0 for s in found.values())


def test_background_rate_is_the_root():
    counts = counted(TOKENS)
    scores = toxicity.scores_of(counts)
    rate = toxicity.background_rate(scores, counts)
    of = {(y, x): s for y, x, s in zip(counts["toxic"], counts["other"], scores)}
    all_counts = sum(y + x for y, x in TOKENS)
    shares = [x + toxicity.LEAST_PRIOR + toxicity.PRIOR * (y + x) / all_counts for y, x in TOKENS]
    values = [-toxicity.DRIFT if math.isnan(of[t]) else of[t] for t in TOKENS]
    assert rate > 0 and sum(p * math.exp(rate * s) for p, s in zip(shares, values)) == pytest.approx(sum(shares), rel=1e-6)
    assert toxicity.background_rate(np.array([np.nan]), counted([(1, 1)])) == 1.0


def test_evidence_is_the_best_of_the_top_segments():
    scores, n, rate, factor = [7.0, 5.5, 5.0, 0.5], 40, 0.9, 0.3
    best, total = 0.0, 0.0
    for r, s in enumerate(scores, 1):
        total += rate * s - math.log(factor * n)
        if total > 0:
            # tail of the sum of the r best: e^-T T^(r-1) / (r! (r-1)!)
            best = max(best, -math.log(math.exp(-total) * max(total, 1.0) ** (r - 1) / (math.factorial(r) * math.factorial(r - 1))))
    assert toxicity.evidence(scores, n, rate, factor) == pytest.approx(math.log1p(best))
    assert toxicity.evidence([], 0, 1.0, 1.0) == 0.0


def test_toxicity_counts_rare_tokens_too(spark):
    rows = [(i, prose(20) + (" vile" if i % 3 == 0 else "") + f" only{i}") for i in range(120)]
    known = labels(spark, [(i, 1, int(i % 3 == 0)) for i, _ in rows])
    model = toxicity.train(frame(spark, rows), known)
    assert model.scores["vile"] > 0 and not any(t.startswith("only") for t in model.scores)


def test_training_text_of_a_repeated_id(spark):
    rows = [(1, "b"), (1, None), (1, "a"), (1, "a"), (2, None), (3, "c"), (None, "d")]
    known = labels(spark, [(i, 1, 0) for i in range(1, 4)] + [(None, 1, 1)])
    free = {i for i in range(1, 4) if not spark.range(1).select(labelled.held_out(F.lit(i))).first()[0]}
    found = labelled.training_sample(frame(spark, rows), known, "quality", 10).collect()
    assert {(r.doc_id, r.text) for r in found} == {(i, {1: "a", 2: None, 3: "c"}[i]) for i in free}


CLASHES = ("_chunk", "_drop", "_last", "_epoch", "_m_lang", "_n_lang", "_n_source", "_mix_", "_mix_lang", "_MIX_of_cut", "_range", "c0", "sig", "component_id", "a.b")


def clashing(docs):
    return docs.select("*", *[F.concat(F.lit(f"{c}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))).alias(c) for c in CLASHES])


@pytest.mark.parametrize("cut", [substring_dedup.remove_repeats, ngram_join.keep_first, lambda d: mixing.mix_sources(d, mixing.WHOLE).drop("_mix")])
def test_columns_that_clash_pass_through(spark, chunks, cut):  # noqa: F811
    plain, crowded = frame(spark), clashing(frame(spark))
    found = cut(crowded)
    assert found.columns == crowded.columns
    assert as_bag(found.collect()) == as_bag(clashing(cut(plain)).collect())


def test_mix_replaces_its_own_column(spark):
    docs = frame(spark)
    found = mixing.mix_sources(docs.withColumn("_mix", F.lit("old")), mixing.WHOLE)
    assert found.columns == [*docs.columns, "_mix"] and as_bag(found.collect()) == as_bag(mixing.mix_sources(docs, mixing.WHOLE).collect())

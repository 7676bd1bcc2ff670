"""Toxicity by maximum-scoring segments.

A token's score is its log odds between toxic and other labelled text under a Dirichlet prior, shrunk by its standard
error, less a drift, so that neutral text scores below zero. One linear scan over a text finds every maximal segment.
Segment scores are calibrated as extreme values: with rate lambda and factor K of the background, a segment of score S in
n tokens has normalised score lambda * S - ln(K * n), and the best sum over the top r segments gives the evidence of a
document. A logistic curve on labelled documents outside the counts turns evidence into a chance. Counts and curve use a
bounded sample of labelled rows; every whole text is scored, in Arrow batches beside its row.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trasvase.llm.labelled import held_out, training_sample
from trasvase.llm.quality_classifier import curve
from trasvase.session import stored

#: Labelled documents used at most; every PART-th document is for the curve.
SAMPLE, PART = 20_000, 4
#: Prior documents a token has in each class besides its part of the common weight; standard errors that a log odds must
#: exceed by ``EFFECT``; drift per token; largest score of a token.
LEAST_PRIOR, PRIOR, ERRORS, EFFECT, DRIFT, TOP = 0.5, 100.0, 2.5, 1.0, 0.25, 8.0

#: Letters of scripts that put no space between words; signs that stand alone; letters of all other scripts. Other signs and
#: spaces separate.
_RUN = (
    "\u0e00-\u109f\u1780-\u17ff\u1950-\u19df\u1a20-\u1aaf\u2e80-\u2fdf\u3005-\u3007"
    "\u3021-\u302f\u3031-\u312f\u31a0-\u4dbf\u4e00-\ua4cf\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff"
)
_SIGN = "\u2190-\u2bff\U0001f000-\U0001faff"
_LETTER = (
    "a-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u0dff\u10a0-\u167f\u1681-\u177f\u1800-\u194f\u19e0-\u1a1f\u1ab0-\u1fff\u200c\u200d"
    "\u2071\u207f\u2090-\u209c\u20d0-\u20f0\u2100-\u2189\u2c00-\u2dff\u3130-\u318f\ua4d0-\ud7ff\ufb00-\ufdff\ufe20-\ufe2f"
    "\ufe70-\ufefe\uff21-\uff3a\uff41-\uff5a\uffa0-\uffdc\U00010000-\U0001cfff\U0001d400-\U0001d7ff\U0001df00-\U0001efff"
)
_OTHER = re.compile(f"[{_RUN}{_SIGN}]")
_WORD = re.compile(f"[{_LETTER}]+")
_TOKEN = re.compile(f"(?=([{_RUN}]{{2}}|(?<![{_RUN}])[{_RUN}]|[{_SIGN}]|[{_LETTER}]+))(?:[{_LETTER}]+|[{_RUN}{_SIGN}])")


def tokens_of(text: str | None) -> list[str]:
    """Whole words; in a run of a script without spaces every two characters that follow each other; single signs."""
    lower = (text or "").encode().lower().decode()
    return (_WORD if lower.isascii() or not _OTHER.search(lower) else _TOKEN).findall(lower)


@dataclass(frozen=True)
class Model:
    scores: dict[str, float]
    rate: float
    factor: float
    slope: float
    shift: float

    def evidence(self, text: str | None) -> float:
        segments, n = self.segments(text)
        return evidence([s for s, _, _ in segments], n, self.rate, self.factor)

    def segments(self, text: str | None) -> tuple[list[tuple[float, int, int]], int]:
        """Maximal segments (score, first token, one past the last) of a text, and its number of tokens."""
        get, last, stack, total = self.scores.get, 0, [], 0.0
        tokens = tokens_of(text)
        hits = [(i, s) for i, s in enumerate(map(get, tokens)) if s is not None]
        for i, s in hits:
            total -= DRIFT * (i - last)  # neutral tokens in between
            last = i + 1
            before, total = total, total + s
            if s > 0:
                stack = _push(stack, before, total, i)
        return [(r - l, a, b) for l, r, a, b in stack], len(tokens)

    def chance(self, text: str | None) -> float:
        return round(1 / (1 + math.exp(-min(max(self.slope * self.evidence(text) + self.shift, -30), 30))), 6)


def _push(stack: list, before: float, after: float, i: int) -> list:
    """One step of the scan over maximal segments: (sum before, sum at the end, first token, one past the last)."""
    now = (before, after, i, i + 1)
    while True:
        j = len(stack) - 1
        while j >= 0 and stack[j][0] >= now[0]:
            j -= 1
        if j < 0 or stack[j][1] >= now[1]:
            stack.append(now)
            return stack
        now = (stack[j][0], now[1], stack[j][2], now[3])
        del stack[j:]


def evidence(scores: list[float], n: int, rate: float, factor: float) -> float:
    """-ln of the smallest tail chance over the top r segments; ln(1 + e^-x) at r = 1 keeps it at 0 or more."""
    best, total = 0.0, 0.0
    for r, s in enumerate(sorted(scores, reverse=True), 1):
        total += rate * s - math.log(max(factor * n, 1.0))
        if total <= 0:
            break
        best = max(best, total - (r - 1) * math.log(max(total, 1.0)) + math.lgamma(r + 1) + math.lgamma(r))
    return math.log1p(best)


def scores_of(counts: pd.DataFrame) -> np.ndarray:
    """Scores for ``counts`` (toxic, other: documents that hold a token; tokens: how many tokens have these two counts).

    A token without a clear difference is not a number: it scores as neutral text does.
    """
    y, x, many = (counts[c].to_numpy(float) for c in ("toxic", "other", "tokens"))
    ys, xs = (y * many).sum(), (x * many).sum()
    if not ys or not xs:
        return np.full(len(y), np.nan)
    prior = LEAST_PRIOR + PRIOR * (x + y) / (xs + ys)
    weight = (prior * many).sum()
    odds = np.log((y + prior) / (ys + weight - y - prior)) - np.log((x + prior) / (xs + weight - x - prior))
    error = ERRORS * np.sqrt(1 / (y + prior) + 1 / (x + prior))
    shrunk = np.clip(odds / (1 + error**2 / np.maximum(odds**2, 1e-9)), -TOP, TOP) - DRIFT
    return np.where(np.abs(odds) - error > EFFECT, shrunk.round(6), np.nan)


def background_rate(scores: np.ndarray, counts: pd.DataFrame) -> float:
    """The positive root of E[exp(rate * score)] = 1 over the other text, smoothed by the prior; ``counts`` and scores as above."""
    y, x, many = (counts[c].to_numpy(float) for c in ("toxic", "other", "tokens"))
    share = many * (x + LEAST_PRIOR + PRIOR * (x + y) / max((many * (x + y)).sum(), 1))
    s = np.where(np.isnan(scores), -DRIFT, scores)
    if not len(s) or s.max() <= 0:
        return 1.0
    low, high = 1e-6, 20.0
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if (share * np.exp(mid * s)).sum() < share.sum() else (low, mid)
    return low


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Model from at most ``sample`` labelled training documents, all their tokens counted.

    The driver holds one row a pair of counts, and the tokens whose counts differ clearly between the classes.
    """
    some = training_sample(docs, labels, "toxic", sample).withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(PART)))
    some = stored(some, "toxicity-sample")

    @F.pandas_udf("array<string>")
    def held(texts: pd.Series) -> pd.Series:
        return pd.Series([list(set(tokens_of(x))) for x in texts], dtype=object)

    tokens = some.where("part > 0").select("y", F.explode(held("text")).alias("token"))
    counts = tokens.groupBy("token").agg(F.sum("y").alias("toxic"), F.sum(1 - F.col("y")).alias("other"))
    counts = stored(counts, "toxicity-counts")
    pairs = counts.groupBy("toxic", "other").agg(F.count("*").alias("tokens")).orderBy("toxic", "other").toPandas()
    found = scores_of(pairs)
    rate = background_rate(found, pairs)
    sure = [(int(y), int(x), float(s)) for y, x, s in zip(pairs["toxic"], pairs["other"], found) if not math.isnan(s)]
    clear = docs.sparkSession.createDataFrame(sure, "toxic long, other long, score double")
    scores = {r["token"]: r["score"] for r in counts.join(clear, ["toxic", "other"]).select("token", "score").collect()}
    first = Model(scores, rate, 1.0, 1.0, 0.0)

    @F.pandas_udf("struct<best: double, n: long>")
    def best(texts: pd.Series) -> pd.DataFrame:
        found = [first.segments(x) for x in texts]
        return pd.DataFrame({"best": [max((s for s, _, _ in g), default=0.0) for g, _ in found], "n": [n for _, n in found]})

    others = some.where("part > 0 AND y = 0").select(best("text").alias("b")).where("b.n > 0").agg(F.avg(F.col("b.best") * rate - F.log("b.n")))
    factor = math.exp(min(max((others.first()[0] or 0.0) - 0.5772, -30.0), 0.0))
    middle = Model(scores, rate, factor, 1.0, 0.0)

    @F.pandas_udf("double")
    def proof(texts: pd.Series) -> pd.Series:
        return pd.Series([middle.evidence(x) for x in texts], dtype="float64")

    seen = some.where("part = 0").select("doc_id", "y", proof("text").alias("e")).orderBy("doc_id").collect()  # bounded by ``sample``
    y = np.array([r["y"] for r in seen], int)
    if len(set(y.tolist())) < 2:
        share = (y.sum() + 1) / (len(y) + 2)
        return Model(scores, rate, factor, 1.0 if scores else 0.0, math.log(share / (1 - share)))
    return Model(scores, rate, factor, *curve(np.array([r["e"] for r in seen]), y))


def chance(model: Model, text: Column) -> Column:
    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([model.chance(x) for x in texts], dtype="float64")

    return score(text)


def passages(docs: DataFrame, model: Model) -> DataFrame:
    """Every maximal segment: doc_id, score, first_token, end_token, chance_tail (its own extreme-value tail)."""

    @F.pandas_udf("array<struct<score: double, first_token: int, end_token: int, chance_tail: double>>")
    def found(texts: pd.Series) -> pd.Series:
        out = []
        for x in texts:
            segments, n = model.segments(x)
            tail = lambda s: -math.expm1(-model.factor * n * math.exp(-model.rate * s))  # noqa: B023, E731
            out.append([(s, a, b, tail(s)) for s, a, b in segments])
        return pd.Series(out)

    return docs.select("doc_id", F.explode(found("text")).alias("p")).select("doc_id", "p.*")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): held_out, score, predicted.

    Null and empty texts have no segment and get the lowest score; a null id is held out; repeated rows are scored one by
    one; other columns are ignored. Without usable labels every score is 0.5.
    """
    plain = docs.select("doc_id", "text")
    score = chance(train(plain, labels), F.col("text"))
    scored = plain.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))

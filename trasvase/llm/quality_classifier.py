"""Quality classifier: naive Bayes features in a linear support vector machine.

A text is a set of hashed n-grams: its words, and one to three successive word shapes. Indicators are scaled by the
log-count ratio of the classes, brought to unit length and given to a linear hinge-loss model fitted by dual coordinate
descent; margins become chances by a logistic curve fitted on documents the model has not seen. The fit uses a bounded
sample of labelled rows on the driver; scoring reads every whole text in Arrow batches beside its row.
"""

from __future__ import annotations

import operator
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trasvase.llm.labelled import held_out, training_sample

#: Hash buckets (a power of two), labelled documents used at most, documents a feature must be in.
BUCKETS, SAMPLE, LEAST = 1 << 18, 5000, 3
#: Penalty and passes of the hinge-loss fit; smoothing of the class counts; chance from which a text is good.
COST, PASSES, SMOOTH, CUT = 1.0, 12, 1.0, 0.3

_SHAPE = bytes(
    97 if 97 <= c <= 122 or c >= 128 else 65 if 65 <= c <= 90 else 48 if 48 <= c <= 57 else c for c in range(256)
)
_RUNS = re.compile(rb"([aA0])\1+")


def features(text: str | None) -> np.ndarray:
    """Sorted distinct buckets of a text's n-grams; a null or empty text has those of an empty one."""
    raw = (text or "").encode()
    words = raw.split()  # by white space of ASCII only
    shapes = _RUNS.sub(rb"\1", raw.translate(_SHAPE)).split()
    grams = set(raw.lower().split())
    grams.update(b"\x01" + s for s in set(shapes))
    grams.update(b"\x02" + b" ".join(p) for p in set(zip(shapes, shapes[1:])))
    grams.update(b"\x03" + b" ".join(p) for p in set(zip(shapes, shapes[1:], shapes[2:])))
    same = sum(map(operator.eq, words, words[1:]))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    grams.add(b"\x04%d" % (10 * same // max(len(words), 1)))
    grams.add(b"\x05%d" % (10 * (len(lines) - len(set(lines))) // max(len(lines), 1)))
    found = np.fromiter(map(xxhash.xxh3_64_intdigest, grams), np.uint64, len(grams))
    return np.unique((found & np.uint64(BUCKETS - 1)).astype(np.int32))


@dataclass(frozen=True)
class Model:
    """Log-count ratios and weights by bucket, bias, and the curve from margin to chance; constant without ``ratio``."""

    ratio: np.ndarray | None
    weight: np.ndarray | None
    bias: float
    slope: float
    shift: float

    def margin(self, at: np.ndarray) -> float:
        if self.ratio is None:
            return 0.0
        r = self.ratio[at].astype(np.float64)
        return float((r * self.weight[at]).sum() / max(np.sqrt((r * r).sum()), 1e-9)) + self.bias

    def chance(self, text: str | None) -> float:
        margin = self.margin(features(text)) if self.ratio is not None else 0.0
        return round(float(1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -30, 30)))), 6)


def descend(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, size: int, cost: np.ndarray, passes: int = PASSES, seed: int = 7):
    """Weights and bias of the linear hinge-loss model by dual coordinate descent; the bias is one more feature."""
    weight, alpha = np.zeros(size + 1), np.zeros(len(rows))
    rows = [(np.append(at, size), np.append(v, 1.0)) for at, v in rows]
    norms = [float(v @ v) for _, v in rows]
    draw = np.random.default_rng(seed)
    for _ in range(passes):
        for i in draw.permutation(len(rows)):
            at, v = rows[i]
            slope = y[i] * float(weight[at] @ v) - 1
            new = min(max(alpha[i] - slope / norms[i], 0.0), cost[i])
            if new != alpha[i]:
                weight[at] += (new - alpha[i]) * y[i] * v
                alpha[i] = new
    return weight[:size], float(weight[size])


def curve(margins: np.ndarray, y: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Slope and shift of the logistic curve through (margin, label), with smoothed labels, by Newton's method."""
    ones = y.sum()
    goal = np.where(y == 1, (ones + 1) / (ones + 2), 1 / (len(y) - ones + 2))
    a, b = 1.0, 0.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -30, 30)))
        d, v = p - goal, np.maximum(p * (1 - p), 1e-6)
        hess = np.array([[(v * margins**2).sum() + 1e-3, (v * margins).sum()], [(v * margins).sum(), v.sum() + 1e-3]])
        step = np.linalg.solve(hess, np.array([(d * margins).sum() + 1e-3 * (a - 1), d.sum()]))
        a, b = a - np.clip(step[0], -5, 5), b - np.clip(step[1], -5, 5)
    return float(max(a, 1e-3)), float(b)


def fit(rows: list[np.ndarray], y: np.ndarray) -> Model:
    """Model from feature sets and labels 0 or 1; with one class or none, its chance is the (smoothed) share of 1."""
    if len(set(y.tolist())) < 2 or len(y) < 10:
        share = (y.sum() + 1) / (len(y) + 2)
        return Model(None, None, 0.0, 1.0, float(np.log(share / (1 - share))))
    test = np.arange(len(y)) % 5 == 0
    if len(set(y[~test].tolist())) < 2 or len(set(y[test].tolist())) < 2:
        test[:] = False
    counts = np.zeros((2, BUCKETS))
    for at, label, out in zip(rows, y, test):
        if not out:
            counts[label, at] += 1
    shares = [(c + SMOOTH) / (c.sum() + SMOOTH * BUCKETS) for c in counts]
    ratio = np.where(counts.sum(0) >= LEAST, np.log(shares[1] / shares[0]), 0).astype(np.float32)
    scaled = []
    for at in rows:
        used = at[ratio[at] != 0]
        v = ratio[used].astype(np.float64)
        scaled.append((used, v / max(np.sqrt(v @ v), 1e-9)))
    train = np.flatnonzero(~test)
    sign = np.where(y == 1, 1.0, -1.0)
    rarer = {c: 0.5 * len(train) / max((y[train] == c).sum(), 1) for c in (0, 1)}
    cost = np.array([COST * rarer[int(c)] for c in y[train]])
    weight, bias = descend([scaled[i] for i in train], sign[train], BUCKETS, cost)
    model = Model(ratio, weight.astype(np.float32), bias, 1.0, 0.0)
    seen = np.flatnonzero(test) if test.any() else train
    return Model(ratio, model.weight, bias, *curve(np.array([model.margin(rows[i]) for i in seen]), y[seen]))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Model from at most ``sample`` labelled training documents; their feature sets come to the driver."""

    @F.pandas_udf("array<int>")
    def sets(texts: pd.Series) -> pd.Series:
        return texts.map(features)

    some = training_sample(docs, labels, "quality", sample).select("doc_id", "y", sets("text").alias("at"))
    held = sorted(some.collect(), key=lambda r: (xxhash.xxh64_intdigest(str(r["doc_id"])), r["doc_id"]))  # bounded by ``sample``
    return fit([np.array(r["at"], np.int32) for r in held], np.array([r["y"] for r in held], int))


def chance(model: Model, text: Column) -> Column:
    """Chance that a text is good."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([model.chance(x) for x in texts], dtype="float64")

    return score(text)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): held_out, score, predicted.

    Null and empty texts get a score like any other; a null id is held out; repeated rows are scored one by one; other
    columns are ignored. Without usable labels every score is 0.5.
    """
    plain = docs.select("doc_id", "text")
    score = chance(train(plain, labels), F.col("text"))
    scored = plain.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= CUT).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of ``docs`` the classifier does not reject, all columns as they were."""
    return docs.where(chance(train(docs, labels), F.col("text")) >= CUT)

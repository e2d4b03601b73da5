"""Quality classifier: random Fourier features, ridge regression, isotonic calibration.

Each text becomes a row of statistics. Standardised, they are mapped to random Fourier features,
whose inner products approximate a Gaussian kernel. Partitions sum their parts of the normal
equations, the sums are solved for ridge weights, and an isotonic fit on labelled rows that
the ridge did not see turns its output into a probability.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.quality_rules import repeated_words
from shelfmark.llm.storage import keep, small_batches
from shelfmark.llm.training import TRAIN_ROWS, labelled
from shelfmark.llm.words import WordHashes, to_bytes

FEATURES = 256  # random Fourier features
RIDGE = 1.0
SEED = 7
PARTS = 16  # partial sums of the normal equations at most, one FEATURES x FEATURES matrix each
CLIP = 4.0  # standard deviations
FOLDS = 4  # one of them calibrates

STATISTICS = ("log_words", "word_bytes", "upper", "digit", "space", "dot", "shout", "symbol", "beyond_ascii", "kinds", "top_word", "stutter", "same_lines", "repeats", "bare_symbols", "line_words")
_DOT, _SHOUT, _SYMBOL = ([ord(c) for c in chars] for chars in (".,;:", "!?", "#*$%&|<>"))


def statistics(text: str | None, known: WordHashes) -> list[float]:
    """STATISTICS of a text; all but the word and line figures are shares from 0 to 1."""
    raw = to_bytes(text)
    words = raw.split()
    n = len(words)
    if not n:
        return [0.0] * len(STATISTICS)
    each = np.bincount(np.frombuffer(raw, np.uint8), minlength=256) / len(raw)
    h = known.of(words)
    _, times = np.unique(h, return_counts=True)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return [
        math.log1p(n), sum(map(len, words)) / n, each[65:91].sum(), each[48:58].sum(), each[32] + each[9:14].sum(), each[_DOT].sum(), each[_SHOUT].sum(), each[_SYMBOL].sum(), each[192:].sum(),
        # Heaps' law: kinds grow as about the 0.75th power of the words
        len(times) / n**0.75, times.max() / n, float((h[1:] == h[:-1]).mean()) if n > 1 else 0.0, 1 - len(set(lines)) / len(lines), repeated_words(h) / n,
        sum(len(w) == 1 and w in b"#*$%&|<>" for w in words) / n, math.log1p(n / len(lines))]


def described(docs: DataFrame) -> DataFrame:
    """doc_id and STATISTICS as ``x``: one row for each row of ``docs``."""

    def describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = WordHashes()
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch.doc_id, "x": [statistics(t, known) for t in batch.text]})

    return small_batches(docs).select("doc_id", "text").mapInPandas(describe, "doc_id long, x array<double>")


class Model(NamedTuple):
    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    bounds: np.ndarray
    values: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -CLIP, CLIP)
        return np.hstack([np.cos(z @ self.directions + self.phases) * math.sqrt(2 / FEATURES), np.ones((len(x), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights

    def scores(self, x: np.ndarray) -> np.ndarray:
        raw = self.raw(x)
        # a trace of the ridge output keeps the order within a flat step
        return 0.999 * np.interp(raw, self.bounds, self.values) + 0.001 * np.clip(raw, 0, 1)


def _matrix(x: pd.Series) -> np.ndarray:
    return np.stack(x.to_numpy()) if len(x) else np.zeros((0, len(STATISTICS)))


def fit(train: DataFrame, label: str = "quality") -> Model | None:
    """``train``: doc_id, x, label. None without rows of both labels."""
    per = [F.get("x", F.lit(i)) for i in range(len(STATISTICS))]
    row = train.agg(F.min(label), F.max(label), *[F.avg(c) for c in per], *[F.stddev_pop(c) for c in per]).first()
    if row[0] is None or row[0] == row[1]:
        return None
    k = len(STATISTICS)
    mean, scale = np.array(row[2 : 2 + k]), np.array(row[2 + k :])
    scale[scale < 1e-9] = 1.0
    rng = np.random.default_rng(SEED)
    # kernel width: the median distance of standardised points is near sqrt(2 k)
    start = Model(mean, scale, rng.normal(size=(k, FEATURES)) / math.sqrt(k), rng.uniform(0, 2 * math.pi, FEATURES), np.zeros(FEATURES + 1), np.zeros(1), np.zeros(1))
    calibrates = F.pmod(F.xxhash64(F.lit("fold"), "doc_id"), F.lit(FOLDS)) == 0

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        a, b = np.zeros((FEATURES + 1, FEATURES + 1)), np.zeros(FEATURES + 1)
        for batch in batches:
            f = start.features(_matrix(batch.x))
            a += f.T @ f
            b += f.T @ batch[label].to_numpy(float)
        yield pd.DataFrame({"a": [a.ravel()], "b": [b]})

    parts = train.where(~calibrates).coalesce(PARTS).mapInPandas(sums, "a array<double>, b array<double>").toPandas()
    a = np.sum([np.asarray(x) for x in parts.a], axis=0).reshape(FEATURES + 1, -1)
    penalty = RIDGE * np.eye(FEATURES + 1) / FEATURES
    penalty[-1, -1] = 0  # the constant is free
    model = start._replace(weights=np.linalg.solve(a + penalty + 1e-9 * np.eye(FEATURES + 1), np.sum([np.asarray(x) for x in parts.b], axis=0)))

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"raw": model.raw(_matrix(batch.x)), "label": batch[label].astype(float)})

    seen = train.where(calibrates).mapInPandas(judge, "raw double, label double")
    if seen.isEmpty():
        return model._replace(bounds=np.array([0.0, 1.0]), values=np.array([0.0, 1.0]))
    steps = IsotonicRegression(featuresCol="raw", labelCol="label").fit(seen)
    return model._replace(bounds=steps.boundaries.toArray(), values=steps.predictions.toArray())


def score_quality(docs: DataFrame, labels: DataFrame, learns, rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, score (0 to 1): one row for each row of ``docs``.

    Learns from ``labels`` (doc_id, quality) where ``learns`` holds, about ``rows`` rows of them
    at most. Empty and null texts have all statistics 0 and are scored like others. Without
    labels of both kinds the score is 0.5 for all. Columns other than doc_id and text of ``docs``
    are not read; ids that are null or repeat keep their rows.
    """
    x = keep(described(docs), "quality-statistics")
    model = fit(labelled(x, labels, "quality", learns, "quality", rows))

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            scores = np.full(len(batch), 0.5) if model is None else model.scores(_matrix(batch.x))
            yield pd.DataFrame({"doc_id": batch.doc_id, "score": np.clip(scores, 0, 1)})

    return x.mapInPandas(judge, "doc_id long, score double")

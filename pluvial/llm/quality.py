"""Quality classifier: naive Bayes support vectors.

Indicators of n-grams are scaled by the classes' log-count ratios; a linear
hinge-loss model is fitted on them by dual coordinate descent.

Two n-gram streams are read from a text's white-space words: the lower-cased
words themselves, and the words' *shapes* (letters to x/X, digits to 9, runs
shortened, other marks kept, a sign when a word repeats the one before).  Each
stream's indicator vector has length one, so long texts do not outweigh short
ones.  N-grams are hashed to a fixed number of buckets.

Null and empty texts have no n-grams and score by the offset alone.  Rows are
scored one by one, so repeated rows get equal scores, and an empty table gives
an empty result.  Very long texts are read whole.  Only doc_id and text are read;
``keep_good`` carries all columns along, whatever their names.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvial.llm.calibration import fit_logistic, sigmoid
from pluvial.llm.common import held_out, labelled_sample, plain_documents, table

BUCKETS = 1 << 18          # half for words, half for shapes
SHAPE_ORDERS = (1, 2, 3, 6)
#: Training bound: about this many documents of each class.
SAMPLE_PER_CLASS = 2500
CACHE_WORDS = 400_000
THRESHOLD = 0.7

_HALF = BUCKETS // 2
_RUN = re.compile(r"(.)\1+")


def shape(word: str) -> str:
    """Letters to x or X, digits to 9, runs of one sign to that sign."""
    signs = "".join("X" if c.isupper() else "x" if c.isalpha() else "9" if c.isdigit() else c
                    for c in word)
    return _RUN.sub(r"\1", signs)


class NGrams:
    """Distinct n-gram buckets of a text; words seen before are looked up."""

    def __init__(self) -> None:
        self.words: dict[str, tuple[int, int]] = {}

    def _codes(self, word: str) -> tuple[int, int]:
        if len(self.words) >= CACHE_WORDS:
            self.words.clear()
        lowered = word.lower()
        found = (zlib.crc32(lowered.encode("utf-8", "replace")) % _HALF,
                 zlib.crc32(shape(word).encode("utf-8", "replace")) & 0x3FFFFFFF)
        self.words[word] = found
        return found

    def of(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """(word buckets, shape buckets), each distinct and sorted."""
        words = text.split()
        if not words:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        known, codes = self.words, self._codes
        pairs = np.array([known.get(w) or codes(w) for w in words], dtype=np.int64)
        same = np.fromiter((a == b for a, b in zip(words, words[1:])), bool, len(words) - 1)
        sign = pairs[:, 1] * 2
        sign[1:] += same
        grams = [sign % 1_000_003]
        for order in SHAPE_ORDERS[1:]:
            if len(sign) >= order:
                mixed = np.full(len(sign) - order + 1, order, np.int64)
                for k in range(order):
                    mixed = (mixed * 1_000_003 + sign[k:len(sign) - order + 1 + k]) % 2_147_483_647
                grams.append(mixed)
        shapes = np.unique(np.concatenate(grams) % _HALF) + _HALF
        return np.unique(pairs[:, 0]), shapes


@dataclass
class QualityModel:
    weight: np.ndarray      # hinge weight times log-count ratio, per bucket
    offset: float
    slope: float            # of the logistic from margin to score
    shift: float

    def margin(self, words: np.ndarray, shapes: np.ndarray) -> float:
        total = self.offset
        for part in (words, shapes):
            if len(part):
                total += float(self.weight[part].sum()) / np.sqrt(len(part))
        return total

    def score(self, margins) -> np.ndarray:
        return sigmoid(self.slope * np.asarray(margins, float) + self.shift)


def log_count_ratio(rows: list[np.ndarray], label: np.ndarray) -> np.ndarray:
    """log of the classes' smoothed shares of documents that hold a bucket."""
    counts = np.ones((2, BUCKETS))
    for row, y in zip(rows, label):
        counts[int(y == 1), row] += 1
    share = counts / counts.sum(axis=1, keepdims=True)
    return np.log(share[1] / share[0])


def dual_coordinate_descent(rows, values, y, cost, epochs=12, seed=0) -> np.ndarray:
    """Weights of the linear hinge-loss (L1) model; the last one is the bias.

    rows/values: bucket indices and feature values per document, y in {-1, 1},
    cost: upper bound of each document's dual variable.
    """
    w = np.zeros(BUCKETS + 1)
    alpha = np.zeros(len(rows))
    norm = np.array([v @ v + 1.0 for v in values])
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(rows)):
            gradient = y[i] * (w[rows[i]] @ values[i] + w[-1]) - 1.0
            new = min(max(alpha[i] - gradient / norm[i], 0.0), cost[i])
            if step := (new - alpha[i]) * y[i]:
                w[rows[i]] += step * values[i]
                w[-1] += step
                moved = max(moved, abs(new - alpha[i]) * norm[i])
                alpha[i] = new
        if moved < 1e-3:
            break
    return w


def _scaled(row: tuple[np.ndarray, np.ndarray], ratio: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    words, shapes = row
    values = [ratio[p] / np.sqrt(len(p)) for p in row if len(p)]
    return np.concatenate(row), np.concatenate(values) if values else np.empty(0)


def _fit(rows, label) -> tuple[np.ndarray, float]:
    ratio = log_count_ratio([np.concatenate(r) for r in rows], label)
    scaled = [_scaled(r, ratio) for r in rows]
    n1 = max(1, int((label == 1).sum()))
    n0 = max(1, len(label) - n1)
    cost = np.where(label == 1, 0.5 / n1, 0.5 / n0) * len(label)
    w = dual_coordinate_descent([r for r, _ in scaled], [v for _, v in scaled],
                                np.where(label == 1, 1.0, -1.0), cost)
    return w[:-1] * ratio, float(w[-1])


def fit(rows: list[tuple[np.ndarray, np.ndarray]], label: np.ndarray) -> QualityModel:
    """Model from n-gram rows; the logistic is fitted on margins of documents
    that the model behind them has not seen (two folds)."""
    label = np.asarray(label, int)
    if len(set(label.tolist())) < 2:   # nothing to tell apart: a constant score
        only = 2.0 if len(label) and label[0] == 1 else 0.0
        return QualityModel(np.zeros(BUCKETS), only, 1.0, 0.0)
    fold, margins = np.arange(len(label)) % 2, np.zeros(len(label))
    for k in (0, 1):
        if len(set(label[fold != k].tolist())) == 2:
            w, b = _fit([r for r, f in zip(rows, fold) if f != k], label[fold != k])
            part = QualityModel(w, b, 1.0, 0.0)
            margins[fold == k] = [part.margin(*r) for r, f in zip(rows, fold) if f == k]
    slope, shift = fit_logistic(margins, label)
    weight, offset = _fit(rows, label)
    return QualityModel(weight, offset, slope, shift)


def train(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> QualityModel:
    """Fit on a bounded sample; executors send hashed n-grams, never texts."""
    def grams(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = NGrams()
        for pdf in frames:
            found = [reader.of(t) for t in pdf["text"]]
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "label": pdf["label"],
                                "words": [w.tolist() for w, _ in found],
                                "shapes": [s.tolist() for _, s in found]})

    sample = labelled_sample(docs, labels, "quality", per_class)
    rows = (sample.mapInPandas(grams, "doc_id long, label int, words array<int>, shapes array<int>")
            .orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("words", "shapes"))
            .limit(4 * per_class).toArrow())
    pairs = [(np.asarray(w.values, np.int64), np.asarray(s.values, np.int64))
             for w, s in zip(rows.column("words"), rows.column("shapes"))]
    return fit(pairs, np.array(rows.column("label").to_pylist(), dtype=int))


def score_udf(spark, model: QualityModel):
    """Arrow-batched score of a text column under a broadcast model."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        reader, fitted = NGrams(), shared.value
        for part in texts:
            yield pd.Series(fitted.score([fitted.margin(*reader.of(t)) for t in part]))

    return score


def classify(docs: DataFrame, model: QualityModel, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, score, predicted) of every whole text."""
    score = score_udf(docs.sparkSession, model)
    return (plain_documents(docs).select("doc_id", score("text").alias("score"))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))


def keep_good(docs: DataFrame, model: QualityModel, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, whose text the model accepts."""
    score = score_udf(docs.sparkSession, model)
    return docs.where(score(F.coalesce(F.col("text"), F.lit(""))) >= threshold)


def op5_quality(spark, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    found = classify(docs, train(docs, labels))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")

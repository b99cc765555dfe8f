"""Toxicity: subword-bag embeddings averaged into a linear softmax.

A word is the mean of its character n-gram vectors, a passage the mean of its
words, and a softmax over two classes reads the passage; embeddings and
softmax are trained jointly in numpy.  Misspellings that no training text
holds share most n-grams, and so most of their vector, with the word meant.

A text's margin is the largest over all its passages of ``PASSAGE`` consecutive
words (every position, whole text; a shorter text is one passage): a single
insult in a long text must not be averaged away.  A word that repeats the one before
it counts once.  Labels are given for whole texts, so the passages to learn from are
chosen first, by the log odds of their n-grams: of a toxic text its highest ones as
toxic, by rank over the whole text; of a clean text the highest, and a share of the
others by hash, as clean.

The fit is bounded by parameters: ``SAMPLE_PER_CLASS`` texts of each class,
``TOXIC_PASSAGES`` passages of a toxic text, ``CLEAN_PASSAGES`` clean ones in all.
Texts stay on the executors, which count the n-grams, choose the passages and score
the calibration texts; the driver gets a count for each bucket of n-grams,
the chosen passages as bucket weights, and margins.

At scoring time the model is linear in the n-gram vectors, so a word folds to
one number and a passage to a running mean.

Null and empty texts are one passage without words: the margin is the
softmax's offset.  Very long texts are read whole, in parts; of passages with equal means
the first counts.  Rows are scored one by one, so repeated rows get equal
scores, and an empty table gives an empty result.  Only doc_id and text are
read; other columns, whatever their names, are not.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvial.llm.calibration import fit_logistic, sigmoid
from pluvial.llm.common import (discard, hash_fraction, held_out, labelled_sample, materialize,
                                plain_documents, table)
from pluvial.llm.ngrams import Words, chunks

BUCKETS = 1 << 20
ORDERS = (3, 4, 5)
DIM = 10
PASSAGE = 8
#: Training bounds: about this many texts of each class, passages of a toxic text,
#: and clean passages beside the highest of each clean text.
SAMPLE_PER_CLASS = 1500
TOXIC_PASSAGES = 8
CLEAN_PASSAGES = 20_000
BATCH, LEAST_PASSAGES, SMOOTHING = 128, 200_000, 2.0
THRESHOLD = 0.3


@dataclass
class ToxicityModel:
    bucket: np.ndarray      # what an n-gram adds to the margin of its word
    offset: float
    slope: float
    shift: float

    def score(self, margins) -> np.ndarray:
        return sigmoid(self.slope * np.asarray(margins, float) + self.shift)


def passage_means(values: np.ndarray, width: int = PASSAGE) -> np.ndarray:
    """Means over every run of ``width`` values (over all, if they are fewer)."""
    if len(values) <= width:
        return np.array([values.mean()]) if len(values) else np.zeros(1)
    total = np.concatenate(([0.0], np.cumsum(values)))
    return (total[width:] - total[:-width]) / width


def _unrepeated(whole: np.ndarray) -> np.ndarray:
    """False where a word repeats the one before: a run counts once."""
    first = np.ones(len(whole), bool)
    first[1:] = whole[1:] != whole[:-1]
    return first


def read_words(text: str, bucket: np.ndarray, keep_words: bool = False) -> tuple[list[str], np.ndarray]:
    """(words, mean of its n-grams' numbers for each) of a text, repeats left out;
    without ``keep_words`` the numbers only."""
    kept, values, wholes = [], [], []
    for part in chunks(text):
        words = Words(part)
        if not len(words.start):
            continue
        total, n = np.zeros(len(words.code)), np.zeros(len(words.code))
        for b, place in words.grams(ORDERS, BUCKETS):
            total[place] += bucket[b]
            n[place] += 1
        values.append(np.add.reduceat(total, words.start) / np.add.reduceat(n, words.start))
        wholes.append(b)
        if keep_words:
            kept += part.split()
    if not values:
        return [], np.empty(0)
    first = _unrepeated(np.concatenate(wholes))
    return [kept[i] for i in np.flatnonzero(first).tolist()] if keep_words else [], np.concatenate(values)[first]


def word_values(text: str, bucket: np.ndarray) -> np.ndarray:
    """Mean of its n-grams' numbers for each word of a text."""
    return read_words(text, bucket)[1]


def margin(text: str, model: ToxicityModel) -> float:
    return float(passage_means(word_values(text, model.bucket)).max()) + model.offset


def held_buckets(text: str) -> np.ndarray:
    """The buckets of all n-grams of a text, each once."""
    found = np.zeros(BUCKETS, bool)
    for part in chunks(text):
        for b, _ in Words(part).grams(ORDERS, BUCKETS):
            found[b] = True
    return np.flatnonzero(found)


def first_odds(held: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of all n-grams to choose the first passages by, for texts of class 0
    and 1: log odds of the texts of each class that hold them, the text itself left out.

    held: (2, BUCKETS) texts of each class that hold each n-gram; texts: of each class.
    """
    size = texts + 2 * SMOOTHING

    def odds(out0: int, out1: int) -> np.ndarray:
        counts = np.maximum(held - [[out0], [out1]], 0) + SMOOTHING
        return np.log(counts[1] / size[1]) - np.log(counts[0] / size[0])

    return odds(1, 0), odds(0, 1)


def weights(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, their weights) of a passage: the mean over words of the means over n-grams."""
    found = Words(" ".join(words))
    grams = list(found.grams(ORDERS, BUCKETS))
    buckets, of = np.concatenate([b for b, _ in grams]), np.concatenate([found.word[p] for _, p in grams])
    share = 1.0 / np.bincount(of, minlength=len(words))[of] / len(words)
    used, at = np.unique(buckets, return_inverse=True)
    return used, np.bincount(at, share)


def starts_of(means: np.ndarray, y: int, key: int, share: float) -> list[int]:
    """Where the passages to learn from begin, by the means of all passages.

    Of a toxic text (y = 1) up to TOXIC_PASSAGES: the highest, then others near it
    in height, by rank, that do not overlap one by more than half.  Of a clean text
    the highest, and of every half-overlapping one a ``share``, by a hash of ``key``.
    """
    best = int(means.argmax())
    if y == 1:
        high = np.flatnonzero(means >= max(means[best] * 0.7, 0.0))
        taken = [best]
        for start in high[np.argsort(-means[high], kind="stable")].tolist():
            if len(taken) == TOXIC_PASSAGES:
                break
            if all(abs(start - t) >= PASSAGE // 2 for t in taken):
                taken.append(start)
        return taken
    others = np.arange(0, len(means), PASSAGE // 2)
    mixed = (others.astype(np.uint64) + np.uint64(key)) * np.uint64(0x9E3779B97F4A7C15)
    mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return [best, *others[(mixed >> np.uint64(11)) / 2.0 ** 53 < share].tolist()]


def passages(text: str, y: int, odds: np.ndarray, share: float) -> list[tuple[np.ndarray, np.ndarray]]:
    """Passages of a text to learn from, as bucket weights."""
    words, values = read_words(text, odds, keep_words=True)
    if not words:
        return []
    key = zlib.crc32(text.encode("utf-8", "replace"))
    return [weights(words[s:s + PASSAGE]) for s in starts_of(passage_means(values), y, key, share)]


def _learn(found: list[tuple[np.ndarray, np.ndarray]], y_all: np.ndarray, rng) -> tuple[np.ndarray, float]:
    """(margin of each bucket, offset): embeddings and softmax jointly, by Adagrad."""
    emb = rng.normal(0, 0.02, (BUCKETS, DIM)).astype(np.float32)
    soft = rng.normal(0, 0.1, (DIM, 2))
    bias = np.zeros(2)
    seen, seen_soft, seen_bias = np.full(BUCKETS, 1e-6, np.float32), 1e-6, 1e-6
    weight = 0.5 / np.maximum(np.bincount(y_all, minlength=2) / max(1, len(y_all)), 1e-9)
    epochs = int(np.clip(LEAST_PASSAGES // max(1, len(found)), 2, 12))
    for _ in range(epochs):
        order = rng.permutation(len(found))
        for lo in range(0, len(order), BATCH):
            part = [found[i] for i in order[lo:lo + BATCH]]
            y = y_all[order[lo:lo + BATCH]]
            # the averaging matrix, passages x buckets, as (row, col, mass)
            row = np.repeat(np.arange(len(part)), [len(b) for b, _ in part])
            mass = np.concatenate([m for _, m in part])
            buckets, col = np.unique(np.concatenate([b for b, _ in part]), return_inverse=True)
            own = emb[buckets]
            hidden = np.stack([np.bincount(row, mass * own[col, d], len(part))
                               for d in range(DIM)], axis=1)
            logits = hidden @ soft + bias
            error = (sigmoid(logits[:, 1] - logits[:, 0]) - (y == 1)) * weight[y] / len(part)
            g = error[:, None] * np.array([[-1.0, 1.0]])
            grad_soft, grad_hidden = hidden.T @ g, g @ soft.T
            grad = np.stack([np.bincount(col, mass * grad_hidden[row, d], len(buckets))
                             for d in range(DIM)], axis=1)
            seen[buckets] += (grad ** 2).mean(axis=1)
            emb[buckets] -= 0.3 * grad / np.sqrt(seen[buckets])[:, None]
            seen_soft += float((grad_soft ** 2).mean())
            seen_bias += float((g.sum(axis=0) ** 2).mean())
            soft -= 0.1 * grad_soft / np.sqrt(seen_soft)
            bias -= 0.1 * g.sum(axis=0) / np.sqrt(seen_bias)
    bucket = (emb @ (soft[:, 1] - soft[:, 0])) * (seen > 1e-6)   # unseen n-grams say nothing
    return bucket, float(bias[1] - bias[0])


def _model(found: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, seed: int = 0) -> ToxicityModel:
    """The model of chosen passages, not calibrated yet; their order does not matter."""
    order = sorted(range(len(found)), key=lambda i: (int(y[i]), found[i][0].tobytes(), found[i][1].tobytes()))
    bucket, offset = _learn([found[i] for i in order], np.asarray(y, int)[order], np.random.default_rng(seed))
    return ToxicityModel(bucket, offset, 1.0, 0.0)


def _constant(label: int | None) -> ToxicityModel:
    """Nothing to tell apart: a constant score."""
    return ToxicityModel(np.zeros(BUCKETS), 2.0 if label == 1 else -4.0, 1.0, 0.0)


def fit(texts: list[str], label: np.ndarray, rate: float | None = None, seed: int = 0) -> ToxicityModel:
    """Model from texts at hand; the logistic is fitted on texts kept from the training.

    rate: the share of toxic texts to calibrate for (the sample's, if not given).
    """
    label = np.asarray(label, int)
    if len(set(label.tolist())) < 2:
        return _constant(int(label[0]) if len(label) else None)
    kept = np.zeros(len(label), bool)
    for c in (0, 1):
        kept[np.flatnonzero(label == c)[::4]] = True
    train_on = ~kept if len(set(label[~kept].tolist())) == 2 else np.ones(len(label), bool)
    own = [(t, int(y)) for t, y, k in zip(texts, label, train_on) if k]
    held = np.zeros((2, BUCKETS))
    for text, y in own:
        held[y, held_buckets(text)] += 1
    odds = first_odds(held, np.bincount(label[train_on], minlength=2))
    clean = sum(len(t.split()) for t, y in own if y == 0) / (PASSAGE // 2)
    share = min(1.0, CLEAN_PASSAGES / max(clean, 1))
    found = [(p, y) for text, y in own for p in passages(text, y, odds[y], share)]
    if len({y for _, y in found}) < 2:
        return _constant(None)
    model = _model([p for p, _ in found], np.array([y for _, y in found]), seed)
    model.slope, model.shift = fit_logistic(
        np.array([margin(t, model) for t, k in zip(texts, kept) if k]), label[kept],
        float(label.mean()) if rate is None else rate)
    return model


#: Every fourth text of the sample, by hash, is kept from the fit that scores are
#: calibrated on; the final fit takes all texts.
KEPT_SHARE = 0.25


def _held_counts(sample: DataFrame) -> tuple[np.ndarray, np.ndarray, float]:
    """(texts of each class that hold each n-gram, texts of each class, words of clean texts)."""
    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = np.zeros((2, BUCKETS), np.int64)
        texts, words = np.zeros(2, np.int64), 0
        for pdf in frames:
            for text, y in zip(pdf["text"], pdf["label"]):
                held[y, held_buckets(text)] += 1
                texts[y] += 1
                words += len(text.split()) * (y == 0)
        for y in (0, 1):
            used = np.flatnonzero(held[y])
            yield pd.DataFrame({"label": y, "bucket": np.append(used, -1), "n": np.append(held[y][used], texts[y]),
                                "words": np.append(np.zeros(len(used), np.int64), words * (y == 0))})

    got = (sample.mapInPandas(count, "label int, bucket long, n long, words long")
           .groupBy("label", "bucket").agg(F.sum("n").alias("n"), F.sum("words").alias("words"))
           .toArrow().to_pandas())                  # a row for each class and bucket at most
    held, texts = np.zeros((2, BUCKETS)), np.zeros(2, np.int64)
    for y in (0, 1):
        own = got[(got["label"] == y) & (got["bucket"] >= 0)]
        held[y, own["bucket"].to_numpy()] = own["n"]
        texts[y] = got[(got["label"] == y) & (got["bucket"] < 0)]["n"].sum()
    return held, texts, float(got["words"].sum())


def _model_of(rows: DataFrame) -> ToxicityModel | None:
    """The model of all texts of ``rows`` (text, label), not calibrated; None if one
    class has no passage."""
    held, texts, clean_words = _held_counts(rows)
    shared = rows.sparkSession.sparkContext.broadcast(first_odds(held, texts))
    share = min(1.0, CLEAN_PASSAGES / max(clean_words / (PASSAGE // 2), 1))

    def choose(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            found = [(y, b.astype("<i4").tobytes(), m.astype("<f8").tobytes())
                     for text, y in zip(pdf["text"], pdf["label"]) for b, m in passages(text, y, shared.value[y], share)]
            yield pd.DataFrame(found, columns=["label", "buckets", "mass"])

    got = rows.mapInPandas(choose, "label int, buckets binary, mass binary").toArrow()
    y = got["label"].to_numpy()
    if len(set(y.tolist())) < 2:
        return None
    return _model([(np.frombuffer(b, "<i4").astype(np.int64), np.frombuffer(m, "<f8"))
                   for b, m in zip(got["buckets"].to_pylist(), got["mass"].to_pylist())], y)


def train(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> ToxicityModel:
    """Fit on a bounded sample of labelled texts (see ``labelled_sample``)."""
    spark = docs.sparkSession
    rate = labels.where(~held_out(F.col("doc_id"))).agg(F.avg(F.col("toxic").cast("double"))).first()[0]
    rows, path = materialize(
        labelled_sample(docs, labels, "toxic", per_class)
        .withColumn("label", F.col("label").cast("int"))
        .withColumn("kept", hash_fraction(F.col("doc_id"), F.lit(11)) < KEPT_SHARE), "toxicity-sample")
    sizes = {(r["label"], r["kept"]): r["n"] for r in rows.groupBy("label", "kept").agg(F.count("*").alias("n")).collect()}
    classes = {y for y, _ in sizes}
    try:
        if classes != {0, 1}:
            return _constant(next(iter(classes), None))
        # small samples: the fit takes every text, and calibrates on all
        whole = any((y, k) not in sizes for y in (0, 1) for k in (False, True))
        own = rows if whole else rows.where(~F.col("kept"))
        model = _model_of(own.select("text", "label"))
        if model is None:
            return _constant(None)
        model_shared = spark.sparkContext.broadcast(model)

        @F.pandas_udf("double")
        def margins(part: pd.Series) -> pd.Series:
            return pd.Series([margin(t, model_shared.value) for t in part], dtype=float)

        seen = (rows if whole else rows.where("kept")).select("label", margins("text").alias("margin")).toArrow()
        order = np.argsort(seen["margin"].to_numpy(), kind="stable")
        slope, shift = fit_logistic(seen["margin"].to_numpy()[order], seen["label"].to_numpy()[order], rate)
        final = model if whole else _model_of(rows.select("text", "label"))     # with the texts kept so far
        final.slope, final.shift = slope, shift
        return final
    finally:
        discard(spark, path)


def classify(docs: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, score, predicted) of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in texts:
            yield pd.Series(shared.value.score([margin(t, shared.value) for t in part]))

    return (plain_documents(docs).select("doc_id", score("text").alias("score"))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))


def op1_toxicity(spark, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    found = classify(docs, train(docs, labels))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")

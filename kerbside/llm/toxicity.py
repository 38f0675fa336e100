"""Toxicity scores by non-negative positive-unlabelled learning.

Confirmed toxic documents are the positive sample, all documents are the unlabelled one; what labels call clean is
not used but for the class prior p, the share of toxic ones among labelled training documents. A linear classifier f
over the distinct words of a whole text minimises, by gradient steps in numpy,

    p E+[l(f)] + max(0, Eu[l(-f)] - p E+[l(-f)])          l(z) = log(1 + exp(-z))

where E+ and Eu are means over the positive and the unlabelled sample; while the second part is below zero, steps go
against it, so that it does not become a way to overfit. score is 1 / (1 + exp(-f)).

Words are runs of ASCII letters, in lower case, and of bytes beyond ASCII, hashed to 2**FEATURE_BITS features; a
feature counts if its shares of the two samples differ by LEAST_Z standard errors or more. Training takes at most POSITIVES and UNLABELLED rows,
the first by a hash of doc_id; scoring reads every whole text. Null texts are empty and score like a text with no known
word. Without any toxic training row every score is 0. Labels that are null or whose document is missing do not count;
a document with several label rows is toxic if one says so. Other columns are not read, or returned as they are.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import id_checksum, map_batches, texts_of

FEATURE_BITS = 20
POSITIVES, UNLABELLED = 2_000, 8_000
LEAST_Z = 5.0
STEPS, RATE, DECAY = 300, 0.1, 1e-5

_LETTERS = bytes(b if 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def distinct_words(text: str) -> set[bytes]:
    return set(text.encode("utf-8", "surrogatepass").translate(_LETTERS).split())


def feature(word: bytes) -> int:
    return zlib.crc32(word) & ((1 << FEATURE_BITS) - 1)


def held_out(fold: int = 0, folds: int = 5) -> Column:
    return F.coalesce(id_checksum() % folds == fold, F.lit(False))


class Classifier:
    """A linear function of the features of a text."""

    def __init__(self, weights: dict[int, float], bias: float) -> None:
        self.weights, self.bias = weights, bias

    def score(self, text: str) -> float:
        if self.bias == -math.inf:
            return 0.0
        found = map(self.weights.get, {feature(word) for word in distinct_words(text)})
        parts = [self.bias, *filter(None, found)]
        # Exactly rounded, hence the same for any order of the words.
        return 1 / (1 + math.exp(-max(-700.0, min(700.0, math.fsum(parts)))))


def _telling(positive: list[np.ndarray], unlabelled: list[np.ndarray]) -> np.ndarray:
    """Features whose shares of the two samples differ clearly."""
    a, b = len(positive), len(unlabelled)
    has_a, has_b = (np.bincount(np.concatenate(rows), minlength=1 << FEATURE_BITS) for rows in (positive, unlabelled))
    share = (has_a + has_b) / (a + b)
    error = np.sqrt(share * (1 - share) * (1 / a + 1 / b))
    return np.flatnonzero((error > 0) & (np.abs(has_a / a - has_b / b) >= LEAST_Z * error))


def fit(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float) -> Classifier:
    """Train on feature lists of the two samples."""
    if not positive or not unlabelled or not prior:
        return Classifier({}, -math.inf)
    rows = positive + unlabelled
    columns = np.concatenate(rows)
    used = _telling(positive, unlabelled)
    place = np.full(1 << FEATURE_BITS, -1)
    place[used] = np.arange(len(used))
    columns = place[columns]
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])[columns >= 0]
    columns = columns[columns >= 0]
    n, is_positive = len(rows), np.arange(len(rows)) < len(positive)
    w = np.zeros(len(used) + 1)
    mean, square = np.zeros_like(w), np.zeros_like(w)
    w[-1] = math.log(prior / (1 - prior)) if prior < 1 else 5.0
    for step in range(1, STEPS + 1):
        f = np.bincount(row, w[columns], n) + w[-1]
        chance = 1 / (1 + np.exp(-f))
        # Slopes of the three parts by f: l(f) has chance - 1, l(-f) has chance.
        plus = np.where(is_positive, prior * (chance - 1) / len(positive), 0)
        minus = np.where(is_positive, -prior * chance / len(positive), chance / len(unlabelled))
        loss = np.logaddexp(0, f)
        negative_risk = loss[~is_positive].mean() - prior * loss[is_positive].mean()
        slope = plus + minus if negative_risk >= 0 else -minus
        gradient = np.append(np.bincount(columns, slope[row], len(used)), slope.sum()) + DECAY * np.append(w[:-1], 0)
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.999 * square + 0.001 * gradient ** 2
        w -= RATE * (mean / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.999 ** step)) + 1e-8)
    return Classifier(dict(zip(used.tolist(), w[:-1].tolist())), float(w[-1]))


def _features(docs: DataFrame) -> list[tuple[bool, np.ndarray]]:
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [np.unique(np.array([feature(w) for w in distinct_words(text)], "<i4")).tobytes()
                 for text in texts_of(batch)]
        return pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(found, pa.binary())], ["toxic", "features"])
    rows = map_batches(docs.select("toxic", "text"), work, "toxic int, features binary").collect()
    return [(toxic == 1, np.frombuffer(features, "<i4")) for toxic, features in rows]


def learn(docs: DataFrame, labels: DataFrame) -> Classifier:
    """Train on the documents outside the held-out fold, and on labels of those only."""
    marks = (labels.filter(~held_out()).filter("toxic is not null and doc_id is not null")
             .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")))
    ids = docs.filter(~held_out()).filter("doc_id is not null").select("doc_id")
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    labelled = ids.distinct().join(marks, "doc_id")
    prior = labelled.agg(F.avg("toxic")).first()[0] or 0.0
    positive = labelled.filter("toxic = 1").orderBy(*order).limit(POSITIVES).select("doc_id", F.lit(1).alias("toxic"))
    anyone = ids.distinct().orderBy(*order).limit(UNLABELLED).select("doc_id", F.lit(0).alias("toxic"))
    sample = positive.unionAll(anyone)  # at most POSITIVES + UNLABELLED ids
    # One row of each id, of different ones the smallest text.
    chosen = (docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
              .groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).orderBy("toxic", "doc_id"))
    found = _features(chosen)
    return fit([f for toxic, f in found if toxic], [f for toxic, f in found if not toxic], float(prior))


def score(docs: DataFrame, classifier: Classifier) -> DataFrame:
    """(doc_id, score, predicted) of every document."""
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [classifier.score(text) for text in texts_of(batch)]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.float64()),
                                           pa.array([int(s >= 0.5) for s in found], pa.int32())],
                                          ["doc_id", "score", "predicted"])
    return map_batches(docs.select("doc_id", "text"), work, "doc_id long, score double, predicted int")


def keep_clean(docs: DataFrame, classifier: Classifier) -> DataFrame:
    """The documents that are not predicted toxic."""
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.filter(pa.array([classifier.score(text) < 0.5 for text in texts_of(batch)], pa.bool_()))
    return map_batches(docs, work, docs.schema)

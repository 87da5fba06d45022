"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents are the positives, any text the unlabelled rest; examples marked clean are not used. A linear
classifier over hashed words and word beginnings minimises the risk that both parts and the class prior imply, where the
estimated risk on clean text is kept from falling below zero. It is trained on a bounded sample and scores every text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.arrays import IS_NO_LETTER, TO_LOWER, hash_words, slices, text_bytes, words
from ledgerflow.llm.frames import documents_of, lists

# Documents learned from, at most: confirmed toxic ones and unlabelled ones.
POSITIVES = 4000
UNLABELLED = 8000
# Distinct features learned from of one document, at most; a longer text gives an even selection of its features.
SAMPLE_FEATURES = 2000

FEATURES = 1 << 18
BEGINNINGS = (4, 5)
# A feature is used if its frequencies among positives and unlabelled documents differ by so many standard errors.
DIFFERENCE = 5.0
STEPS, RATE, RIDGE = 300, 0.1, 1e-3
THRESHOLD = 0.3
SLICE_BYTES = 1 << 20


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def features_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) of every word and of its beginnings, with repeats."""
    data = TO_LOWER[data]
    starts, ends, first = words(data, offsets, IS_NO_LETTER)
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    found = [hash_words(data, starts, ends)]
    owners = [owner]
    for length in BEGINNINGS:
        longer = np.flatnonzero(ends - starts > length)
        found.append(hash_words(data, starts[longer], starts[longer] + length) ^ np.uint64(length << 40))
        owners.append(owner[longer])
    return np.concatenate(owners), (np.concatenate(found) & np.uint64(FEATURES - 1)).astype(np.int64)


@dataclass
class Classifier:
    weights: np.ndarray
    bias: float

    def scores(self, column: pa.Array) -> np.ndarray:
        data, offsets = text_bytes(column)
        result = np.full(len(offsets) - 1, self.bias)
        for low, high in slices(offsets, SLICE_BYTES):
            owner, feature = features_of(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low])
            used = self.weights[feature] != 0
            pairs = np.unique(owner[used] * FEATURES + feature[used])
            result[low:high] += np.bincount(pairs // FEATURES, self.weights[pairs % FEATURES], high - low)
        return 1 / (1 + np.exp(-np.clip(result, -60, 60)))


def train(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float) -> Classifier:
    """The classifier of least non-negative risk; arrays hold the distinct features of a document."""
    weights = np.zeros(FEATURES)
    if not positive or not unlabelled:
        return Classifier(weights, float(np.log(max(prior, 1e-6) / (1 - min(prior, 1 - 1e-6)))))
    n_p, n_u = len(positive), len(unlabelled)
    share_p = np.bincount(np.concatenate(positive), minlength=FEATURES) / n_p
    share_u = np.bincount(np.concatenate(unlabelled), minlength=FEATURES) / n_u
    pooled = (share_p * n_p + share_u * n_u) / (n_p + n_u)
    error = np.sqrt(pooled * (1 - pooled) * (1 / n_p + 1 / n_u)) + 1e-9
    used = np.flatnonzero((share_p - share_u) / error > DIFFERENCE)
    place = np.full(FEATURES, -1)
    place[used] = np.arange(len(used))

    def rows(sample: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        owner = np.repeat(np.arange(len(sample)), [len(s) for s in sample])
        column = place[np.concatenate(sample)]
        return owner[column >= 0], column[column >= 0]

    (own_p, col_p), (own_u, col_u) = rows(positive), rows(unlabelled)
    w, bias = np.zeros(len(used)), float(np.log(prior / (1 - prior)))
    moments = np.zeros((2, len(used) + 1))

    def sigmoid(x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x, -60, 60)))

    for step in range(1, STEPS + 1):
        g_p = bias + np.bincount(own_p, w[col_p], n_p)
        g_u = bias + np.bincount(own_u, w[col_u], n_u)
        # Logistic losses: log(1 + e^-g) of a positive, log(1 + e^g) of a negative.
        clean_risk = np.logaddexp(0, g_u).mean() - prior * np.logaddexp(0, g_p).mean()
        slope_p = -prior * sigmoid(-g_p) / n_p
        clean_p, clean_u = -prior * sigmoid(g_p) / n_p, sigmoid(g_u) / n_u
        if clean_risk >= 0:
            d_p, d_u = slope_p + clean_p, clean_u
        else:
            d_p, d_u = -clean_p, -clean_u
        gradient = np.append(
            np.bincount(col_p, d_p[own_p], len(used)) + np.bincount(col_u, d_u[own_u], len(used)) + RIDGE * w,
            d_p.sum() + d_u.sum(),
        )
        moments[0] = 0.9 * moments[0] + 0.1 * gradient
        moments[1] = 0.999 * moments[1] + 0.001 * gradient**2
        change = RATE * (moments[0] / (1 - 0.9**step)) / (np.sqrt(moments[1] / (1 - 0.999**step)) + 1e-8)
        w, bias = w - change[:-1], bias - float(change[-1])
    weights[used] = w
    return Classifier(weights, bias)


def sample_features(sample: DataFrame) -> list[np.ndarray]:
    """Distinct features of the documents of a bounded sample, brought to the driver."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            for low, high in slices(offsets, SLICE_BYTES):
                owner, feature = features_of(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low])
                pairs = np.unique(owner * FEATURES + feature)
                bounds = np.searchsorted(pairs // FEATURES, np.arange(high - low + 1))
                kept = [pairs[a:b][:: -(-(b - a) // SAMPLE_FEATURES) or 1] % FEATURES for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                n = np.cumsum([0, *map(len, kept)])
                yield pa.RecordBatch.from_arrays([lists(np.concatenate(kept).astype(np.int32), n)], ["features"])

    rows = sample.select("text").mapInArrow(task, "features array<int>").toArrow()["features"]
    return [np.asarray(row.values).astype(np.int64) for chunk in rows.chunks for row in chunk]


def learned(documents: DataFrame, labels: DataFrame) -> Classifier:
    """Train on the labels outside the held-out part; of each kind the documents with the smallest hash of their id."""
    docs = documents_of(documents).filter(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").alias("toxic"))
    known = known.filter(F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    counts = known.agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("toxic") == 1).cast("bigint")).alias("t")).first()
    prior = min(max((counts["t"] or 0) / max(counts["n"], 1), 1e-4), 1 - 1e-4)
    # Only ids are ranked; texts are fetched for the chosen ones.
    toxic = known.filter("toxic = 1").select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(POSITIVES)
    drawn = docs.select("doc_id").distinct().orderBy(F.xxhash64("doc_id", F.lit("drawn")), "doc_id").limit(UNLABELLED)
    positive = sample_features(docs.join(F.broadcast(toxic), "doc_id"))
    unlabelled = sample_features(docs.join(F.broadcast(drawn), "doc_id"))
    return train(positive, unlabelled, prior)


def toxicity_digest(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of `documents`.

    A null or empty text has the score of a text without features. A null doc_id is not held out and never learned from.
    Without labels or documents to learn from, all scores are the prior. Other columns are not looked at.
    """
    shared = documents.sparkSession.sparkContext.broadcast(learned(documents, labels))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = shared.value.scores(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(score), pa.array((score >= THRESHOLD).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"],
            )

    rows = documents_of(documents).select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"))
    return rows.mapInArrow(task, "doc_id bigint, held_out boolean, score double, predicted int")

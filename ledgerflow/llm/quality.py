"""Text quality by kernel ridge regression: random Fourier features of document statistics, isotonic calibration.

Every text becomes a row of statistics (length, case, symbols, repetition). Cosines of random projections approximate a
Gaussian kernel over them. The normal equations are sums over documents, added up per task and then per group of tasks,
so all labelled documents count. Scores are calibrated on labelled documents the equations did not see, by the monotone
step function that fits best.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.arrays import TO_LOWER, hash_runs, hash_words, slices, text_bytes, words
from ledgerflow.llm.frames import documents_of, staged

STATISTICS = (
    "log_bytes",
    "log_words",
    "bytes_per_word",
    "upper",
    "digits",
    "symbols",
    "stops",
    "marks",
    "lines",
    "wide",
    "distinct_words",
    "echoes",
    "distinct_triples",
    "symbol_ends",
    "upper_words",
    "distinct_lines",
    "longest_word",
    "equal_sizes",
)
FEATURES = 384
WIDTH = 4.0
RIDGE = 1.0
SEED = 20240118
# Groups in which the sums of tasks are added, level by level; those of the last reach the driver. Bins of the scores that
# calibration sees.
LEVELS = (512, 64, 8)
BINS = 400
THRESHOLD = 0.7
SLICE_BYTES = 1 << 20


def kind(characters: str) -> np.ndarray:
    table = np.zeros(256, np.float32)
    table[list(characters.encode())] = 1
    return table


UPPER = kind("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
DIGITS = kind("0123456789")
SYMBOLS = kind("#$%&*+/<=>@[\\]^_`{|}~")
STOPS = kind(".,;:")
MARKS = kind("!?")


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def statistics_of(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(texts, STATISTICS) of a slice of texts; an empty text has zeros."""
    n = len(offsets) - 1
    owner = np.repeat(np.arange(n), np.diff(offsets))
    size = np.diff(offsets).astype(np.float64)
    starts, ends, first = words(data, offsets)
    n_words = np.diff(first).astype(np.float64)
    of_word = np.repeat(np.arange(n), np.diff(first))

    def share(table: np.ndarray) -> np.ndarray:
        return np.bincount(owner, table[data], n) / np.maximum(size, 1)

    def per_word(flags: np.ndarray, of: np.ndarray = of_word) -> np.ndarray:
        return np.bincount(of, flags, n) / np.maximum(n_words, 1)

    def distinct(values: np.ndarray, of: np.ndarray) -> np.ndarray:
        order = np.lexsort((values, of))
        v, o = values[order], of[order]
        new = np.ones(len(v), bool)
        new[1:] = (v[1:] != v[:-1]) | (o[1:] != o[:-1])
        return np.bincount(o[new], minlength=n) / np.maximum(np.bincount(of, minlength=n), 1)

    lowered = TO_LOWER[data]
    hashes = hash_words(lowered, starts, ends)
    echo = np.zeros(len(hashes))
    echo[1:] = (hashes[1:] == hashes[:-1]) & (of_word[1:] == of_word[:-1])
    sizes = ends - starts
    equal = np.zeros(len(hashes))
    equal[1:] = (sizes[1:] == sizes[:-1]) & (of_word[1:] == of_word[:-1])
    triples = hash_runs(hashes, 3)
    inside = of_word[: len(triples)] == of_word[2:] if len(triples) else np.zeros(0, bool)
    breaks = np.zeros(256, bool)
    breaks[0x0A] = True
    line_start, line_end, line_first = words(data, offsets, breaks)
    of_line = np.repeat(np.arange(n), np.diff(line_first))
    line_hash = hash_words(data, line_start, line_end)
    longest = np.zeros(n)
    np.maximum.at(longest, of_word, sizes)
    ends_in_symbol = (SYMBOLS + MARKS)[data[ends - 1]] if len(ends) else np.zeros(0)
    upper_before = np.concatenate([[0.0], np.cumsum(UPPER[data], dtype=np.float64)])
    upper_word = (upper_before[ends] - upper_before[starts]) * 2 > sizes
    wide = (data >= 128).astype(np.float32)
    return np.stack(
        [
            np.log1p(size),
            np.log1p(n_words),
            size / np.maximum(n_words, 1),
            share(UPPER),
            share(DIGITS),
            share(SYMBOLS),
            share(STOPS),
            share(MARKS),
            share(breaks.astype(np.float32)),
            np.bincount(owner, wide, n) / np.maximum(size, 1),
            distinct(hashes, of_word),
            per_word(echo),
            distinct(triples[inside], of_word[: len(triples)][inside]) if len(triples) else np.zeros(n),
            per_word(ends_in_symbol),
            per_word(upper_word.astype(np.float64)),
            distinct(line_hash, of_line),
            np.log1p(longest),
            per_word(equal),
        ],
        axis=1,
    )


def described(docs: DataFrame) -> DataFrame:
    """(doc_id, one column per statistic) of every row of (doc_id, text)."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            parts = [
                statistics_of(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]) for a, b in slices(offsets, SLICE_BYTES)
            ]
            rows = np.concatenate(parts) if parts else np.zeros((0, len(STATISTICS)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(np.ascontiguousarray(c)) for c in rows.T]], ["doc_id", *STATISTICS]
            )

    return docs.mapInArrow(task, "doc_id bigint, " + ", ".join(f"{s} double" for s in STATISTICS))


@dataclass
class Features:
    """Random Fourier features of standardised statistics, and a constant."""

    mean: np.ndarray
    spread: np.ndarray

    def of(self, x: np.ndarray) -> np.ndarray:
        random = np.random.default_rng(SEED)
        directions = random.standard_normal((len(STATISTICS), FEATURES)) / WIDTH
        shifts = random.uniform(0, 2 * np.pi, FEATURES)
        z = np.clip((x - self.mean) / self.spread, -6, 6)
        return np.append(np.sqrt(2 / FEATURES) * np.cos(z @ directions + shifts), np.ones((len(x), 1)), axis=1)


def table_of(batch: pa.RecordBatch) -> np.ndarray:
    return np.stack([np.asarray(batch.column(s)) for s in STATISTICS], axis=1)


def normal_equations(rows: DataFrame, features: Features) -> tuple[np.ndarray, np.ndarray]:
    """Sums of outer products of features, and of features times label, over (statistics, label) rows."""

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total = np.zeros((FEATURES + 1, FEATURES + 2))
        for batch in batches:
            for first in range(0, batch.num_rows, 4096):
                part = batch.slice(first, 4096)
                phi = features.of(table_of(part))
                total[:, :-1] += phi.T @ phi
                total[:, -1] += phi.T @ np.asarray(part.column("label")).astype(np.float64)
        yield pa.RecordBatch.from_arrays(
            [pa.array([TaskContext.get().partitionId()]), pa.array([total.tobytes()], pa.binary())], ["part", "sums"]
        )

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One sum of a group, as its rows stream in."""
        total, least = None, None
        for batch in batches:
            for part, sums in zip(*(batch.column(c).to_pylist() for c in ("part", "sums")), strict=True):
                total = np.frombuffer(sums, np.float64) + (0 if total is None else total)
                least = part if least is None else min(least, part)
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([least]), pa.array([total.tobytes()], pa.binary())], ["part", "sums"])

    partial = rows.mapInArrow(per_task, "part bigint, sums binary")
    tasks = rows.rdd.getNumPartitions()
    for groups in LEVELS:
        if tasks > groups:
            partial = partial.repartition(groups, "part").mapInArrow(added, "part bigint, sums binary")
    total = np.zeros((FEATURES + 1) * (FEATURES + 2))
    for row in partial.orderBy("part").collect():
        total += np.frombuffer(row["sums"], np.float64)
    total = total.reshape(FEATURES + 1, FEATURES + 2)
    return total[:, :-1], total[:, -1]


def monotone(value: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The non-decreasing sequence closest to `value` by weighted squares: neighbours that fall are pooled."""
    pools: list[list[float]] = []
    for v, w in zip(value.tolist(), weight.tolist(), strict=True):
        pools.append([v, w, 1])
        while len(pools) > 1 and pools[-2][0] >= pools[-1][0]:
            b, a = pools.pop(), pools.pop()
            w = a[1] + b[1]
            pools.append([(a[0] * a[1] + b[0] * b[1]) / w, w, a[2] + b[2]])
    return np.concatenate([np.full(int(n), v) for v, _, n in pools]) if pools else np.zeros(0)


@dataclass
class Model:
    features: Features
    beta: np.ndarray
    edges: np.ndarray
    levels: np.ndarray

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features.of(x) @ self.beta

    def score(self, x: np.ndarray) -> np.ndarray:
        raw = self.raw(x)
        if not len(self.edges):
            return np.clip(raw, 0, 1)
        # A little of the raw score keeps the order within a step.
        return np.clip(0.999 * np.interp(raw, self.edges, self.levels) + 0.001 * np.clip(raw, 0, 1), 0, 1)


def learned(stats: DataFrame, labels: DataFrame) -> Model:
    """Fit on labelled rows whose remainder is 0 or 1, calibrate on remainder 3; remainder 2 is held out."""
    moments = stats.agg(*[F.avg(s).alias(f"m_{s}") for s in STATISTICS], *[F.stddev_pop(s).alias(f"s_{s}") for s in STATISTICS]).first()
    features = Features(
        np.array([moments[f"m_{s}"] or 0.0 for s in STATISTICS]), np.array([max(moments[f"s_{s}"] or 0.0, 1e-9) for s in STATISTICS])
    )
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").alias("label"))
    known = known.filter(F.col("label").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    rows = staged(stats.join(known, "doc_id").withColumn("fold", F.crc32(F.col("doc_id").cast("string")) % 4), "quality-labelled")
    gram, moment = normal_equations(rows.filter("fold <> 3"), features)
    beta = np.linalg.solve(gram + RIDGE * np.eye(len(gram)), moment)
    model = Model(features, beta, np.zeros(0), np.zeros(0))
    # The raw score lies near 0 to 1; bins beyond are the outermost ones.

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = model.raw(table_of(batch)) if batch.num_rows else np.zeros(0)
            number = np.clip(np.floor((raw + 0.5) / 2 * BINS), 0, BINS - 1).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(number), pa.array(np.asarray(batch.column("label")).astype(np.float64))], ["bin", "label"])

    bins = (
        rows.filter("fold = 3")
        .mapInArrow(binned, "bin bigint, label double")
        .groupBy("bin")
        .agg(F.avg("label").alias("share"), F.count(F.lit(1)).alias("n"))
        .orderBy("bin")
        .collect()
    )
    if not bins:
        return model
    edges = (np.array([b["bin"] for b in bins]) + 0.5) / BINS * 2 - 0.5
    levels = monotone(np.array([b["share"] for b in bins]), np.array([float(b["n"]) for b in bins]))
    return Model(features, beta, edges, levels)


def quality_digest(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of `documents`.

    A null or empty text has zeros as statistics and the score they get. A null doc_id is not held out and never learned
    from. Without labelled documents every score is 0. Other columns are not looked at.
    """
    stats = staged(described(documents_of(documents)), "quality-statistics")
    shared = documents.sparkSession.sparkContext.broadcast(learned(stats, labels))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = shared.value.score(table_of(batch)) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(score), pa.array((score >= THRESHOLD).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"],
            )

    rows = stats.withColumn("held_out", held_out(F.col("doc_id")))
    return rows.mapInArrow(task, "doc_id bigint, held_out boolean, score double, predicted int")

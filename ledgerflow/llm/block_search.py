"""Exact nearest neighbours by largest inner product, as a join of blocks.

Queries and candidates are packed into blocks, and every pair of blocks is one tile. A tile first multiplies the vectors
rounded to eight bits; the rounding errors bound how far the true product can be away. Pairs whose upper bound reaches
the 20th best lower bound are computed again in double precision, the best of the tile kept by a heap, and the lists of
all tiles merged. The bounds lose nothing, so the result is exact.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.llm.frames import shuffle_width, staged
from ledgerflow.llm.vectors import by_length, matrix, vectors_of

NEAREST = 20
EVERY = 20
# Vectors of a block, and the most bytes of one.
BLOCK_ROWS = 4096
BLOCK_BYTES = 4 << 20


def blocks_of(vectors: DataFrame) -> DataFrame:
    """(block, length, ids, data): packed blocks of vectors of one length, those of each task numbered apart."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_blocks: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

        def out(length: int) -> pa.RecordBatch:
            held = open_blocks.pop(length)
            ids = np.concatenate([i for i, _ in held]).astype("<i8").tobytes()
            data = np.concatenate([d for _, d in held]).astype("<f4").tobytes()
            columns = [pa.array([length], pa.int32()), pa.array([ids], pa.binary()), pa.array([data], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, ["length", "ids", "data"])

        for batch in batches:
            for rows in by_length(batch.column("embedding")):
                some = batch.take(pa.array(rows))
                ids, data = np.asarray(some.column("vec_id")), matrix(some.column("embedding"))
                length = data.shape[1]
                most = max(1, min(BLOCK_ROWS, BLOCK_BYTES // (4 * length)))
                for first in range(0, len(ids), most):
                    part = slice(first, first + most)
                    held = open_blocks.setdefault(length, [])
                    if held and sum(len(i) for i, _ in held) + len(ids[part]) > most:
                        yield out(length)
                    open_blocks.setdefault(length, []).append((ids[part], data[part]))
        for length in list(open_blocks):
            yield out(length)

    packed = vectors.mapInArrow(task, "length int, ids binary, data binary")
    return packed.withColumn("block", F.monotonically_increasing_id())


def rounded(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(values of eight bits, scale, length of the rounded vector, length of the error) per row."""
    scale = np.abs(x).max(axis=1) / 127
    q = np.rint(x / scale[:, None])
    approx = q * scale[:, None]
    return q, scale, np.linalg.norm(approx, axis=1), np.linalg.norm(x - approx, axis=1)


def inner_products(query: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Inner products in double precision, components added from first to last."""
    return np.add.accumulate(candidates * query, axis=1)[:, -1]


def tile(q_ids: np.ndarray, q: np.ndarray, c_ids: np.ndarray, c: np.ndarray, k: int) -> list[tuple[int, int, float]]:
    """The k best candidates of every query: (query, candidate, score)."""
    # Sums of products of eight-bit values stay whole numbers in 24 bits up to this many components.
    exact = np.float32 if q.shape[1] * 127 * 127 < 1 << 24 else np.float64
    q8, q_scale, q_length, q_error = rounded(q)
    c8, c_scale, c_length, c_error = rounded(c)
    c8 = c8.astype(exact)
    true_length = np.linalg.norm(q, axis=1)
    result = []
    for first in range(0, len(q), 256):
        rows = slice(first, first + 256)
        near = (q8[rows].astype(exact) @ c8.T).astype(np.float64) * q_scale[rows, None] * c_scale
        slack = q_error[rows, None] * c_length + true_length[rows, None] * c_error
        slack += 1e-12 * (q_length[rows, None] * c_length + 1e-300)
        near[q_ids[rows, None] == c_ids] = -np.inf
        lower = near - slack
        if lower.shape[1] > k:
            bar = -np.partition(-lower, k - 1, axis=1)[:, k - 1]
        else:
            bar = np.full(len(lower), -np.inf)
        alive = (near + slack >= bar[:, None]) & (near > -np.inf)
        for i in range(len(lower)):
            at = np.flatnonzero(alive[i])
            scores = inner_products(q[first + i], c[at])
            best = heapq.nsmallest(k, zip((-scores).tolist(), c_ids[at].tolist(), strict=True))
            result += [(int(q_ids[first + i]), vec, -negative) for negative, vec in best]
    return result


def nearest(embeddings: DataFrame, k: int = NEAREST, every: int = EVERY) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest of every query, which are the rows whose id divides by `every`.

    Ties go to the smaller vec_id. Vectors left out by `vectors_of` take no part. With fewer than k candidates, all are
    returned. A vec_id that occurs twice is two candidates of one name; neither is a candidate of its own query. Vectors
    are searched among those of their length. An empty table gives an empty result.
    """
    vectors = staged(vectors_of(embeddings), "vectors")
    width = shuffle_width(embeddings.sparkSession)
    queries = vectors.filter(F.col("vec_id") % every == 0)
    # Queries are a small part of every scan task; a shuffle of them alone fills their blocks.
    full = max(1, math.ceil(queries.count() / BLOCK_ROWS))
    asked = staged(blocks_of(queries.repartition(full, "vec_id")), "query-blocks")
    offered = staged(blocks_of(vectors), "candidate-blocks")
    # Each side is copied to the tiles it belongs to: a block of one meets every block of the other.
    numbers_q, numbers_c = (b.select("length", F.col("block").alias(n)) for b, n in ((asked, "qb"), (offered, "cb")))
    tiles = staged(numbers_q.join(numbers_c, "length").select("qb", "cb"), "tiles")
    pairs = (
        tiles.join(asked.select(F.col("block").alias("qb"), F.col("ids").alias("q_ids"), F.col("data").alias("q")), "qb")
        .join(offered.select(F.col("block").alias("cb"), F.col("ids").alias("c_ids"), F.col("data").alias("c")), "cb")
        .select("q_ids", "q", "c_ids", "c")
        .repartition(max(width, 12))
    )

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                q_ids, q, c_ids, c = (batch.column(i)[row].as_py() for i in range(4))
                q_ids, c_ids = np.frombuffer(q_ids, "<i8"), np.frombuffer(c_ids, "<i8")
                found = tile(
                    q_ids,
                    np.frombuffer(q, "<f4").reshape(len(q_ids), -1).astype(np.float64),
                    c_ids,
                    np.frombuffer(c, "<f4").reshape(len(c_ids), -1).astype(np.float64),
                    k,
                )
                query, vec, score = zip(*found, strict=True) if found else ((), (), ())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(query, pa.int64()), pa.array(vec, pa.int64()), pa.array(score, pa.float64())],
                    ["query_id", "vec_id", "score"],
                )

    best = pairs.mapInArrow(task, "query_id bigint, vec_id bigint, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
    )

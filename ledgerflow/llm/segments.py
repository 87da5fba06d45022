"""Windows that occur more than once: candidates by winnowing, copies of whole segments settled by counting.

A text is a sequence of units (bytes or words). Every window of `size` units is represented by the smallest hash of the
shorter pieces inside it, its fingerprint, which depends on the window alone. A segment is a longest run of windows with
one fingerprint, so every window lies in exactly one segment and equal windows lie in segments of equal fingerprint.
Most fingerprints occur once and settle their windows; what is left goes to an exact comparison.

The fingerprints that repeat are handed to the tasks as a bit filter of fixed size. A filter passes some that do not
repeat, which costs a few more rows and changes no result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.arrays import mixed, slices, text_bytes
from ledgerflow.llm.frames import lean, lists, signed, staged

# Bits of the filter of repeated fingerprints: 8 MB on the driver and in each task, whatever the input.
FILTER_BITS = 1 << 26
# Bytes of text a kernel works on at once; a longer text is taken whole.
SLICE_BYTES = 1 << 18

RUN_FIELDS = "fp bigint, seg bigint, doc_id bigint, tid bigint, start bigint, count bigint, inner boolean"
# Equal segments of one text in one row, however often a text repeats itself.
PACKED_FIELDS = "fp bigint, seg bigint, doc_id bigint, tid bigint, starts array<bigint>, count bigint, inner boolean"


@dataclass
class Runs:
    """Segments of a slice of texts; `doc` counts texts within the slice, `inner` marks a fingerprint that recurs inside."""

    fp: np.ndarray
    doc: np.ndarray
    start: np.ndarray
    count: np.ndarray
    inner: np.ndarray
    hash_of: Callable[[np.ndarray], np.ndarray]


Kernel = Callable[[np.ndarray, np.ndarray], Runs]


def runs_of_minima(minima: np.ndarray, first: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text, first window, number of windows) of every longest run of equal minima.

    Text t has `windows[t]` windows, whose minima begin at `first[t]`.
    """
    texts = np.flatnonzero(windows)
    n = windows[texts]
    total = int(n.sum())
    ahead = np.cumsum(n) - n
    at = np.arange(total) + np.repeat(first[texts] - ahead, n)
    value = minima[at]
    change = np.empty(total, bool)
    if total:
        change[0] = True
        change[1:] = value[1:] != value[:-1]
        change[ahead] = True
    begins = np.flatnonzero(change)
    counts = np.diff(np.append(begins, total))
    owner = np.repeat(np.arange(len(texts)), n)[begins] if total else np.zeros(0, np.int64)
    return texts[owner], begins - ahead[owner], counts, value[begins] if total else minima[:0]


def packed(runs: Runs, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, pa.Array, np.ndarray]:
    """(rows, hashes, starts, inner) of the segments `at`: for equal ones of one text its first row and all their starts."""
    seg = runs.hash_of(at)
    order = np.lexsort((runs.start[at], seg, runs.fp[at], runs.doc[at]))
    rows, seg = at[order], seg[order]
    fresh = np.ones(len(rows), bool)
    fresh[1:] = (np.diff(runs.doc[rows]) != 0) | (runs.fp[rows][1:] != runs.fp[rows][:-1]) | (seg[1:] != seg[:-1])
    head = np.flatnonzero(fresh)
    inner = np.logical_or.reduceat(runs.inner[rows], head) if len(head) else runs.inner[rows]
    return rows[head], seg[head], lists(runs.start[rows].astype(np.int64), np.append(head, len(rows))), inner


def emitter(kernel: Kernel, filter_bits: np.ndarray | None, wide: bool, pack: bool = False):
    """A task over (doc_id, tid, text) batches that yields segments; with a filter only those it passes.

    `pack`: wide rows are those of `PACKED_FIELDS`.
    """

    @lean
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            ids = batch.column("doc_id")
            known = np.asarray(ids.is_valid())
            ids = np.asarray(ids.fill_null(0)).astype(np.int64)
            for first, last in slices(offsets, SLICE_BYTES):
                part = offsets[first : last + 1] - offsets[first]
                runs = kernel(data[offsets[first] : offsets[last]], part)
                keep = known[first + runs.doc]
                if filter_bits is not None:
                    place = runs.fp & np.uint64(len(filter_bits) * 64 - 1)
                    keep &= (filter_bits[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)
                at = np.flatnonzero(keep)
                columns = {}
                if pack:
                    at, seg, columns["starts"], inner = packed(runs, at)
                else:
                    seg, inner = runs.hash_of(at) if wide else None, runs.inner[at]
                columns |= {"fp": signed(runs.fp[at]), "doc_id": pa.array(ids[first + runs.doc[at]])}
                if wide:
                    columns["seg"] = signed(seg)
                    columns["tid"] = batch.column("tid").take(pa.array(first + runs.doc[at]))
                    columns["start"] = pa.array(runs.start[at].astype(np.int64))
                    columns["count"] = pa.array(runs.count[at].astype(np.int64))
                columns["inner"] = pa.array(inner)
                fields = PACKED_FIELDS if pack else RUN_FIELDS
                names = [f.split()[0] for f in fields.split(", ")] if wide else ["fp", "doc_id", "inner"]
                yield pa.RecordBatch.from_arrays([columns[c] for c in names], names)

    return task


def filter_of(repeated: DataFrame, bits: int = FILTER_BITS) -> np.ndarray:
    """Bit filter of the hashes `fp`: bits are set by Spark, the driver receives at most `bits` / 64 words."""
    place = F.col("fp").bitwiseAND(F.lit(bits - 1))
    words = (
        repeated.select(
            F.shiftright(place, 6).alias("word"), F.expr(f"shiftleft(1L, int((fp & {bits - 1}L) & 63L))").alias("bit")
        )
        .groupBy("word")
        .agg(F.bit_or("bit").alias("bit"))
        .toArrow()
    )
    table = np.zeros(bits // 64, np.uint64)
    table[np.asarray(words["word"]).astype(np.int64)] = np.asarray(words["bit"]).astype(np.int64).view(np.uint64)
    return table


def repeated_segments(docs: DataFrame, kernel: Kernel, repeats: Column, label: str, pack: bool = False) -> DataFrame:
    """Staged segments whose fingerprint satisfies `repeats`, an aggregate condition over (doc_id, inner) of one `fp`.

    `docs` has (doc_id, tid, text), where tid tells texts of one doc_id apart. `pack`: equal segments of one text are one
    row with all their starts.
    """
    spark = docs.sparkSession
    fingerprints = docs.select("doc_id", "text").mapInArrow(emitter(kernel, None, False), "fp bigint, doc_id bigint, inner boolean")
    repeated = fingerprints.groupBy("fp").agg(repeats.alias("repeats")).filter("repeats").select("fp")
    shared = spark.sparkContext.broadcast(filter_of(repeated))

    @lean
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return emitter(kernel, shared.value, True, pack)(batches)

    return staged(docs.mapInArrow(task, PACKED_FIELDS if pack else RUN_FIELDS), label)


def sifted(docs: DataFrame, ids: DataFrame, flag: str, id_column: str = "doc_id") -> DataFrame:
    """`docs` with a boolean column `flag`: false where doc_id is surely not among the column doc_id of `ids`.

    Rows marked false need no join with `ids`, so their texts are not shuffled. A null doc_id is false. Both tables may
    name the id otherwise (`id_column`).
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(filter_of(ids.select(F.xxhash64(id_column).alias("fp"))))

    @F.arrow_udf("boolean")
    def passes(hashes: pa.Array) -> pa.Array:
        place = np.asarray(hashes).view(np.uint64) & np.uint64(len(shared.value) * 64 - 1)
        hit = shared.value[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1)
        return pa.array(hit.astype(bool))

    key = F.col(id_column).cast("bigint")
    return docs.withColumn(flag, passes(F.xxhash64(key)) & key.isNotNull())


def fingerprint_of_pieces(minima: np.ndarray) -> np.ndarray:
    """Minima are small numbers by nature; mixing them again spreads them evenly over partitions and filter bits."""
    return mixed(minima.copy())

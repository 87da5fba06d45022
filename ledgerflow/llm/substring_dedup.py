"""Removal of word passages that an earlier document has: windows grow by doubling while they repeat.

Windows of 25 words that occur in two documents are the only ones extended to 50 words; those of 50 that occur in a
document with a smaller id are removed. Three levels, each over what the level before could not settle:

1. 25 words. Every 50-word window is represented by the smallest hash of the 26 windows of 25 words in it. If no other
   document has that one, the window is unique.
2. Segments, the longest runs of windows with one representative. If an earlier document has the same whole segment, all
   its windows go; if no other segment has this representative, it stays.
3. 50 words, for the rest: the smallest document of each window.

All three are grouped counts that combine before the shuffle, so a passage in a third of all documents is one row per
task. Nothing is compared pairwise.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.arrays import hash_runs, hash_words, joined, mixed, sliding_minimum, slices, text_bytes, words
from ledgerflow.llm.frames import documents_of, fresh_name, lean, lists, staged
from ledgerflow.llm.segments import (
    SLICE_BYTES,
    Runs,
    fingerprint_of_pieces,
    repeated_segments,
    runs_of_minima,
    sifted,
)

WINDOW = 50


def window_kernel(size: int):
    """Segments of windows of `size` words; `size` must be even, as a window is two windows of half its length."""
    if size < 2 or size % 2:
        raise ValueError(f"the window must have an even number of words, got {size}")
    half = size // 2

    def kernel(data: np.ndarray, offsets: np.ndarray) -> Runs:
        starts, ends, first = words(data, offsets)
        hashes = hash_words(data, starts, ends)
        halves = hash_runs(hashes, half)
        minima = sliding_minimum(halves, half + 1)
        windows = np.maximum(np.diff(first) - size + 1, 0)
        doc, start, count, value = runs_of_minima(minima, first[:-1], windows)

        def hash_of(at: np.ndarray) -> np.ndarray:
            """Hash of a segment: chained over the halves that begin in it, which overlap and so fix all its words."""
            if not len(at):
                return np.zeros(0, np.uint64)
            begin = first[doc[at]] + start[at]
            n = count[at] + half
            order = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            piece = halves[np.repeat(begin, n) + order]
            terms = mixed(piece ^ (order.astype(np.uint64) * np.uint64(0xD1342543DE82EF95)))
            return joined(np.add.reduceat(terms, np.cumsum(n) - n), n.astype(np.uint64))

        return Runs(fingerprint_of_pieces(value), doc, start, count, np.zeros(len(doc), bool), hash_of)

    return kernel


def window_hashes(size: int):
    """A task from (doc_id, text, parts) to the 50-word hashes of the listed parts: (seg, least, place, hashes)."""

    @lean
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            parts = batch.column("parts")
            bounds = np.asarray(parts.offsets)
            flat = parts.flatten()
            fp, seg, start, count = (np.asarray(flat.field(i)).astype(np.int64) for i in range(4))
            bounds = bounds - bounds[0]
            least = np.asarray(batch.column("doc_id")).astype(np.int64)
            for low, high in slices(offsets, SLICE_BYTES):
                part = offsets[low : high + 1] - offsets[low]
                at, ends, first = words(data[offsets[low] : offsets[high]], part)
                halves = hash_runs(hash_words(data[offsets[low] : offsets[high]], at, ends), size // 2)
                whole = joined(halves[: -(size // 2)], halves[size // 2 :]) if len(halves) > size // 2 else halves[:0]
                rows = slice(bounds[low], bounds[high])
                text = np.repeat(np.arange(high - low), np.diff(bounds[low : high + 1]))
                n = count[rows]
                begin = np.cumsum(n) - n
                place = np.repeat(first[text] + start[rows] - begin, n) + np.arange(n.sum())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(fp[rows]),
                        pa.array(seg[rows]),
                        pa.array(least[low + text]),
                        lists(whole[place].view(np.int64), np.append(begin, n.sum())),
                    ],
                    ["fp", "seg", "least", "hashes"],
                )

    return task


def identified(documents: DataFrame) -> DataFrame:
    """(doc_id, tid, text); tid tells texts of one doc_id apart."""
    return documents_of(documents).select("doc_id", F.xxhash64("text").alias("tid"), "text")


def removed_windows(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """(doc_id, tid, parts): per document the runs (first window, number of windows) that an earlier document has.

    `docs` has (doc_id, tid, text), where tid tells texts of one doc_id apart. Documents without such windows are absent.
    """
    found = repeated_segments(docs, window_kernel(size), F.min("doc_id") < F.max("doc_id"), "window-segments")
    # Rows of one document that repeat a segment inside it are settled together by its first place.
    segments = found.groupBy("fp", "seg").agg(
        F.min(F.struct("doc_id", "tid", "start", "count")).alias("first"), F.max("doc_id").alias("last")
    )
    segments = staged(
        segments.select("fp", "seg", F.col("first.doc_id").alias("least"), "first.tid", "first.start", "first.count", "last"),
        "window-distinct",
    )
    # Only segments of a representative with several segments can share a part with another one.
    mixed_fps = segments.groupBy("fp").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("fp")
    open_segments = (
        segments.join(mixed_fps, "fp", "left_semi")
        .groupBy(F.col("least").alias("doc_id"), "tid")
        .agg(F.collect_list(F.struct("fp", "seg", "start", "count")).alias("parts"))
    )
    hashes = staged(
        sifted(docs, open_segments, "maybe")
        .filter("maybe")
        .join(open_segments, ["doc_id", "tid"])
        .dropDuplicates(["doc_id", "tid"])
        .select("doc_id", "text", "parts")
        .mapInArrow(
            window_hashes(size), "fp bigint, seg bigint, least bigint, hashes array<bigint>"
        ),
        "window-hashes",
    )
    single = hashes.select("fp", "seg", "least", F.posexplode("hashes").alias("place", "window"))
    owners = staged(
        single.groupBy("window")
        .agg(F.min("least").alias("owner"), F.max("least").alias("other"))
        .filter("owner < other")
        .select("window", "owner"),
        "window-owners",
    )
    partly = (
        single.join(owners, "window")
        .filter("owner < least")
        .groupBy("fp", "seg")
        .agg(F.collect_set("place").alias("places"))
    )
    # In its first document only the listed windows of a segment go, in every later one the whole segment.
    verdicts = segments.join(partly, ["fp", "seg"], "left").select("fp", "seg", "least", "places")
    verdicts = verdicts.join(segments.filter("last > least").select("fp", "seg", F.lit(True).alias("again")), ["fp", "seg"], "left")
    verdicts = verdicts.filter("again or places is not null")
    hit = found.join(verdicts, ["fp", "seg"])
    later = hit.filter("doc_id > least").select("doc_id", "tid", F.struct("start", "count").alias("part"))
    earliest = (
        hit.filter("doc_id = least and places is not null")
        .select("doc_id", "tid", "start", F.explode("places").alias("place"))
        .select("doc_id", "tid", F.struct((F.col("start") + F.col("place")).alias("start"), F.lit(1).cast("bigint").alias("count")).alias("part"))
    )
    return later.unionByName(earliest).groupBy("doc_id", "tid").agg(F.collect_list("part").alias("parts"))


def covered(parts: list | None, n: int, size: int) -> np.ndarray:
    """Which of `n` units lie in one of the windows (start, count) of `size` units."""
    steps = np.zeros(n + 1, np.int64)
    if parts is not None and len(parts):
        start = np.array([p["start"] for p in parts], np.int64)
        end = np.minimum(start + np.array([p["count"] for p in parts], np.int64) + size - 1, n)
        fits = start < n
        np.add.at(steps, start[fits], 1)
        np.add.at(steps, end[fits], -1)
    return np.cumsum(steps[:-1]) > 0


def digests(size: int):
    """A task from (doc_id, text[, parts]) to one row per document: counts and the hash of what is kept."""

    @lean
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text")
            parts = batch.column("parts").to_pylist() if "parts" in batch.schema.names else [None] * len(ids)
            data, offsets = text_bytes(texts)
            starts, ends, first = words(data, offsets)
            raw = data.tobytes()
            total, gone, sha = [], [], []
            for i, spans in enumerate(parts):
                here = slice(first[i], first[i + 1])
                drop = covered(spans, first[i + 1] - first[i], size)
                kept = zip(starts[here][~drop].tolist(), ends[here][~drop].tolist(), strict=True)
                total.append(len(drop))
                gone.append(int(drop.sum()))
                sha.append(hashlib.sha256(b" ".join([raw[a:b] for a, b in kept])).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(sha, pa.string())],
                ["doc_id", "n_words", "n_removed", "kept_sha256"],
            )

    return task


DIGEST = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string"


def substring_dedup_digest(documents: DataFrame, size: int = WINDOW) -> DataFrame:
    """One row per row of `documents`: n_words, n_removed and the SHA-256 of the kept words joined by one space.

    A null or blank text has no words and keeps the empty string. Texts shorter than the window lose nothing. Rows that
    share a doc_id are one document: none is earlier than the other. Rows without doc_id are compared with nothing.
    An empty table gives an empty result. Other columns of `documents` are not looked at.
    """
    docs = identified(documents)
    removed = staged(removed_windows(docs, size), "removed-windows")
    # Only documents that may lose words travel to meet their removals.
    marked = sifted(docs, removed, "maybe")
    untouched = marked.filter("not maybe").select("doc_id", "text").mapInArrow(digests(size), DIGEST)
    touched = marked.filter("maybe").join(removed, ["doc_id", "tid"], "left").select("doc_id", "text", "parts")
    return untouched.unionByName(touched.mapInArrow(digests(size), DIGEST))


def cut_task(size: int):
    """A task from (text, parts) rows to texts without the removed words, spacing elsewhere unchanged."""

    def cut(texts: list[str | None], parts: list) -> list[str | None]:
        result = []
        for text, spans in zip(texts, parts, strict=True):
            if text is None or spans is None or not len(spans):
                result.append(text)
                continue
            raw = text.encode()
            data = np.frombuffer(raw, np.uint8)
            starts, ends, _ = words(data, np.array([0, len(data)]))
            drop = covered(spans, len(starts), size)
            edges = np.flatnonzero(np.diff(np.concatenate([[False], drop, [False]]).astype(np.int8)))
            pieces, at = [], 0
            for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
                pieces.append(raw[at : starts[a]])
                at = starts[b] if b < len(starts) else len(raw)
            pieces.append(raw[at:])
            result.append(b"".join(pieces).decode())
        return result

    return cut


def substring_dedup(documents: DataFrame, size: int = WINDOW) -> DataFrame:
    """`documents` with every removed passage cut out of its text; rows whose text had only such passages go.

    All columns stay. Null, blank and short texts stay as they are. See `substring_dedup_digest` for repeated ids.
    """
    key, text_key, spans, flag = (fresh_name(documents, f"_dedup_{c}") for c in ("id", "tid", "parts", "flag"))
    removed = staged(removed_windows(identified(documents), size), "removed-windows")
    marked = sifted(documents, removed, flag)
    removed = removed.select(F.col("doc_id").alias(key), F.col("tid").alias(text_key), F.col("parts").alias(spans))
    cut = cut_task(size)

    @F.arrow_udf("string")
    def without(texts: pa.Array, parts: pa.Array) -> pa.Array:
        return pa.array(cut(texts.to_pylist(), parts.to_pylist()), pa.string())

    same = (F.col("doc_id").cast("bigint") == F.col(key)) & (F.xxhash64("text") == F.col(text_key))
    met = marked.filter(flag).join(removed, same, "left")
    cut_texts = met.withColumn("text", F.when(F.col(spans).isNull(), F.col("text")).otherwise(without("text", spans)))
    cut_texts = cut_texts.filter(F.col(spans).isNull() | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return marked.filter(~F.col(flag)).select(*documents.columns).unionByName(cut_texts.select(*documents.columns))

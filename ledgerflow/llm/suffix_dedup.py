"""Removal of bytes covered by strings of 400 bytes that occur again, by external induced suffix sorting.

Equal texts are one class: what is there twice goes whole, and takes part in the rest once.

1. Every 400-byte window is represented by the smallest hash of the 128-byte pieces in it; a representative that occurs
   once settles its windows. A segment is a run of windows of one document with one representative.
2. Equal segments are counted. Where every segment of a representative has a copy, all its windows repeat.
3. The rest is dealt to shards by representative, so equal windows meet. Windows whose core of 369 bytes is there once stay
   out. What is left of a shard is one text, its suffixes are sorted by induction, and a window repeats if its suffix shares
   400 bytes with a neighbour in that order.
4. A representative with more bytes than its part of a shard is split first: its segments pass through the same steps with
   longer pieces (366, then 396 bytes), and what is still too large with whole windows, which are settled by counting alone.
   Each step settles what the segments have in common and leaves their ends to the next.

Documents that lose nothing are never shuffled; the others travel once to be cut.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.arrays import MULTIPLIER, mixed, sliding_minimum, slices, text_bytes
from ledgerflow.llm.frames import lean, lists, shuffle_width, staged
from ledgerflow.llm.induced import Scratch, sorted_suffixes
from ledgerflow.llm.segments import Runs, fingerprint_of_pieces, repeated_segments, runs_of_minima, sifted
from ledgerflow.llm.substring_dedup import covered
from ledgerflow.operators.joins import broadcast_if_small

LENGTH = 400
PIECE = 128
# Bytes a shard should hold at most: shards are dealt to hold half of that on average. The most bytes of one representative.
SHARD_BYTES = 2 << 20
KEY_BYTES = SHARD_BYTES // 8
# Up to so many neighbouring windows share one core, the bytes that all of them hold.
GRAIN = 32
# The id of a row without one, inside the job.
NO_ID = -(2**63)

END, GAP, FIRST = 0, 1, 2


def piece_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """Hash of the `size` bytes from every position on, by doubling; `size` is 8 at least.

    A polynomial over mixed pieces of eight bytes, mixed again at the end: equal bytes have equal hashes, and should
    different ones have, more is compared later and nothing else.
    """
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    hashes = mixed(np.ndarray((len(data),), "<u8", padded, strides=(1,)).copy())
    covered_bytes, factor = 8, int(MULTIPLIER)
    while covered_bytes < size:
        # The last step may overlap: both pieces together still hold all the bytes.
        step = min(covered_bytes, size - covered_bytes)
        if len(hashes) <= step:
            return hashes[:0]
        hashes = hashes[:-step] * np.uint64(factor) + hashes[step:]
        # Odd, and another one for every level.
        factor = factor * int(MULTIPLIER) & (1 << 64) - 1
        covered_bytes += step
    return mixed(hashes[: max(0, len(data) - size + 1)])


def recurs(hashes: np.ndarray, value: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Whether hashes[first..last] has `value` more than once, for every row; it has it once at least."""
    order = np.argsort(value, kind="stable")
    known = value[order]
    # Minima are small, most other hashes are larger than all of them.
    hit = np.flatnonzero(hashes <= known[-1]) if len(known) else np.zeros(0, np.int64)
    if len(hit):
        hit = hit[known[np.minimum(np.searchsorted(known, hashes[hit]), len(known) - 1)] == hashes[hit]]
    low, high = np.searchsorted(hit, first), np.searchsorted(hit, last, "right")
    result = np.zeros(len(value), bool)
    many = np.flatnonzero(high - low > 1)
    n = (high - low)[many]
    row = np.repeat(many, n)
    place = hit[np.repeat(low[many] - np.cumsum(n) + n, n) + np.arange(n.sum())]
    result[np.bincount(row, hashes[place] == value[row], len(value)) > 1] = True
    return result


def byte_kernel(length: int, piece: int):
    """Segments of windows of `length` bytes, represented by pieces of `piece` bytes.

    Pieces as long as the windows make runs of one window; such a segment goes by the hash of that window alone.
    """
    if piece < 8 or piece > length:
        raise ValueError(f"pieces must have between 8 and {length} bytes, got {piece}")

    def kernel(data: np.ndarray, offsets: np.ndarray) -> Runs:
        hashes = piece_hashes(data, piece)
        minima = sliding_minimum(hashes, length - piece + 1)
        windows = np.maximum(np.diff(offsets) - length + 1, 0)
        doc, start, count, value = runs_of_minima(minima, offsets[:-1], windows)
        begin = offsets[doc] + start
        inner = recurs(hashes, value, begin, begin + count - 1 + length - piece)
        raw = data.tobytes()

        def hash_of(at: np.ndarray) -> np.ndarray:
            import xxhash

            ends = begin[at] + (count[at] if piece < length else 1) + length - 1
            return np.array(
                [xxhash.xxh3_64_intdigest(raw[a:b]) for a, b in zip(begin[at].tolist(), ends.tolist(), strict=True)], np.uint64
            )

        return Runs(fingerprint_of_pieces(value), doc, start, count, inner, hash_of)

    return kernel


def longer_piece(length: int, piece: int) -> int:
    """The pieces of the next step: a window holds an eighth as many of them, in the end one."""
    return length - (length - piece) // 8


SEGMENT_BYTES = "fp bigint, seg bigint, single boolean, count bigint, bytes binary, piece int"


def part_bytes(length: int, piece: int):
    """A task from (text, parts) to the bytes of the listed segments, which have pieces of `piece` bytes."""

    @lean
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            raw = data.tobytes()
            parts = batch.column("parts")
            flat = parts.flatten()
            owner = np.repeat(np.arange(batch.num_rows), np.diff(np.asarray(parts.offsets)))
            fp, seg, start, count = (flat.field(i) for i in range(4))
            begin = offsets[owner] + np.asarray(start)
            ends = begin + np.asarray(count) + length - 1
            cut = [raw[a:b] for a, b in zip(begin.tolist(), ends.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [fp, seg, flat.field(4), count, pa.array(cut, pa.binary()), pa.array(np.full(len(cut), piece, np.int32))],
                [f.split()[0] for f in SEGMENT_BYTES.split(", ")],
            )

    return task


def repeats_in_shard(segments: list[bytes], counts: np.ndarray, length: int) -> list[np.ndarray]:
    """Per segment the starts of its first `count` windows that occur elsewhere in the shard."""
    sizes = np.array([len(s) for s in segments], np.int64)
    begins = np.cumsum(sizes + 1) - sizes - 1
    with Scratch() as scratch:
        text = scratch.room(int((sizes + 1).sum()) + 1, np.uint16)
        text[:-1] = np.frombuffer(b"\0".join([*segments, b""]), np.uint8)
        text[:-1] += FIRST
        text[begins + sizes] = GAP
        text[-1] = END
        order, prefix = sorted_suffixes(text, 256 + FIRST, length, scratch)
    shares = prefix >= length
    shares[:-1] |= shares[1:]
    hit = np.sort(order[shares])
    low, high = np.searchsorted(hit, begins), np.searchsorted(hit, begins + counts)
    return [hit[a:b] - begin for a, b, begin in zip(low.tolist(), high.tolist(), begins.tolist(), strict=True)]


def windows_in_doubt(
    segments: list[bytes], fp: np.ndarray, counts: np.ndarray, length: int, piece: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(segment, first, number) of the runs of windows whose core is there more than once, by segment and first window.

    A window is placed by the first piece in it that hashes to the fingerprint of its segment: windows of up to `GRAIN`
    successive distances to that piece share the bytes from one place on, their core. Equal windows have equal distances,
    so their cores are equal and lie in different places.
    """
    grain = min(GRAIN, length - piece + 1)
    data = np.frombuffer(b"".join(segments), np.uint8)
    sizes = np.array([len(s) for s in segments], np.int64)
    begins = np.cumsum(sizes) - sizes
    fp = fp.astype(np.int64).view(np.uint64)
    hashes = fingerprint_of_pieces(piece_hashes(data, piece))
    anchors = np.flatnonzero(hashes == np.repeat(fp, sizes)[: len(hashes)])
    owner = np.repeat(np.arange(len(segments)), counts)
    ahead = np.cumsum(counts) - counts
    first = np.arange(len(owner)) - ahead[owner]
    window = begins[owner] + first
    core = window + (anchors[np.searchsorted(anchors, window)] - window) % grain
    # Cores rise with the windows. Segments of other fingerprints may hold the same bytes of a text, but no equal windows.
    fresh = np.append(True, core[1:] != core[:-1])
    hashes = piece_hashes(data, length - grain + 1)[core[fresh]] + fp[owner[fresh]]
    _, kind, times = np.unique(hashes, return_inverse=True, return_counts=True)
    kept = np.flatnonzero((times[kind] > 1)[np.cumsum(fresh) - 1])
    cut = np.append(True, (np.diff(kept) > 1) | (np.diff(owner[kept]) > 0))[: len(kept)]
    head = np.flatnonzero(cut)
    return owner[kept[head]], first[kept[head]], np.diff(np.append(head, len(kept)))


def spans(starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, number) of the runs of neighbouring starts."""
    if not len(starts):
        return starts, starts
    begin = np.append(0, np.flatnonzero(np.diff(starts) > 1) + 1)
    return starts[begin], np.diff(np.append(begin, len(starts)))


def shard_task(length: int):
    """A task over one shard to (fp, seg, found): the runs of repeated windows of each single segment."""

    @lean
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        segments = [s for b in held for s in b.column("bytes").to_pylist()]
        fp, seg, single, counts = (np.concatenate([np.asarray(b.column(c)) for b in held]) for c in ("fp", "seg", "single", "count"))
        piece = int(held[0].column("piece")[0].as_py())
        held.clear()
        owner, first, number = windows_in_doubt(segments, fp, counts, length, piece)
        ends = first + number + length - 1
        doubtful = [segments[i][a:b] for i, a, b in zip(owner.tolist(), first.tolist(), ends.tolist(), strict=True)]
        del segments
        if not doubtful:
            return
        found: dict[int, list[np.ndarray]] = {}
        for i, a, starts in zip(owner.tolist(), first.tolist(), repeats_in_shard(doubtful, number, length), strict=True):
            if single[i] and len(starts):
                found.setdefault(i, []).append(starts + a)
        at = list(found)
        runs = [spans(np.concatenate(found[i])) for i in at]
        bounds = np.cumsum([0, *[len(a) for a, _ in runs]])
        empty = [np.zeros(0, np.int64)]
        parts = pa.StructArray.from_arrays(
            [pa.array(np.concatenate([a for a, _ in runs] or empty)), pa.array(np.concatenate([n for _, n in runs] or empty))],
            ["start", "count"],
        )
        column = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), parts)
        yield pa.RecordBatch.from_arrays([pa.array(fp[at]), pa.array(seg[at]), column], ["fp", "seg", "found"])

    return task


PART = "array<struct<start:bigint,count:bigint>>"


def repeated_windows(docs: DataFrame, length: int = LENGTH, piece: int = PIECE) -> DataFrame:
    """(doc_id, tid, parts): per document the runs (first window, number) of windows that occur again.

    `docs` has (doc_id, tid, text) without null ids; tid tells texts of one id apart. Documents without such windows
    are absent.
    """
    spark = docs.sparkSession
    repeats = (F.count(F.lit(1)) > 1) | F.max("inner")
    found = repeated_segments(docs, byte_kernel(length, piece), repeats, "byte-segments", pack=True)
    if piece == length:
        # Whole windows: those that are there more than once.
        again = found.groupBy("fp", "seg").agg(F.sum(F.col("count") * F.size("starts")).alias("n")).filter("n > 1").select("fp", "seg")
        hit = found.join(staged(again, "byte-windows"), ["fp", "seg"])
        parts = F.transform("starts", lambda s: F.struct(s.alias("start"), F.col("count").alias("count")))
        return hit.select("doc_id", "tid", parts.alias("parts")).groupBy("doc_id", "tid").agg(F.flatten(F.collect_list("parts")).alias("parts"))
    place = F.struct("doc_id", "tid", F.element_at("starts", 1).alias("start"), "count")
    segments = staged(
        found.groupBy("fp", "seg").agg(F.min(place).alias("place"), F.sum(F.size("starts")).alias("copies"), F.max("inner").alias("inner")),
        "byte-distinct",
    )
    # A segment without a copy can share windows with others of its representative, or with itself.
    single = (F.col("copies") == 1).alias("single")
    n_bytes = F.col("place.count") + (length - 1)
    doubtful = segments.groupBy("fp").agg(
        F.min("copies").alias("least"), F.count(F.lit(1)).alias("n"), F.max("inner").alias("inner"), F.sum(n_bytes).alias("bytes")
    )
    doubtful = doubtful.filter("least = 1 and (n > 1 or inner)").select("fp", (F.col("bytes") > KEY_BYTES).alias("large"))
    wanted = staged(segments.join(staged(doubtful, "byte-keys"), "fp").select("fp", "seg", single, "place", "large"), "byte-doubtful")
    totals = {r["large"]: r["total"] for r in wanted.groupBy("large").agg(F.sum(n_bytes).alias("total")).collect()}
    shards = max(shuffle_width(spark), math.ceil(2 * totals.get(False, 0) / SHARD_BYTES))

    def bytes_of(chosen: DataFrame) -> DataFrame:
        parts = chosen.groupBy("place.doc_id", "place.tid").agg(
            F.collect_list(F.struct("fp", "seg", "place.start", "place.count", "single")).alias("parts")
        )
        texts = sifted(docs, parts, "maybe").filter("maybe").drop("maybe").join(parts, ["doc_id", "tid"])
        # Equal rows carry the same parts: one of them speaks for all.
        return texts.dropDuplicates(["doc_id", "tid"]).mapInArrow(
            part_bytes(length, piece), SEGMENT_BYTES
        )

    by_shard = bytes_of(wanted.filter("not large")).repartitionById(shards, F.pmod(F.col("fp"), F.lit(shards)).cast("int"))
    settled = by_shard.mapInArrow(shard_task(length), f"fp bigint, seg bigint, found {PART}")
    if True in totals:
        # Segments are the documents of the next round; their windows have equals among these segments alone.
        large = bytes_of(wanted.filter("large")).select(F.col("fp").alias("doc_id"), F.col("seg").alias("tid"), F.col("bytes").alias("text"))
        longer = repeated_windows(staged(large, "byte-large"), length, longer_piece(length, piece))
        settled = settled.unionByName(longer.select(F.col("doc_id").alias("fp"), F.col("tid").alias("seg"), F.col("parts").alias("found")))
    # Of the segments only those that lose something meet their copies.
    whole = F.array(F.struct(F.lit(0).cast("bigint").alias("start"), F.col("place.count").alias("count")))
    verdicts = segments.join(staged(settled, "byte-sorted"), ["fp", "seg"], "left").select(
        "fp", "seg", F.when(F.col("copies") > 1, whole).otherwise(F.col("found")).alias("found")
    )
    hit = found.join(staged(verdicts.filter("found is not null"), "byte-verdicts"), ["fp", "seg"])
    moved = F.transform(
        "starts", lambda s: F.transform("found", lambda p: F.struct((p["start"] + s).alias("start"), p["count"].alias("count")))
    )
    return (
        hit.select("doc_id", "tid", F.flatten(moved).alias("found"))
        .groupBy("doc_id", "tid")
        .agg(F.flatten(F.collect_list("found")).alias("parts"))
    )


def text_classes(docs: DataFrame, length: int) -> tuple[DataFrame, DataFrame]:
    """`docs` with `copies`, and (doc_id, tid, text) of one row of every text that is there more than once.

    `copies` is null for a text that is there once or is too short to lose anything. Texts are told apart by 128 bits.
    """
    long_enough = F.octet_length("text") >= length
    docs = docs.withColumn("tid2", F.xxhash64(F.lit(1), "text"))
    classes = docs.filter(long_enough).groupBy("tid", "tid2").agg(F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("least"))
    repeated = staged(classes.filter("copies > 1"), "text-classes")
    marked = docs.join(broadcast_if_small(repeated), ["tid", "tid2"], "left")
    first = marked.filter("copies is not null and doc_id = least").dropDuplicates(["tid", "tid2"]).select("doc_id", "tid", "text")
    # Four steps read these texts; none of them should shuffle and sort texts again beside its Python workers.
    return marked.drop("tid2", "least"), staged(first, "text-copies")


DIGEST = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"


def digests(length: int):
    """A task from (shown, text[, parts]) to one row per document: counts and the hash of the bytes kept."""

    @lean
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            parts = batch.column("parts").to_pylist() if "parts" in batch.schema.names else [None] * batch.num_rows
            gone, runs, sha = [], [], []
            for i, found in enumerate(parts):
                own = data[offsets[i] : offsets[i + 1]]
                if not found:
                    gone.append(0)
                    runs.append(0)
                    sha.append(hashlib.sha256(own.tobytes()).hexdigest())
                    continue
                drop = covered(found, len(own), length)
                gone.append(int(drop.sum()))
                runs.append(int(drop[:1].sum() + (drop[1:] & ~drop[:-1]).sum()))
                sha.append(hashlib.sha256(own[~drop].tobytes()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("shown"),
                    pa.array(np.diff(offsets)),
                    pa.array(gone, pa.int64()),
                    pa.array(runs, pa.int64()),
                    pa.array(sha, pa.string()),
                ],
                [f.split()[0] for f in DIGEST.split(", ")],
            )

    return task


def suffix_dedup_digest(documents: DataFrame, length: int = LENGTH) -> DataFrame:
    """One row per row of `documents`: n_bytes, n_removed, n_spans and the SHA-256 of the bytes kept.

    A null text is empty. Texts shorter than `length` lose nothing. Equal rows are copies of each other like any rows of
    equal text, and so are rows of one doc_id; a row without doc_id takes part and keeps its null. An empty table gives
    an empty result. Other columns are not looked at.
    """
    key = F.col("doc_id").cast("bigint")
    docs = documents.select(
        F.coalesce(key, F.lit(NO_ID)).alias("doc_id"), F.xxhash64("text").alias("tid"), F.col("text").alias("text"), key.alias("shown")
    )
    docs, copies = text_classes(docs, length)
    single = docs.filter("copies is null").select("doc_id", "tid", "text")
    found = staged(repeated_windows(single.unionByName(copies), length), "repeated-bytes")
    marked = sifted(docs.filter("copies is null"), found, "maybe")
    untouched = marked.filter("not maybe").select("shown", "text").mapInArrow(digests(length), DIGEST)
    touched = marked.filter("maybe").join(found, ["doc_id", "tid"], "left").select("shown", "text", "parts")
    # All of a text that is there twice starts elsewhere too.
    all_of_it = F.array(F.struct(F.lit(0).cast("bigint").alias("start"), (F.octet_length("text") - (length - 1)).cast("bigint").alias("count")))
    twice = docs.filter("copies is not null").select("shown", "text", all_of_it.alias("parts"))
    return untouched.unionByName(touched.unionByName(twice).mapInArrow(digests(length), DIGEST))

"""Periodic runs of words, found in tiles as wide as their periods and stitched per document and period.

A run of period q is a stretch in which words q apart are equal. Periods are taken by octaves [S, 2S). For one octave a
document is exploded into overlapping tiles, one around every S-th word, its boundary. Tiles are solved alone:

1. A period is a candidate of a tile if the S words from the boundary on equal those q further. A run that is long enough
   passes this test in every tile whose boundary lies inside it, early enough for S words to follow.
2. A candidate whose first q words are themselves a repetition belongs to a smaller period and goes.
3. The values of the Z-functions at the boundary, forwards over 2S words and backwards over S words, give the fragment of
   the run that lies in the tile.

Fragments that end inside their tile and are too short go at once. The others, merged within groups of neighbouring tiles,
are shuffled by document and period, and overlapping ones are stitched to runs. Candidates cost one comparison per word and
octave; what is shuffled follows the runs and not the texts.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.llm.arrays import hash_words, joined, slices, text_bytes, words
from ledgerflow.llm.frames import fresh_name, lean, staged
from ledgerflow.llm.segments import SLICE_BYTES, sifted
from ledgerflow.llm.substring_dedup import covered, cut_task

# A run has at least so many words and so many times its period.
LEAST = 6
FOLD = 4
# Neighbouring tiles whose fragments are merged before the shuffle, and compared words held at once.
TILES = 1024
COMPARED = 1 << 20
# The id of a row without one, inside the job.
NO_ID = -(2**63)

Batches = Iterator[pa.RecordBatch]
Rewrite = Callable[[Batches], Batches]


def smallest_factors(n: int) -> np.ndarray:
    """Smallest prime factor of every number below `n`; 1 for 0 and 1."""
    factor = np.arange(n)
    factor[:2] = 1
    for p in range(2, int(n**0.5) + 1):
        if factor[p] == p:
            multiples = factor[p * p :: p]
            multiples[multiples == np.arange(p * p, n, p)] = p
    return factor


def primitive(scale: int, whole: np.ndarray, half: np.ndarray, at: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Whether the `period` words at `at` are no repetition of fewer words.

    `whole` and `half` are hashes of the `scale` and `scale` / 2 words from every position on; a stretch of any length
    between is covered by two of them.
    """
    result = np.ones(len(at), bool)
    if scale == 1:
        return result
    factors = smallest_factors(2 * scale)
    rest = period.copy()
    while (live := np.flatnonzero(result & (rest > 1))).size:
        prime = factors[rest[live]]
        rest[live] //= prime
        c, q = at[live], period[live]
        d = q // prime
        same = np.zeros(len(live), bool)
        for hashes, size, here in ((whole, scale, q - d >= scale), (half, scale // 2, q - d < scale)):
            a, shift, last = c[here], d[here], (c + q - d - size)[here]
            same[here] = (hashes[a] == hashes[a + shift]) & (hashes[last] == hashes[last + shift])
        result[live[same]] = False
    return result


def reach(codes: np.ndarray, at: np.ndarray, period: np.ndarray, back: np.ndarray, ahead: np.ndarray, scale: int) -> tuple:
    """Values of the two Z-functions at boundaries `at`: equal words before and from there on, within the tile.

    `back` and `ahead` bound them by the document.
    """
    before, after = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
    step = max(1, COMPARED // (3 * scale))
    ahead_of, back_of = np.arange(2 * scale), np.arange(1, scale + 1)
    for first in range(0, len(at), step):
        part = slice(first, first + step)
        for offsets, bound, out in ((ahead_of, ahead, after), (-back_of, back, before)):
            inside = np.arange(len(offsets)) < bound[part, None]
            place = np.where(inside, at[part, None] + offsets, 0)
            equal = (codes[place] == codes[np.where(inside, place + period[part, None], 0)]) & inside
            out[part] = np.where(equal.all(axis=1), len(offsets), equal.argmin(axis=1))
    return before, after


def merged(doc: np.ndarray, period: np.ndarray, group: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple:
    """Overlapping intervals of one document, period and group of tiles as one."""
    order = np.lexsort((low, group, period, doc))
    doc, period, group, low, high = (x[order] for x in (doc, period, group, low, high))
    fresh = np.ones(len(doc), bool)
    # Tiles of one run follow each other, and each reaches the next.
    fresh[1:] = (doc[1:] != doc[:-1]) | (period[1:] != period[:-1]) | (group[1:] != group[:-1]) | (low[1:] > high[:-1])
    begin = np.flatnonzero(fresh)
    return doc[begin], period[begin], low[begin], np.maximum.reduceat(high, begin) if len(begin) else high


def fragments(codes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, ...]:
    """(document, period, low, high): words low to high - 1 of the document equal those `period` further.

    `codes` are the words of all documents, those of document d begin at `first[d]`.
    """
    found = []
    docs = np.arange(len(first) - 1)
    scale, half = 1, codes
    whole = codes
    while True:
        lengths = np.diff(first)
        live = lengths >= max(FOLD * scale, LEAST)
        if not live.any():
            break
        if 2 * int(lengths[live].sum()) < len(codes):
            # Few documents are long enough for the longer periods: go on with those alone.
            keep = np.repeat(live, lengths)
            pad = np.zeros(len(codes) - len(whole), np.uint64)
            whole, half = np.append(whole, pad)[keep], np.append(half, np.zeros(len(codes) - len(half), np.uint64))[keep]
            codes, docs = codes[keep], docs[live]
            first = np.append(0, np.cumsum(lengths[live]))
            lengths = np.diff(first)
            whole, half = whole[: len(codes) - scale + 1], half[: len(codes) - scale // 2 + 1]
        local = np.arange(len(whole)) - np.repeat(first[:-1], lengths)[: len(whole)]
        room = np.repeat(lengths, lengths)[: len(whole)] - local
        shift = local % scale + scale
        place = np.arange(len(whole))
        hit = np.flatnonzero((local >= scale) & (room >= scale) & (whole == whole[np.maximum(place - shift, 0)]))
        if len(hit):
            period = shift[hit]
            at, behind, left = hit - period, local[hit] - period, room[hit]
            own = primitive(scale, whole, half, at, period)
            at, period, behind, left = at[own], period[own], behind[own], left[own]
            before, after = reach(codes, at, period, behind, left, scale)
            # Open at an edge of the tile, or long enough as it is.
            open_end = (after == 2 * scale) & (left > 2 * scale) | (before == scale) & (behind > scale)
            good = open_end | (before + after + period >= np.maximum(LEAST, FOLD * period))
            low, high, owner = behind - before, behind + after, np.searchsorted(first, at, "right") - 1
            at_tile = behind // (scale * TILES)
            found.append(merged(docs[owner[good]], period[good], at_tile[good], low[good], high[good]))
        if len(whole) <= scale:
            break
        half, whole = whole, joined(whole[:-scale], whole[scale:])
        scale *= 2
    if not found:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


FRAGMENTS = "doc_id bigint, tid bigint, period bigint, low bigint, high bigint"


def solved(rewrite: Rewrite | None) -> Callable[[Batches], Batches]:
    """A task from (doc_id, tid, text) to the fragments of its texts."""

    @lean
    def task(batches: Batches) -> Batches:
        for batch in rewrite(batches) if rewrite else batches:
            data, offsets = text_bytes(batch.column("text"))
            for low, high in slices(offsets, SLICE_BYTES):
                here = data[offsets[low] : offsets[high]]
                starts, ends, first = words(here, offsets[low : high + 1] - offsets[low])
                doc, *spans = fragments(hash_words(here, starts, ends), first)
                rows = batch.slice(low, high - low).select(["doc_id", "tid"]).take(pa.array(doc))
                yield pa.RecordBatch.from_arrays([*rows.columns, *map(pa.array, spans)], [f.split()[0] for f in FRAGMENTS.split(", ")])

    return task


def identified(documents: DataFrame) -> DataFrame:
    """(doc_id, tid, text, shown): tid tells texts of one id apart, shown is the id as it was."""
    key = F.col("doc_id").cast("bigint")
    return documents.select(
        F.coalesce(key, F.lit(NO_ID)).alias("doc_id"), F.xxhash64("text").alias("tid"), F.col("text").alias("text"), key.alias("shown")
    )


RUNS = "array<struct<start:bigint,period:bigint,length:bigint>>"


def periodic_runs(docs: DataFrame, rewrite: Rewrite | None = None) -> DataFrame:
    """(doc_id, tid, runs): per document its runs by start, then period. Documents without a run are absent.

    `docs` is what `identified` returns. `rewrite` changes batches inside a task before they are read.
    """
    parts = docs.mapInArrow(solved(rewrite), FRAGMENTS)
    key = ["doc_id", "tid", "period"]
    order = Window.partitionBy(*key).orderBy("low", "high")
    reached = F.max("high").over(order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.when(F.col("low") <= reached, 0).otherwise(1)
    stretches = (
        parts.withColumn("fresh", fresh)
        .withColumn("run", F.sum("fresh").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*key, "run")
        .agg(F.min("low").alias("start"), F.max("high").alias("high"))
        .withColumn("length", F.col("high") - F.col("start") + F.col("period"))
    )
    long_enough = stretches.filter(F.col("length") >= F.greatest(F.lit(LEAST), FOLD * F.col("period")))
    runs = F.array_sort(F.collect_list(F.struct("start", "period", "length")))
    return long_enough.groupBy("doc_id", "tid").agg(runs.alias("runs"))


def dropped(runs: list[dict]) -> list[dict]:
    """What goes of each run: all but its first period."""
    return [{"start": r["start"] + r["period"], "count": r["length"] - r["period"]} for r in runs]


DIGEST = (
    "doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, "
    "runs_sha256 string, collapsed_sha256 string"
)


def digests(rewrite: Rewrite | None) -> Callable[[Batches], Batches]:
    """A task from (shown, text[, runs]) to the digest of every row."""

    def digest(raw: bytes, runs: list[dict]) -> tuple:
        kept = raw.split()
        if not runs:
            return 0, None, None, None, None, hashlib.sha256(b"").hexdigest(), hashlib.sha256(b" ".join(kept)).hexdigest()
        keep = ~covered(dropped(runs), len(kept), 1)
        kept = [w for w, stays in zip(kept, keep.tolist(), strict=True) if stays]
        start, negative, period = max((r["length"], -r["start"], -r["period"]) for r in runs)
        longest = (-negative, start, -period)
        lines = "".join(f"{r['start']},{r['length']},{r['period']}\n" for r in runs)
        return (
            len(runs),
            *longest,
            1000 * longest[1] // longest[2],
            hashlib.sha256(lines.encode()).hexdigest(),
            hashlib.sha256(b" ".join(kept)).hexdigest(),
        )

    @lean
    def task(batches: Batches) -> Batches:
        for batch in rewrite(batches) if rewrite else batches:
            runs = batch.column("runs").to_pylist() if "runs" in batch.schema.names else [None] * batch.num_rows
            data, offsets = text_bytes(batch.column("text"))
            rows = [digest(data[offsets[i] : offsets[i + 1]].tobytes(), r or []) for i, r in enumerate(runs)]
            columns = list(zip(*rows, strict=True)) or [()] * 7
            types = [pa.int64()] * 5 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays(
                [batch.column("shown"), *[pa.array(c, t) for c, t in zip(columns, types, strict=True)]],
                [f.split()[0] for f in DIGEST.split(", ")],
            )

    return task


def repeated_tail(doc_id: int | None, raw: bytes) -> bytes | None:
    """The text whose last words repeat, as the id decides; None where it stays as it is."""
    if doc_id is None:
        return None
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    kept = raw.split() if h % 10 == 0 else []
    if not kept:
        return None
    a = g % len(kept)
    rest = len(kept) - a
    period = 1 + rest // (3 + g % 8)
    return b" ".join(kept[:a] + (kept[a : a + period] * (-(-rest // period)))[:rest])


def with_repeated_tails(batches: Batches) -> Batches:
    """Batches of (shown, text, ...) with the planted repetitions of the query."""
    for batch in batches:
        data, offsets = text_bytes(batch.column("text"))
        ids = batch.column("shown").to_pylist()
        chosen = {
            i: new
            for i, doc_id in enumerate(ids)
            if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 10 == 0
            and (new := repeated_tail(doc_id, data[offsets[i] : offsets[i + 1]].tobytes())) is not None
        }
        if chosen:
            texts = [chosen.get(i, t) for i, t in enumerate(batch.column("text").cast(pa.binary()).to_pylist())]
            at = batch.schema.names.index("text")
            batch = batch.set_column(at, "text", pa.array(texts, pa.binary()).cast(pa.string()))
        yield batch


def periodic_digest(documents: DataFrame, rewrite: Rewrite | None = with_repeated_tails) -> DataFrame:
    """One row per row of `documents`: number of runs, the longest of them, and SHA-256 of all runs and of the kept words.

    A null or blank text has no words and no run. Rows that share a doc_id are judged alone, each by its own text; equal
    rows give equal results. A row without doc_id is searched as it is and keeps its null. An empty table gives an empty
    result. Other columns are not looked at. A document is solved by the task that reads it.
    """
    docs = identified(documents)
    runs = staged(periodic_runs(docs, rewrite), "periodic-runs")
    marked = sifted(docs, runs, "maybe")
    untouched = marked.filter("not maybe").select("shown", "text").mapInArrow(digests(rewrite), DIGEST)
    touched = marked.filter("maybe").join(runs, ["doc_id", "tid"], "left").select("shown", "text", "runs")
    return untouched.unionByName(touched.mapInArrow(digests(rewrite), DIGEST))


def collapsed(documents: DataFrame) -> DataFrame:
    """`documents` with every run cut down to its first period, spacing elsewhere unchanged; all columns and rows stay.

    Null, blank and short texts stay as they are.
    """
    key, text_key, runs, flag = (fresh_name(documents, f"_runs_{c}") for c in ("id", "tid", "runs", "flag"))
    found = staged(periodic_runs(identified(documents)), "periodic-runs")
    own = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID))
    marked = sifted(documents.withColumn(key, own), found.withColumnRenamed("doc_id", key), flag, key)
    cut = cut_task(1)

    @F.arrow_udf("string")
    def without(texts: pa.Array, lists: pa.Array) -> pa.Array:
        return pa.array(cut(texts.to_pylist(), [None if r is None else dropped(r) for r in lists.to_pylist()]), pa.string())

    found = found.select(F.col("doc_id").alias(key), F.col("tid").alias(text_key), F.col("runs").alias(runs))
    met = marked.filter(flag).withColumn(text_key, F.xxhash64("text")).join(found, [key, text_key], "left")
    shorter = met.withColumn("text", F.when(F.col(runs).isNull(), F.col("text")).otherwise(without("text", runs)))
    columns = [F.col(f"`{c}`") for c in documents.columns]
    return marked.filter(~F.col(flag)).select(*columns).unionByName(shorter.select(*columns))

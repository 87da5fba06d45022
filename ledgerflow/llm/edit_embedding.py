"""Fingerprints of documents by a randomised edit embedding, and near copies by banding them.

A text is read by a walk that shares its random bits with the walks over all other texts: at output place j it notes the
character it stands on and moves on if the bit of (j, character) is 1. After an edit two walks meet again soon, so few edits
leave most places of the output equal: edit distance becomes Hamming distance. Of the output only places chosen once for
all are kept, 64 in [0, 64) and 64 in every [64 * 2^k, 128 * 2^k), so texts of any lengths are compared place by place.

A kept place is one sign: a hash of the three characters from the walk's place on, or the first sign of the alphabet where
the walk has ended. Likeness is the share of equal places, each counted by the stretch of output it stands for.

Near copies: bands of a few kept places each bring texts together, and whole fingerprints decide.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.arrays import joined, mixed
from ledgerflow.llm.components import components, smallest_reachable, with_component
from ledgerflow.llm.frames import documents_of, in_groups, lean, plan_bytes, shuffle_width, staged

# Random bits repeat after so many places of the output; characters are told apart as so many classes.
PERIOD = 4096
CLASSES = 256
# Kept places per octave, and octaves at most (2^40 places).
KEPT = 64
OCTAVES = 35
# Signs of a fingerprint; the first stands for the end of the walk.
SIGNS = "-0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ_abcdefghijklmnopqrstuvwxyz"
# Bands, and kept places in each.
BANDS = 24
BAND_PLACES = 4
# Texts of one bucket that a tile compares with those of another.
TILE = 256
LIKENESS = 0.8
# Bytes of text a sorted range should hold.
RANGE_BYTES = 128 << 20
ROWS = 256

SIGN_BYTES = np.frombuffer(SIGNS.encode(), np.uint8)
SIGN_NUMBER = np.zeros(256, np.uint8)
SIGN_NUMBER[SIGN_BYTES] = np.arange(len(SIGNS))


@cache
def steps() -> list[bytes]:
    """Per class of characters and place of the output (modulo the period): places until the walk has moved on."""
    bits = mixed(np.arange(CLASSES * PERIOD, dtype=np.uint64) + np.uint64(0x5EED)).reshape(CLASSES, PERIOD) & np.uint64(1)
    result = np.zeros((CLASSES, PERIOD), np.uint8)
    ahead = np.zeros(CLASSES, np.uint8)
    for place in [*range(PERIOD - 1, -1, -1)] * 2:
        ahead = np.where(bits[:, place] == 1, 1, ahead + 1).astype(np.uint8)
        result[:, place] = ahead
    return [row.tobytes() for row in result]


@cache
def places() -> np.ndarray:
    """Kept places of the output, rising: one in each of `KEPT` equal parts of an octave."""
    result = [np.arange(KEPT)]
    for octave in range(OCTAVES - 1):
        part = 1 << octave
        jitter = (mixed(np.arange(KEPT, dtype=np.uint64) + np.uint64((octave + 1) << 20)) % np.uint64(part)).astype(np.int64)
        result.append(KEPT * part + np.arange(KEPT) * part + jitter)
    return np.concatenate(result)


def weights(n: int) -> np.ndarray:
    """Stretch of output that each of the first `n` kept places stands for."""
    return 2.0 ** np.maximum(np.arange(n) // KEPT - 1, 0)


def characters(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), np.uint32)


def classes_of(chars: np.ndarray) -> bytes:
    return (mixed(chars.astype(np.uint64)) % np.uint64(CLASSES)).astype(np.uint8).tobytes() if len(chars) else b""


def walk(chars: np.ndarray, begin: int = 0) -> np.ndarray:
    """Place of the output at which the walk arrives on every character, and at last at the end."""
    step, mask = steps(), PERIOD - 1
    moves = accumulate(classes_of(chars), lambda j, c: j + step[c][j & mask], initial=begin)
    return np.fromiter(moves, np.int64, len(chars) + 1)


def signs(chars: np.ndarray, arrived: np.ndarray) -> np.ndarray:
    """The kept places as numbers of signs: whole octaves, up to the one in which the walk ends."""
    at = places()
    octaves = 1 if arrived[-1] <= KEPT else 1 + math.ceil(math.log2(arrived[-1] / KEPT))
    at = at[: octaves * KEPT]
    result = np.zeros(len(at), np.uint8)
    live = int(np.searchsorted(at, arrived[-1]))
    if live:
        here = np.searchsorted(arrived, at[:live], "right") - 1
        padded = np.append(chars, np.zeros(2, np.uint32)).astype(np.uint64)
        seen = joined(joined(padded[here], padded[here + 1]), padded[here + 2])
        value = joined(seen, at[:live].astype(np.uint64)) >> np.uint64(20)
        result[:live] = (value % np.uint64(len(SIGNS) - 1)).astype(np.uint8) + 1
    return result


def fingerprint_of(text: str | None) -> np.ndarray:
    chars = characters(text)
    return signs(chars, walk(chars))


def written(fingerprint: np.ndarray) -> str:
    return SIGN_BYTES[fingerprint].tobytes().decode()


def read(fingerprint: str) -> np.ndarray:
    return SIGN_NUMBER[np.frombuffer(fingerprint.encode(), np.uint8)]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of the output that is equal, of the longer walk; 1 for two empty texts."""
    n = max(len(a), len(b))
    a, b = np.pad(a, (0, n - len(a))), np.pad(b, (0, n - len(b)))
    w = weights(n)
    there = float(w[(a > 0) | (b > 0)].sum())
    return float(w[(a > 0) & (a == b)].sum()) / there if there else 1.0


def band_keys(fingerprint: np.ndarray) -> np.ndarray:
    """64-bit keys of the bands: a few places of the last two octaves that are full enough, chosen once per octave.

    A walk that ends soon after the beginning of an octave is also banded as one that ends before, and the other way
    round, so near copies of slightly different lengths share an octave.
    """
    octaves = len(fingerprint) // KEPT
    last = fingerprint[-KEPT:] > 0
    full = int(last.sum())
    tops = {octaves - 1}
    if octaves > 1 and full < KEPT // 2:
        tops.add(octaves - 2)
    keys = []
    for top in sorted(tops):
        low = max(0, top - 1) * KEPT
        span = 2 * KEPT if top else KEPT
        chosen = mixed(np.arange(BANDS * BAND_PLACES, dtype=np.uint64) + np.uint64((top + 1) << 32)) % np.uint64(span)
        # In a half-empty octave only its filled places are compared; they decide like those of the octave before.
        picked = fingerprint[low : low + span][chosen.astype(np.int64)].reshape(BANDS, BAND_PLACES).astype(np.uint64)
        key = np.arange(BANDS, dtype=np.uint64) + np.uint64((top + 1) << 8)
        for place in range(BAND_PLACES):
            key = joined(key, picked[:, place])
        keys.append(key[(picked > 0).any(axis=1)])
    return np.concatenate(keys)


# Fingerprints beside an edited text and the next document


class Walked:
    """A document with its walk."""

    def __init__(self, doc_id: int | None, text: str | None) -> None:
        self.doc_id, self.text = doc_id, text or ""
        self.chars = characters(text)
        self.arrived = walk(self.chars)
        self.fingerprint = signs(self.chars, self.arrived)

    def beside(self, following: Walked) -> tuple:
        """The row of this document: the edited text shares the walk up to the edit."""
        n = len(self.chars)
        kept = n - n // 3
        tail = following.chars[: n // 3]
        chars = np.append(self.chars[:kept], tail)
        arrived = np.append(self.arrived[:kept], walk(tail, int(self.arrived[kept])))
        edited = signs(chars, arrived)
        text = self.text[:kept] + following.text[: n // 3]
        own, changed, after = (set(band_keys(f).tolist()) for f in (self.fingerprint, edited, following.fingerprint))
        return (
            self.doc_id,
            n,
            hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest(),
            written(self.fingerprint),
            written(edited),
            likeness(self.fingerprint, edited),
            likeness(self.fingerprint, following.fingerprint),
            len(own & changed),
            len(own & after),
        )


DIGEST = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, bands_edited bigint, bands_next bigint"
)
DIGEST_TYPES = [pa.int64(), pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2, pa.int64(), pa.int64()]


@lean
def beside_next(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one sorted range, and after them the first of the next range: one row of `DIGEST` per own document."""
    names = [f.split()[0] for f in DIGEST.split(", ")]
    before: Walked | None = None
    over = False
    for batch in batches:
        for first in range(0, batch.num_rows, ROWS):
            part, rows = batch.slice(first, ROWS), []
            for doc_id, text, guest in zip(*(part.column(c).to_pylist() for c in ("doc_id", "text", "guest")), strict=True):
                if over:
                    break
                here = Walked(doc_id, text)
                if before is not None:
                    rows.append(before.beside(here))
                before, over = here, guest
            columns = zip(zip(*rows, strict=True), DIGEST_TYPES, strict=True) if rows else ()
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in columns], names)


class Ranges:
    """Ranges of falling ids, a last one for rows without an id."""

    def __init__(self, cuts: list[float]) -> None:
        self.cuts = np.array(sorted(set(cuts)), np.float64)

    def __len__(self) -> int:
        return len(self.cuts) + 2

    def of(self, ids: pa.Array) -> np.ndarray:
        values = np.asarray(ids.fill_null(0)).astype(np.float64)
        number = len(self.cuts) - np.searchsorted(self.cuts, values, "right")
        return np.where(np.asarray(ids.is_valid()), number, len(self.cuts) + 1).astype(np.int32)


def fingerprint_digest(documents: DataFrame) -> DataFrame:
    """One row per row of `documents`: its fingerprint, that of its edited text, and how near that and the next one are.

    The next document is the one with the next smaller doc_id; rows of one doc_id follow each other by their texts' bytes,
    rows without doc_id come after all others, and after the last row comes the first. The edited text has its last third
    replaced by the beginning of the next document. A null text is empty; a single row follows itself. Equal rows give
    rows that differ only in what follows them. An empty table gives an empty result. Other columns are not looked at.

    Rows are sorted in ranges of ids, and a range also gets the first document of the next, so texts are shuffled once.
    The driver holds two numbers per range. Rows of one doc_id lie in one range.
    """
    spark = documents.sparkSession
    docs = documents_of(documents).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    wanted = max(shuffle_width(spark), math.ceil(plan_bytes(docs, "text") / RANGE_BYTES))
    ids = docs.select("doc_id")
    ranges = Ranges(ids.approxQuantile("doc_id", [i / wanted for i in range(1, wanted)], 1 / (4 * wanted)))

    @F.arrow_udf("int")
    def range_of(keys: pa.Array) -> pa.Array:
        return pa.array(ranges.of(keys))

    # The first id of every range that has rows, by falling ids.
    first_of = dict(ids.groupBy(range_of("doc_id").alias("range")).agg(F.max("doc_id")).collect())
    used = sorted(first_of)
    if not used:
        return spark.createDataFrame([], DIGEST)
    before = dict(zip(used, [used[-1], *used[:-1]], strict=True))
    shared = spark.sparkContext.broadcast((ranges, first_of, before))

    @lean
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranges, first_of, before = shared.value
        for batch in batches:
            number = ranges.of(batch.column("doc_id"))
            own = batch.column("doc_id").to_pylist()
            leads = np.flatnonzero([i == first_of[r] for i, r in zip(own, number.tolist(), strict=True)])
            yield pa.RecordBatch.from_arrays([pa.array(number), pa.array(np.zeros(len(number), bool)), *batch.columns], ["range", "guest", "doc_id", "text"])
            if len(leads):
                guests = batch.take(pa.array(leads))
                at = pa.array([before[r] for r in number[leads].tolist()], pa.int32())
                yield pa.RecordBatch.from_arrays([at, pa.array(np.ones(len(leads), bool)), *guests.columns], ["range", "guest", "doc_id", "text"])

    return (
        docs.mapInArrow(deal, "range int, guest boolean, doc_id bigint, text string")
        .repartitionById(len(ranges), "range")
        .sortWithinPartitions("guest", F.desc_nulls_last("doc_id"), "text")
        .mapInArrow(beside_next, DIGEST)
    )


# Near copies


def fingerprints(documents: DataFrame) -> DataFrame:
    """(doc_id, fingerprint, keys) of every row; a null text is empty. `keys` are those of its bands."""

    @lean
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint_of(t) for t in batch.column("text").to_pylist()]
            keys = [band_keys(f).view(np.int64).tolist() for f in found]
            columns = [batch.column("doc_id"), pa.array(map(written, found), pa.string()), pa.array(keys, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "fingerprint", "keys"])

    return documents_of(documents).mapInArrow(task, "doc_id bigint, fingerprint string, keys array<bigint>")


def tile_links(rows: pa.RecordBatch, least: float) -> tuple[np.ndarray, np.ndarray] | None:
    """(node, smallest node it reaches) over the pairs of one tile that are alike enough."""
    order = np.argsort(np.asarray(rows.column("node")), kind="stable")
    node = np.asarray(rows.column("node"))[order]
    found = [read(f) for f in rows.column("fingerprint").take(pa.array(order)).to_pylist()]
    n = max(map(len, found))
    table = np.stack([np.pad(f, (0, n - len(f))) for f in found])
    w = weights(n)
    equal, there = np.zeros((len(node), len(node))), np.zeros((len(node), len(node)))
    for place in range(n):
        column = table[:, place]
        some = column > 0
        equal += w[place] * ((column[:, None] == column) & some)
        there += w[place] * (some[:, None] | some)
    a, b = np.nonzero(np.triu(equal >= least * there, 1))
    if not len(a):
        return None
    label = smallest_reachable(a, b, len(node))
    used = np.union1d(a, b)
    return node[used], node[label[used]]


def near_texts(documents: DataFrame, least: float = LIKENESS) -> DataFrame:
    """One row per row of `documents`: doc_id, component_id (smallest doc_id reached over texts alike enough), kept.

    Texts of equal fingerprints are one class. Classes that share a band are compared in tiles, so a bucket of any size is
    compared whole and no pair is handed on, only links to the smallest member. Empty texts are alike. A null doc_id has a
    null component and is kept. An empty table gives an empty result. Other columns are not looked at.
    """
    spark = documents.sparkSession
    prints = staged(fingerprints(documents), "edit-fingerprints")
    known = prints.filter("doc_id is not null")
    classes = staged(known.groupBy("fingerprint").agg(F.min("doc_id").alias("node"), F.first("keys").alias("keys")), "edit-classes")
    spots = classes.select("node", "fingerprint", F.explode(F.array_distinct("keys")).alias("key"))
    crowded = spots.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    tiles = F.ceil(F.col("n") / TILE)
    last = tiles - 1
    dealt = spots.join(crowded, "key").select(
        "key", "node", "fingerprint", F.pmod(F.xxhash64("node"), tiles).alias("tile"), F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("other")
    )
    groups = ["key", "low", "high"]
    dealt = dealt.select("key", "node", "fingerprint", F.least("tile", "other").alias("low"), F.greatest("tile", "other").alias("high"))

    @lean
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in in_groups(batches, groups):
            found = tile_links(rows, least) if rows.num_rows > 1 else None
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in found], ["u", "v"])

    links = dealt.repartition(shuffle_width(spark), *groups).sortWithinPartitions(*groups).mapInArrow(compare, "u bigint, v bigint")
    # One id may hold several texts: they are one node, and so are the documents of one class.
    links = staged(links, "edit-links").unionByName(known.join(classes.select("fingerprint", "node"), "fingerprint").select(F.col("doc_id").alias("u"), F.col("node").alias("v")))
    found = staged(components(links), "edit-components")
    own = F.col("doc_id")
    rows = with_component(prints.select("doc_id"), found, "doc_id", "component_id")
    return rows.withColumn("kept", F.coalesce(own == F.col("component_id"), F.lit(True)))

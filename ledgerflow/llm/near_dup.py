"""Near-duplicate documents by HyperMinHash: compressed registers, banding, estimates, then exact sets.

A document is its set of word shingles. One hash per shingle picks one of 128 registers and offers the rest of its bits;
a register keeps the smallest offer as its count of leading zeros and ten mantissa bits. Bands of four registers are
bucket keys. Documents of one bucket are candidates; their estimated similarity, corrected for registers that agree by
chance, drops the hopeless ones, and the rest is confirmed on the full sets.

No bucket is expanded into its pairs. Documents with equal sets are one class. Then every document is compared with the
smallest promising member of its buckets, which ties most groups together; only members of buckets that still hold several
components are compared further, in tiles of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.arrays import TO_LOWER, hash_runs, hash_words, mixed, slices, text_bytes, words
from ledgerflow.llm.components import components, smallest_reachable, with_component
from ledgerflow.llm.frames import documents_of, fresh_name, in_groups, lean, shuffle_width, signed, staged
from ledgerflow.llm.segments import sifted

REGISTERS = 128
BAND = 4
MANTISSA_BITS = 10
# Buckets of at most so many members are compared pair by pair, larger ones in tiles.
SMALL_BUCKET = 32
# Members of a tile, and shingles whose occurrences are multiplied at a time.
TILE = 256
BLOCK_COLUMNS = 8192
# Candidates are dropped below the threshold minus so many standard errors of the estimate.
ERRORS = 4.5
SLICE_BYTES = 1 << 20


@dataclass(frozen=True)
class Rule:
    """Shingles of `size` words; a link needs 100 * intersection >= `percent` * union."""

    size: int = 5
    percent: int = 80


@cache
def donors() -> np.ndarray:
    """For every register the order in which it asks the others for a value while it is empty."""
    order = np.argsort(mixed(np.arange(REGISTERS * REGISTERS, dtype=np.uint64)).reshape(REGISTERS, REGISTERS), axis=1)
    return order.astype(np.int16)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text, A-Z lowered."""
    data = TO_LOWER[data]
    starts, ends, first = words(data, offsets)
    hashes = hash_words(data, starts, ends)
    runs = hash_runs(hashes, size)
    result = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= size:
            found = np.sort(runs[a : b - size + 1])
            fresh = np.ones(len(found), bool)
            fresh[1:] = found[1:] != found[:-1]
            result.append(found[fresh])
        else:
            result.append(hash_runs(hashes[a:b], b - a) if b > a else runs[:0])
    return result


def registers_of(sets: list[np.ndarray]) -> np.ndarray:
    """(sets, REGISTERS) of 16-bit registers; rows of empty sets are meaningless."""
    n = np.array([len(s) for s in sets], np.int64)
    offers = np.full((len(sets), REGISTERS), np.iinfo(np.uint64).max, np.uint64)
    if n.sum():
        hashes = mixed(np.concatenate(sets))
        bits = np.uint64(REGISTERS.bit_length() - 1)
        place = np.repeat(np.arange(len(sets)) * REGISTERS, n) + (hashes >> (np.uint64(64) - bits)).astype(np.int64)
        np.minimum.at(offers.reshape(-1), place, hashes << bits)
    zeros = np.minimum(63 - np.frexp(offers.astype(np.float64))[1] + 1, 63).clip(0)
    shifted = (offers << zeros.astype(np.uint64)) << np.uint64(1)
    packed = (zeros.astype(np.uint64) << np.uint64(MANTISSA_BITS)) | (shifted >> np.uint64(64 - MANTISSA_BITS))
    packed = packed.astype(np.uint16)
    # An empty register takes the value of the first filled one in its own order, so all registers can be compared.
    empty = offers == np.iinfo(np.uint64).max
    rows, columns = np.nonzero(empty & (n > 0)[:, None])
    for attempt in range(REGISTERS):
        if not len(rows):
            break
        donor = donors()[columns, attempt]
        filled = ~empty[rows, donor]
        packed[rows[filled], columns[filled]] = packed[rows[filled], donor[filled]]
        rows, columns = rows[~filled], columns[~filled]
    return packed


@cache
def chance(left: int, right: int) -> float:
    """Probability that a register of two unrelated sets agrees, from the sizes of the sets as powers of two."""
    zeros = np.arange(64)[:, None]
    steps = np.arange(1 << MANTISSA_BITS)[None, :]
    low = np.exp2(-(zeros + 1.0)) * (1 + steps / (1 << MANTISSA_BITS))
    high = low + np.exp2(-(zeros + 1.0 + MANTISSA_BITS))

    def mass(size: int) -> np.ndarray:
        k = max(1.0, 2.0**size / REGISTERS)
        return np.exp(k * np.log1p(-np.minimum(low, 1 - 1e-12))) - np.exp(k * np.log1p(-np.minimum(high, 1 - 1e-12)))

    return float((mass(left) * mass(right)).sum())


def estimates(left: np.ndarray, right: np.ndarray, n_left: np.ndarray, n_right: np.ndarray) -> np.ndarray:
    """Similarity of pairs of register rows, corrected for agreement by chance."""
    agree = (left == right).mean(axis=1)
    a = np.log2(np.maximum(n_left, 1)).astype(int)
    b = np.log2(np.maximum(n_right, 1)).astype(int)
    by_chance = np.array([chance(*p) for p in zip(a.tolist(), b.tolist(), strict=True)])
    return (agree - by_chance) / (1 - by_chance)


def hopeful(left: np.ndarray, right: np.ndarray, n_left: np.ndarray, n_right: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs can be similar: by their sizes, which is exact, and by the estimate where sets fill the registers."""
    least, most = np.minimum(n_left, n_right), np.maximum(n_left, n_right)
    possible = 100 * least >= percent * most
    bar = percent / 100
    bar -= ERRORS * np.sqrt(bar * (1 - bar) / REGISTERS)
    return possible & ((estimates(left, right, n_left, n_right) >= bar) | (least < REGISTERS))


def signatures(docs: DataFrame, rule: Rule) -> DataFrame:
    """(doc_id, n_shingles, k1, k2, registers): set size, 128-bit key of the set, and registers (null if empty)."""

    @lean
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            for low, high in slices(offsets, SLICE_BYTES):
                sets = shingle_sets(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low], rule.size)
                n = np.array([len(s) for s in sets], np.int64)
                registers = registers_of(sets)
                keys = np.zeros((2, len(sets)), np.uint64)
                if n.sum():
                    hashes, filled = np.concatenate(sets), np.flatnonzero(n)
                    begin = (np.cumsum(n) - n)[filled]
                    for i, salt in enumerate((0x8CB92BA72F3D8DD7, 0xAAF8B3C1D5E7F901)):
                        keys[i, filled] = np.add.reduceat(mixed(hashes ^ np.uint64(salt)), begin)
                packed = [r.tobytes() if k else None for r, k in zip(registers, n.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(low, high - low), pa.array(n), signed(keys[0]), signed(keys[1]), pa.array(packed, pa.binary())],
                    ["doc_id", "n_shingles", "k1", "k2", "registers"],
                )

    return docs.mapInArrow(task, "doc_id bigint, n_shingles bigint, k1 bigint, k2 bigint, registers binary")


def register_matrix(column: pa.Array) -> np.ndarray:
    data, offsets = text_bytes(column)
    return data.view(np.uint16).reshape(len(offsets) - 1, REGISTERS)


def promising(pairs: DataFrame, nodes: DataFrame, rule: Rule) -> DataFrame:
    """The (u, v) pairs whose registers leave a similarity above the threshold possible."""
    wide = pairs.select("u", "v")
    for side in ("u", "v"):
        wide = wide.join(
            nodes.select(
                F.col("node").alias(side), F.col("n_shingles").alias(f"n_{side}"), F.col("registers").alias(f"r_{side}")
            ),
            side,
        )

    @lean
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = hopeful(
                register_matrix(batch.column("r_u")),
                register_matrix(batch.column("r_v")),
                np.asarray(batch.column("n_u")),
                np.asarray(batch.column("n_v")),
                rule.percent,
            )
            yield batch.select(["u", "v"]).filter(pa.array(keep))

    return wide.mapInArrow(task, "u bigint, v bigint")


def confirmed(pairs: DataFrame, texts: DataFrame, rule: Rule) -> DataFrame:
    """The (u, v) pairs whose full shingle sets are similar enough; `texts` has (node, text)."""
    left = texts.select(F.col("node").alias("u"), F.col("text").alias("t_u"))
    right = texts.select(F.col("node").alias("v"), F.col("text").alias("t_v"))

    def sets_of(column: pa.Array) -> list[np.ndarray]:
        column = column.dictionary_encode()
        data, offsets = text_bytes(column.dictionary)
        sets = []
        for low, high in slices(offsets, SLICE_BYTES):
            sets += shingle_sets(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low], rule.size)
        return [sets[i] for i in np.asarray(column.indices)]

    @lean
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first in range(0, whole.num_rows, 256):
                batch = whole.slice(first, 256)
                keep = []
                for a, b in zip(sets_of(batch.column("t_u")), sets_of(batch.column("t_v")), strict=True):
                    both = len(np.intersect1d(a, b, assume_unique=True))
                    keep.append(100 * both >= rule.percent * (len(a) + len(b) - both) and both > 0)
                yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    # The larger id of a pair is almost always unique to it, so its text is joined first and then meets the hub's.
    return pairs.select("u", "v").join(right, "v").join(left, "u").select("u", "v", "t_u", "t_v").mapInArrow(
        task, "u bigint, v bigint"
    )


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """(sets, sets) sizes of all intersections, from products of 0/1 matrices over blocks of shingles."""
    result = np.zeros((len(sets), len(sets)), np.int64)
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    # A shingle of one set alone is in no intersection.
    common = times > 1
    place = np.cumsum(common) - 1
    used = common[column]
    owner, column = owner[used], place[column[used]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    for first in range(0, int(common.sum()), BLOCK_COLUMNS):
        low, high = np.searchsorted(column, (first, first + BLOCK_COLUMNS))
        block = np.zeros((len(sets), BLOCK_COLUMNS), np.float32)
        block[owner[low:high], column[low:high] - first] = 1
        result += (block @ block.T).astype(np.int64)
    return result


def tile_task(rule: Rule):
    """A task over sorted members of tiles to the links (u, v) that tie components of a tile together."""

    def compare(rows: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray] | None:
        node, component, tile = (np.asarray(rows.column(c)) for c in ("node", "component", "tile"))
        across = rows.column("low")[0].as_py() != rows.column("high")[0].as_py()
        if (component == component[0]).all():
            return None
        sets = [np.frombuffer(s, np.uint64) for s in rows.column("shingles").to_pylist()]
        n = np.array([len(s) for s in sets], np.int64)
        both = shared_counts(sets)
        linked = 100 * both >= rule.percent * (n[:, None] + n - both)
        linked &= component[:, None] != component
        if across:
            linked &= tile[:, None] != tile
        a, b = np.nonzero(np.triu(linked, 1))
        if not len(a):
            return None
        label = smallest_reachable(a, b, len(node))
        tied = np.flatnonzero(label != np.arange(len(node)))
        return node[tied], node[label[tied]]

    @lean
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [f for rows in in_groups(batches, ("key", "low", "high")) if rows.num_rows > 1 and (f := compare(rows))]
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found, strict=True)], ["u", "v"])

    return task


def set_task(rule: Rule):
    """A task from (node, text) to (node, shingles): the full sets as bytes."""

    @lean
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            for low, high in slices(offsets, SLICE_BYTES):
                sets = shingle_sets(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low], rule.size)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("node").slice(low, high - low), pa.array([s.tobytes() for s in sets], pa.binary())],
                    ["node", "shingles"],
                )

    return task


def links_in_tiles(members: DataFrame, texts: DataFrame, rule: Rule) -> DataFrame:
    """(u, v) links between components within large buckets, compared tile by tile on the full sets.

    `members` has (hub, node, component). The buckets of a group of copies in all bands share a hub, its smallest member,
    and are compared as one: their members are dealt into tiles of about TILE; a task holds two tiles at a time and
    returns the links that tie their components together, one per node at most.
    """
    members = members.select(F.col("hub").alias("key"), "node", "component").distinct()
    sizes = members.groupBy("key").agg(F.count(F.lit(1)).alias("size"))
    n_tiles = F.ceil(F.col("size") / TILE)
    spread = members.join(sizes, "key").select(
        "key",
        "node",
        "component",
        F.pmod(F.xxhash64("node"), n_tiles).alias("tile"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), n_tiles - 1)).alias("other"),
    ).select(
        "key", "node", "component", "tile", F.least("tile", "other").alias("low"), F.greatest("tile", "other").alias("high")
    )
    # A node that is an id with several texts is there with each of them.
    wanted = texts.join(members.select("node").distinct(), "node", "left_semi")
    sets = wanted.mapInArrow(set_task(rule), "node bigint, shingles binary")
    return (
        spread.join(sets, "node")
        .repartition(shuffle_width(members.sparkSession), "key", "low", "high")
        .sortWithinPartitions("key", "low", "high", "node")
        .mapInArrow(tile_task(rule), "u bigint, v bigint")
    )


def near_duplicates(documents: DataFrame, rule: Rule) -> DataFrame:
    """One row per row of `documents`: doc_id, n_shingles, component_id, kept.

    component_id is the smallest doc_id reachable over links, the document's own included; kept marks that document. A
    text with fewer words than a shingle has its whole sequence as its one shingle. Null and blank texts have no shingle
    and no link. Rows of one doc_id are judged each by its own text; sets whose smallest doc_id is the same count as one
    in the graph. A null doc_id has no link, a null component and is kept. An empty table gives an empty result. Other columns are not looked at.
    """
    docs = documents_of(documents)
    signed_docs = staged(signatures(docs, rule), "signatures")
    filled = signed_docs.filter("n_shingles > 0 and doc_id is not null")
    classes = staged(filled.groupBy("k1", "k2").agg(F.min("doc_id").alias("node")), "classes")
    nodes = filled.join(classes, ["k1", "k2"]).filter("doc_id = node").select("node", "n_shingles", "registers")

    bands = [
        F.xxhash64(F.lit(b), F.substring("registers", 2 * BAND * b + 1, 2 * BAND)) for b in range(REGISTERS // BAND)
    ]
    keyed = nodes.select("node", F.explode(F.array(*bands)).alias("key"))
    sizes = keyed.groupBy("key").agg(F.min("node").alias("hub"), F.max("node").alias("top"), F.count(F.lit(1)).alias("size"))
    members = staged(keyed.join(sizes.filter("hub < top").drop("top"), "key"), "buckets")
    candidates = members.select(F.col("node").alias("doc_id")).distinct()
    # Registers and texts of candidates alone; the filter keeps other texts out of the shuffle.
    nodes = staged(nodes.join(candidates.withColumnRenamed("doc_id", "node"), "node", "left_semi"), "candidates")
    flag = "maybe"
    texts = staged(
        sifted(docs, candidates, flag)
        .filter(flag)
        .join(candidates, "doc_id", "left_semi")
        # Each text of an id once: repeated rows must not multiply in the joins of pairs.
        .select(F.col("doc_id").alias("node"), "text", F.xxhash64("text").alias("tid"))
        .dropDuplicates(["node", "tid"])
        .drop("tid"),
        "candidate-texts",
    )

    stars = members.filter("node > hub").groupBy(F.col("hub").alias("u"), F.col("node").alias("v")).agg(F.count(F.lit(1)).alias("n"))
    stars = staged(promising(staged(stars, "stars"), nodes, rule).distinct(), "stars-promising")
    first = stars.groupBy("v").agg(F.min("u").alias("u"))
    links = staged(confirmed(first, texts, rule), "links")
    found = staged(components(links), "components")

    # Buckets that still hold several components: their members meet across components.
    placed = with_component(members, found, "node", "component")
    split = placed.groupBy("key").agg(F.min("component").alias("a"), F.max("component").alias("b")).filter("a < b").select("key")
    open_members = staged(placed.join(split, "key", "left_semi").select("key", "node", "hub", "component", "size"), "open-buckets")
    small = open_members.filter(F.col("size") <= SMALL_BUCKET)
    pairs = (
        small.select("key", F.col("node").alias("u"), F.col("component").alias("cu"))
        .join(small.select("key", F.col("node").alias("v"), F.col("component").alias("cv")), "key")
        .filter("u < v and cu <> cv")
        .select("u", "v")
        .distinct()
    )
    late = promising(pairs, nodes, rule).join(first, ["u", "v"], "left_anti")
    large = open_members.filter(F.col("size") > SMALL_BUCKET)
    links = links.unionByName(confirmed(late, texts, rule)).unionByName(links_in_tiles(large, texts, rule))
    found = staged(components(links), "components")

    # Classes of equal names are one node, and so are all rows of one id.
    placed = with_component(classes, found, "node", "component_id").select("k1", "k2", "component_id")
    return (
        signed_docs.join(placed, ["k1", "k2"], "left")
        .select(
            "doc_id",
            "n_shingles",
            F.when(F.col("doc_id").isNotNull(), F.coalesce(F.when(F.col("n_shingles") > 0, F.col("component_id")), F.col("doc_id"))).alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def near_dedup(documents: DataFrame, rule: Rule | None = None) -> DataFrame:
    """`documents` without the near copies: of each group the smallest doc_id stays, with all its columns."""
    gone = staged(near_duplicates(documents, rule or Rule()).filter("not kept").select("doc_id").distinct(), "copies")
    key = fresh_name(documents, "_copy_id")
    return documents.join(gone.withColumnRenamed("doc_id", key), F.col("doc_id").cast("bigint") == F.col(key), "left_anti")

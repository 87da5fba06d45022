"""Near-duplicate vectors by Euclidean p-stable hashing, followed by exact cosines.

A normalised vector is projected on random directions, shifted, and cut into cells of fixed width; several cells make a
bucket key, several keys make several tables. For unit vectors a cosine is a distance, so the chance to share a cell is
known, and the number of cells and tables follows from the number of vectors and the miss that is allowed.

A bucket is compared in tiles of bounded size. A pair counts in the first table where it shares a bucket, so links are
counted without listing them; for the components a tile reports a spanning forest alone. Equal vectors are one class.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.arrays import joined
from ledgerflow.llm.components import components, smallest_reachable, with_component
from ledgerflow.llm.frames import in_groups, lists, shuffle_width, staged
from ledgerflow.llm.vectors import by_length, matrix, vectors_of

COSINE = 0.95
WIDTH = 2.0
# Chance to miss a pair of exactly the threshold cosine.
MISS = 1e-4
# Members a bucket of unrelated vectors should have.
OCCUPANCY = 64
TILE = 256
SEED = 20240117


def same_cell(distance: float, width: float = WIDTH) -> float:
    """Chance that two points at this distance share a cell of a random projection."""
    ratio = width / distance
    tail = 0.5 * math.erfc(ratio / math.sqrt(2))
    return 1 - 2 * tail - 2 / (math.sqrt(2 * math.pi) * ratio) * (1 - math.exp(-(ratio**2) / 2))


def layout(n: int, cosine: float = COSINE) -> tuple[int, int]:
    """(cells per key, tables) for n vectors."""
    near, far = same_cell(math.sqrt(2 - 2 * cosine)), same_cell(math.sqrt(2))
    cells = max(2, math.ceil(math.log(max(2.0, n / OCCUPANCY)) / -math.log(far)))
    return cells, math.ceil(math.log(MISS) / math.log1p(-(near**cells)))


def bucket_keys(x: np.ndarray, cells: int, tables: int) -> np.ndarray:
    """(vectors, tables) keys of unit vectors; directions and shifts come from a fixed seed."""
    random = np.random.default_rng(SEED)
    directions = random.standard_normal((x.shape[1], tables * cells))
    shifts = random.uniform(0, WIDTH, tables * cells)
    grid = np.floor((x @ directions + shifts) / WIDTH).astype(np.int64).view(np.uint64)
    grid = grid.reshape(len(x), tables, cells)
    keys = np.full((len(x), tables), x.shape[1], np.uint64)
    for cell in range(cells):
        keys = joined(keys, np.ascontiguousarray(grid[:, :, cell]))
    return keys.view(np.int64)


def tile_links(rows: pa.RecordBatch, cosine: float) -> tuple[np.ndarray, ...] | None:
    """(node, form, linked vectors, smallest linked node) of the rows of one tile, which have vectors of one length."""
    node, form = np.asarray(rows.column("node")), np.asarray(rows.column("form"))
    order = np.lexsort((form, node))
    node, form, tile = node[order], form[order], np.asarray(rows.column("tile"))[order]
    size = np.asarray(rows.column("size"))[order]
    table = int(rows.column("tab")[0].as_py())
    across = rows.column("low")[0].as_py() != rows.column("high")[0].as_py()
    x = matrix(rows.column("embedding"))[order]
    length = np.sqrt((x * x).sum(axis=1))
    products = (x @ x.T) / (length[:, None] * length)
    a, b = np.nonzero(np.triu(products >= cosine, 1))
    if across:
        different = tile[a] != tile[b]
        a, b = a[different], b[different]
    if table and len(a):
        keys = np.asarray(rows.column("keys").flatten()).reshape(rows.num_rows, -1)[order][:, :table]
        new = np.ones(len(a), bool)
        for first in range(0, len(a), 1 << 16):
            part = slice(first, first + (1 << 16))
            new[part] = ~(keys[a[part]] == keys[b[part]]).any(axis=1)
        a, b = a[new], b[new]
    if not len(a):
        return None
    n_links = np.bincount(a, size[b], len(node)) + np.bincount(b, size[a], len(node))
    label = smallest_reachable(a, b, len(node))
    used = np.flatnonzero(n_links)
    return node[used], form[used], n_links[used].astype(np.int64), node[label[used]]


def near_vectors(embeddings: DataFrame, cosine: float = COSINE) -> DataFrame:
    """One row per row of `embeddings`: vec_id, n_links, component_id, kept.

    Vectors left out by `vectors_of` have no link and are their own component; a null vec_id has a null component and is
    kept. Rows of one vec_id and equal vectors are linked like other copies; with different vectors each has its own links,
    and they are one node of the graph. Vectors of different lengths are never linked. An empty table gives an empty result. Other columns are not looked at.
    """
    spark = embeddings.sparkSession
    vectors = staged(vectors_of(embeddings), "vectors")
    classes = staged(
        vectors.groupBy("embedding")
        .agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("size"))
        # An id may name several classes, which its form tells apart.
        .withColumn("form", F.xxhash64("embedding")),
        "vector-classes",
    )
    cells, tables = layout(classes.count(), cosine)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in by_length(batch.column("embedding")):
                part = batch.take(pa.array(rows))
                x = matrix(part.column("embedding"))
                keys = bucket_keys(x / np.sqrt((x * x).sum(axis=1))[:, None], cells, tables)
                column = lists(keys.ravel(), np.arange(len(x) + 1) * tables)
                yield pa.RecordBatch.from_arrays([*part.columns, column], [*part.schema.names, "keys"])

    points = staged(
        classes.mapInArrow(keyed, "embedding array<float>, node bigint, size bigint, form bigint, keys array<bigint>"), "vector-keys"
    )
    spots = points.select("node", "form", F.posexplode("keys").alias("tab", "key"))
    crowded = spots.groupBy("tab", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    n_tiles = F.ceil(F.col("n") / TILE)
    dealt = spots.join(crowded, ["tab", "key"]).select(
        "node", "form", "tab", "key", F.pmod(F.xxhash64("node", "form"), n_tiles).alias("tile"), F.explode(F.sequence(F.lit(0).cast("bigint"), n_tiles - 1)).alias("other")
    )
    dealt = dealt.select("node", "form", "tab", "key", "tile", F.least("tile", "other").alias("low"), F.greatest("tile", "other").alias("high"))
    groups = ["tab", "key", "low", "high"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for rows in in_groups(batches, groups):
            # Keys of different lengths are different, but for chance.
            for same in by_length(rows.column("embedding")):
                links = tile_links(rows.take(pa.array(same)), cosine) if len(same) > 1 else None
                found += [links] if links else []
        if found:
            columns = [pa.array(np.concatenate(c)) for c in zip(*found, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, ["node", "form", "n_links", "least"])

    met = staged(
        dealt.join(points, ["node", "form"])
        .repartition(shuffle_width(spark), *groups)
        .sortWithinPartitions(*groups)
        .mapInArrow(compare, "node bigint, form bigint, n_links bigint, least bigint"),
        "vector-links",
    )
    links = met.groupBy("node", "form").agg(F.sum("n_links").alias("n_links"))
    # An id with several vectors ties the classes they belong to.
    several = vectors.groupBy("vec_id").agg(F.min("embedding").alias("a"), F.max("embedding").alias("b")).filter("a <> b").select("vec_id")
    tied = vectors.join(several, "vec_id", "left_semi").join(classes, "embedding").select(F.col("vec_id").alias("u"), F.col("node").alias("v"))
    edges = met.select(F.col("node").alias("u"), F.col("least").alias("v")).unionByName(tied)
    found = staged(components(edges), "components")
    placed = with_component(classes, found, "node", "component_id").join(links, ["node", "form"], "left")
    verdicts = placed.select(
        "embedding", "component_id", (F.coalesce("n_links", F.lit(0)) + F.col("size") - 1).alias("n_links")
    )
    own = F.col("vec_id")
    rows = embeddings.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<float>").alias("embedding"))
    taken = vectors.join(verdicts, "embedding").select("vec_id", "n_links", "component_id")
    # Rows that take no part: those the vectors do not have, compared by id and vector.
    left_out = rows.join(
        vectors.select(F.col("vec_id").alias("v"), F.col("embedding").alias("e")),
        own.eqNullSafe(F.col("v")) & F.col("embedding").eqNullSafe(F.col("e")),
        "left_anti",
    ).select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return taken.unionByName(left_out).withColumn("kept", F.coalesce(own == F.col("component_id"), F.lit(True)))

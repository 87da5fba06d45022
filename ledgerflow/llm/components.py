"""Connected components of a graph of links, by alternating large and small stars."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.frames import discard, staged


def both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def large_star(edges: DataFrame) -> DataFrame:
    """Tie every larger neighbour of a node to the smallest node around it."""
    around = both_ways(edges)
    least = around.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return around.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def small_star(edges: DataFrame) -> DataFrame:
    """Tie a node and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u > v")
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u")
    return (
        moved.select(F.col("v").alias("u"), F.col("m").alias("v"))
        .unionByName(least.select("u", F.col("m").alias("v")))
        .filter("u > v")
        .distinct()
    )


def components(links: DataFrame, label: str = "components") -> DataFrame:
    """(node, component) of all nodes with a link: the smallest node each can reach.

    `links` has the bigint columns (u, v) in any direction; loops, repeats and nulls do no harm. The rounds end when a
    round changes nothing; every round is staged. Their number grows with the logarithm of the longest path.
    """
    edges = staged(
        links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), label
    )

    def state(frame: DataFrame) -> tuple:
        return tuple(frame.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    before = state(edges)
    while before[0]:
        after_edges = staged(small_star(large_star(edges)), label)
        after = state(after_edges)
        discard(edges)
        edges = after_edges
        if after == before:
            break
        before = after
    own = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(own)


def with_component(frame: DataFrame, found: DataFrame, node: str, name: str) -> DataFrame:
    """Add the component of a node; a node without links is its own."""
    other = found.select(F.col("node").alias(node), F.col("component").alias(name))
    return frame.join(other, node, "left").withColumn(name, F.coalesce(F.col(name), F.col(node)))


def smallest_reachable(pairs_a: np.ndarray, pairs_b: np.ndarray, n: int) -> np.ndarray:
    """The smallest position each of n positions reaches over the pairs."""
    label = np.arange(n)
    while True:
        before = label.copy()
        least = np.minimum(label[pairs_a], label[pairs_b])
        np.minimum.at(label, pairs_a, least)
        np.minimum.at(label, pairs_b, least)
        label = label[label]
        if (label == before).all():
            return label

"""Mixing sources to target weights by temperature: shares are exponentiated, the exponent found by bisection.

A source's weight is its share of all tokens to the power alpha, normalised. Alpha is the largest flattening that a
repetition limit allows, or the one that meets a target entropy. The weights are realised as block permutations: every
source is dealt into a fixed number of blocks by a hash of the id; an epoch takes the blocks in an order of its own
until the source's budget is met, and the block where that happens is cut within.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.llm.frames import fresh_name, staged

# Blocks per source: bounds the table of blocks, whatever the number of documents.
BLOCKS = 256
# Sources whose blocks fit a broadcast; with more of them the verdicts are joined by a shuffle.
BROADCAST_SOURCES = 2000
STEPS = 60
WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Target:
    """What the mixture must meet: at most `repeats` epochs of any source, or an `entropy` of the weights in nats.

    `budget` is the number of tokens of the mixture; without it, it is the least at which every source is used in whole
    at least once, so that no document is lost.
    """

    repeats: float | None = 1.5
    entropy: float | None = None
    budget: float | None = None


def tempered(tokens: Mapping[str, float], alpha: float) -> dict[str, float]:
    """Weights of sources with tokens: share to the power alpha, normalised."""
    total = sum(tokens.values())
    powers = {name: (count / total) ** alpha for name, count in sorted(tokens.items()) if count > 0}
    whole = sum(powers.values())
    return {name: power / whole for name, power in powers.items()}


def budget_of(tokens: Mapping[str, float], weights: Mapping[str, float], target: Target) -> float:
    if target.budget is not None:
        return target.budget
    return max((tokens[name] / weight for name, weight in weights.items()), default=0.0)


def exponent(tokens: Mapping[str, float], target: Target) -> float:
    """The alpha between 0 and 1 that meets the target, by bisection; the nearer end if none does."""
    if not any(count > 0 for count in tokens.values()):
        return 1.0

    def too_flat(alpha: float) -> bool:
        weights = tempered(tokens, alpha)
        if target.entropy is not None:
            return -sum(w * math.log(w) for w in weights.values() if w > 0) > target.entropy
        budget = budget_of(tokens, weights, target)
        return max(weights[name] * budget / tokens[name] for name in weights) > (target.repeats or 1.0)

    low, high = 0.0, 1.0
    if not too_flat(low):
        return low
    for _ in range(STEPS):
        middle = (low + high) / 2
        low, high = (middle, high) if too_flat(middle) else (low, middle)
    return high


def tokens_of(text: Column) -> Column:
    """Words of a text; none for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def mixture(documents: DataFrame, target: Target | None = None, source_column: str = "source") -> tuple[DataFrame, dict[str, str]]:
    """Every row of `documents` once per use, with four more columns whose names the second result gives.

    epoch: the use of the row, from 0. place: sorting by (epoch, place) gives the permutation. tokens: words of the
    text. weight: the weight of the source. A null source is a source of its own. Rows without words are used in the
    first epoch alone. Rows with one doc_id are in or out together. An empty table gives an empty result.
    """
    target = target or Target()
    spark = documents.sparkSession
    names = {c: fresh_name(documents, f"_mix_{c}") for c in ("epoch", "place", "tokens", "weight")}
    key, block, order = (fresh_name(documents, f"_mix_{c}") for c in ("source", "block", "order"))
    source = F.col(f"`{source_column}`").cast("string")
    marked = documents.withColumns(
        {
            key: F.coalesce(F.concat(F.lit("="), source), F.lit("")),
            names["tokens"]: tokens_of(F.col("text")),
            block: F.pmod(F.xxhash64("doc_id", F.lit("block")), F.lit(BLOCKS)),
            order: F.xxhash64("doc_id", F.lit("order")),
        }
    )
    narrow = staged(
        marked.select(
            F.col(key).alias("s"),
            F.col(block).alias("b"),
            F.col(order).alias("h"),
            F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(2**63))).alias("id"),
            F.col(names["tokens"]).alias("n"),
        ),
        "mix-rows",
    )
    blocks = staged(narrow.groupBy("s", "b").agg(F.sum("n").alias("n")), "mix-blocks")
    tokens = {s: float(n) for s, n in blocks.groupBy("s").agg(F.sum("n")).collect()}
    weights = tempered(tokens, exponent(tokens, target)) if any(tokens.values()) else {}
    budget = budget_of(tokens, weights, target)
    plan = []
    for name, count in tokens.items():
        uses = weights.get(name, 0.0) * budget / count if count else 1.0
        whole = math.floor(uses + 1e-9)
        plan.append((name, weights.get(name, 0.0), whole, float(max(0.0, (uses - whole) * count))))
    shares = spark.createDataFrame(plan, "s string, weight double, whole int, rest double")

    # The partial epoch: blocks in its own order while they fit, and the one block that no longer does.
    by_source = Window.partitionBy("s").orderBy(F.xxhash64("s", "b", F.lit("partial")), "b")
    placed = blocks.join(shares, "s").withColumn("until", F.sum("n").over(by_source))
    placed = placed.withColumn("before", F.col("until") - F.col("n")).withColumn("full", F.col("until") <= F.col("rest"))
    cut = placed.filter(~F.col("full") & (F.col("before") < F.col("rest"))).select("s", "b", (F.col("rest") - F.col("before")).alias("left"))
    within = Window.partitionBy("s", "b").orderBy("h", "id").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    last = (
        narrow.join(F.broadcast(cut) if len(tokens) <= BROADCAST_SOURCES else cut, ["s", "b"])
        .withColumn("until", F.sum("n").over(within))
        .filter(F.col("until") <= F.col("left"))
        .groupBy("s", "b")
        .agg(F.max(F.struct("h", "id")).alias("last"))
    )
    verdicts = staged(
        placed.join(last, ["s", "b"], "left").select(
            F.col("s").alias(key), F.col("b").alias(block), F.col("weight").alias(names["weight"]), "whole", "full", "last"
        ).select(key, block, names["weight"], F.struct("whole", "full", "last").alias(names["epoch"])),
        "mix-verdicts",
    )
    verdict = names["epoch"]
    used = marked.join(F.broadcast(verdicts) if len(tokens) <= BROADCAST_SOURCES else verdicts, [key, block])
    own = F.struct(F.col(order).alias("h"), F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(2**63))).alias("id"))
    again = F.coalesce(F.col(f"{verdict}.full") | (own <= F.col(f"{verdict}.last")), F.lit(False))
    again = again & (F.col(names["tokens"]) > 0)
    uses = F.when(F.col(names["tokens"]) > 0, F.col(f"{verdict}.whole")).otherwise(F.least(F.col(f"{verdict}.whole"), F.lit(1)))
    count = uses + F.when(again, 1).otherwise(0)
    used = used.withColumn(verdict, F.when(count > 0, F.sequence(F.lit(0), count - 1)))
    used = used.withColumn(verdict, F.explode(verdict)).withColumn(
        names["place"], F.xxhash64(key, block, verdict).bitwiseAND(F.lit(~0xFFFF)) + F.pmod(F.xxhash64("doc_id", verdict), F.lit(1 << 16))
    )
    return used.select(*documents.columns, *names.values()), names


def mixed_documents(documents: DataFrame, target: Target | None = None) -> DataFrame:
    """The mixture with the columns of `documents` alone; a row stands there once per use."""
    return mixture(documents, target)[0].select(*documents.columns)


def mixing_digest(documents: DataFrame, target: Target | None = None) -> DataFrame:
    """doc_id, source, n_tokens, weight, epoch and place of every use of every document."""
    used, names = mixture(documents, target)
    return used.select(
        "doc_id",
        "source",
        F.col(names["tokens"]).alias("n_tokens"),
        F.col(names["weight"]).alias("weight"),
        F.col(names["epoch"]).alias("epoch"),
        F.col(names["place"]).alias("place"),
    )

"""Three kinds of duplicates: older versions, repeats of stored rows, repeats across files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.operators.joins import broadcast_if_small
from ledgerflow.session import stage

# Version order within equal ingest times, which is one instant per run.
VERSION_TIE_BREAKERS = ("transaction_ts", "source_file", "record_hash")


def latest_per_transaction(
    audit: DataFrame, columns: Sequence[str] | None = None, tie_breakers: Sequence[str] = VERSION_TIE_BREAKERS
) -> DataFrame:
    """The newest version of every transaction.

    Only the requested columns and the ordering travel through the shuffle, a
    hash that is not requested as its 32 bytes instead of 64 digits. Catalyst turns
    `row_number = 1` into a group limit on both sides of the shuffle, so a
    transaction id with any number of versions (all blank ids, say) sends at
    most one row per map task.
    """
    wanted = list(columns or audit.columns)
    order = ["ingest_ts", *[c for c in tie_breakers if c in audit.columns]]
    needed = dict.fromkeys([*wanted, "transaction_id", *order])
    narrow = audit.select(*needed)
    if "record_hash" in order and "record_hash" not in wanted:
        narrow = narrow.withColumn("record_hash", F.unhex("record_hash"))
    # The leading hash lets the sort compare 8-byte prefixes; ids often share their first bytes.
    group = [F.xxhash64("transaction_id"), "transaction_id"]
    newest_first = Window.partitionBy(*group).orderBy(*[F.desc(c) for c in order])
    return (
        narrow.withColumn("_version", F.row_number().over(newest_first)).filter("_version = 1").select(*wanted)
    )


def as_bytes() -> Column:
    """The record hash as its 32 bytes; any other key as its text."""
    digits = F.length("record_hash") == 64
    return F.coalesce(F.when(digits, F.unhex("record_hash")), F.encode("record_hash", "UTF-8"))


def hash_key(rows: DataFrame) -> Column:
    """The record hash of these rows as bytes, whether it is text or bytes already."""
    if isinstance(rows.schema["record_hash"].dataType, T.BinaryType):
        return F.col("record_hash")
    return as_bytes()


def distinct_hashes(stored: DataFrame) -> DataFrame:
    """(hash) of stored rows: of an index that has them as bytes, or from `record_hash`."""
    return (stored.select("hash") if "hash" in stored.columns else stored.select(as_bytes().alias("hash"))).distinct()


def drop_stored(batch: DataFrame, stored_hashes: DataFrame) -> DataFrame:
    """Rows of `batch` whose hash is not stored yet; repeats inside the batch stay.

    The known hashes are staged and kept away by an anti join: broadcast if
    measured small, else AQE splits a hash that fills a third of the batch.
    """
    if "record_hash" not in batch.columns:
        raise ValueError("rows need a record_hash before they can be compared with stored ones")
    own = batch.select(as_bytes().alias("hash")).distinct()
    known = stage(own.join(distinct_hashes(stored_hashes), "hash", "left_semi"), "known-hashes")
    return batch.join(broadcast_if_small(known), as_bytes() == F.col("hash"), "left_anti")


def new_rows(rows: DataFrame, stored_hashes: DataFrame | None = None, strict_unique: bool = False) -> DataFrame:
    """The rows that are neither stored nor in an earlier delivery of this batch.

    Settled on hashes alone, as 32 bytes. A run of new rows has few losers
    (hashes that are stored, or in several deliveries): they are kept away from
    the payload by an anti join, broadcast if measured small, so the payload is
    not shuffled for it. A run that mostly meets known rows has few winners
    instead, which a semi join picks out.
    """
    key = hash_key(rows)
    owners = rows.select(key.alias("hash"), "source_file").groupBy("hash").agg(
        F.min("source_file").alias("owner"), F.max("source_file").alias("last")
    )
    if stored_hashes is None:
        owners = owners.withColumn("known", F.lit(None).cast("boolean"))
    else:
        owners = owners.join(distinct_hashes(stored_hashes).withColumn("known", F.lit(True)), "hash", "left")
    verdicts = stage(owners, "hash-verdicts")
    lost = F.col("known").isNotNull()
    shared = F.col("owner") != F.col("last")
    counts = verdicts.agg(F.count_if(lost | shared).alias("losers"), F.count_if(~lost).alias("winners")).first()
    by_hash = key == F.col("hash")
    if counts["losers"] <= counts["winners"]:
        losers = stage(
            verdicts.filter(lost | shared).select("hash", F.when(~lost, F.col("owner")).alias("owner")), "losers"
        )
        later = F.col("owner").isNull() | (F.col("source_file") != F.col("owner"))
        fresh = rows.join(broadcast_if_small(losers), by_hash & later, "left_anti")
    else:
        winners = stage(verdicts.filter(~lost).select("hash", "owner"), "winners")
        fresh = rows.join(broadcast_if_small(winners), by_hash & (F.col("source_file") == F.col("owner")), "left_semi")
    return fresh.dropDuplicates(["record_hash"]) if strict_unique else fresh


# Rows of one hash that a single task takes.
COPIES_IN_TASK = 1_000_000


def most_copies(rows: DataFrame) -> int:
    """About how many rows the commonest hash has, or those without a hash; one pass without a shuffle of rows."""
    hashed = rows.select(hash_key(rows).alias("hash"))
    top = hashed.agg(
        F.expr("approx_top_k(xxhash64(hash), 1)").alias("top"), F.count_if(F.col("hash").isNull()).alias("unhashed")
    ).first()
    return max([top["unhashed"], *[t["count"] for t in top["top"]]])


def first_delivery_wins(batch: DataFrame, copies_in_task: int = COPIES_IN_TASK) -> DataFrame:
    """The result of loading deliveries one after another in name order, in one job.

    One shuffle by hash, behind which each row sees the first delivery of its
    hash; the result stays partitioned by it. Only if one hash has too many rows
    for a task the verdicts go the way of `new_rows`, whose joins split them.
    `batch` is read twice; `record_hash` may be text or, at half the size, bytes.
    """
    if most_copies(batch) > copies_in_task:
        return new_rows(batch)
    key = hash_key(batch)
    owner = F.min("source_file").over(Window.partitionBy(key))
    later = F.coalesce(F.col("source_file") != F.col("_owner"), F.lit(False))
    return batch.withColumn("_owner", owner).filter(key.isNull() | ~later).drop("_owner")

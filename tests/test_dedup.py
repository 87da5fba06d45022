from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerflow.operators.dedup import drop_stored, first_delivery_wins, latest_per_transaction, most_copies
from payments import audit, payment


def hashes(spark, rows):
    return spark.createDataFrame([(h,) for h in rows], "record_hash string")


def test_known_hashes_are_dropped(spark):
    batch = hashes(spark, ["a", "b", "c"])
    assert drop_stored(batch, batch).count() == 0
    assert drop_stored(batch, hashes(spark, [])).count() == 3
    five, two = hashes(spark, "abcde"), hashes(spark, "abcdefg")
    assert sorted(r[0] for r in drop_stored(two, five).collect()) == ["f", "g"]


def test_copies_inside_a_batch_stay(spark):
    kept = drop_stored(hashes(spark, ["a", "a", "b"]), hashes(spark, ["b", "b"]))
    assert [r[0] for r in kept.collect()] == ["a", "a"]


def test_hash_is_required(spark):
    with pytest.raises(ValueError, match="record_hash"):
        drop_stored(spark.range(1), hashes(spark, []))


def one_after_another(rows):
    """Deliveries in name order; a row enters unless an earlier delivery stored its hash."""
    stored, kept = set(), []
    for name in sorted({source for source, _ in rows}):
        new = [h for source, h in rows if source == name and h not in stored]
        stored.update(new)
        kept += [(name, h) for h in new]
    return Counter(kept)


@pytest.mark.parametrize("seed", range(4))
def test_first_delivery_wins_equals_sequential_loading(spark, seed):
    rng = random.Random(seed)
    # One hash fills a third of all rows, in every delivery and many times in each.
    rows = [(f"d{rng.randrange(5)}.csv", "hot" if rng.random() < 0.33 else f"h{rng.randrange(60)}") for _ in range(300)]
    batch = spark.createDataFrame(rows, "source_file string, record_hash string")
    kept = first_delivery_wins(batch).select("source_file", "record_hash").collect()
    assert Counter((r[0], r[1]) for r in kept) == one_after_another(rows)


def test_first_delivery_of_hashes_as_text_or_bytes_hot_or_not(spark):
    low, high = "ab" * 32, "AB" * 32  # one hash in two spellings
    rows = [("b", low), ("a", high), ("a", high), ("b", "x"), (None, "x"), ("c", "x"), ("b", None), ("a", None), (None, low)]
    batch = spark.createDataFrame(rows, "source_file string, record_hash string")
    packed = batch.withColumn("record_hash", F.coalesce(F.unhex("record_hash"), F.encode("record_hash", "UTF-8")))
    assert most_copies(batch) == most_copies(packed) == 4
    wanted = Counter([("a", high), ("a", high), (None, low), ("b", "x"), (None, "x"), ("b", None), ("a", None)])
    for limit in (3, 100):
        assert Counter(map(tuple, first_delivery_wins(batch, limit).collect())) == wanted
        assert Counter(r[0] for r in first_delivery_wins(packed, limit).collect()) == Counter(w[0] for w in wanted.elements())


def test_first_delivery_shuffles_once(spark, capsys):
    rows = [(f"d{n % 3}.csv", f"t{n % 20}", f"h{n % 20}".encode()) for n in range(90)]
    kept = first_delivery_wins(spark.createDataFrame(rows, "source_file string, transaction_id string, record_hash binary"))
    kept.groupBy("transaction_id", "record_hash", "source_file").count().explain()
    assert capsys.readouterr().out.count("Exchange hashpartitioning(") == 1


def test_newest_version_wins(spark):
    rows = [
        payment("T1", status="PENDING") | {"ingest_ts": "2024-02-01 00:00:00"},
        payment("T1", status="APPROVED") | {"ingest_ts": "2024-02-03 00:00:00"},
        payment("T1", status="DECLINED") | {"ingest_ts": "2024-02-02 00:00:00"},
        payment("T2"),
    ]
    latest = latest_per_transaction(audit(spark, rows), ["transaction_id", "status"])
    assert {r[0]: r[1] for r in latest.collect()} == {"T1": "APPROVED", "T2": "APPROVED"}


def test_ties_are_broken_by_time_then_file_then_hash(spark):
    base = audit(spark, [payment("T1")]).drop("transaction_ts")
    versions = [("2024-01-15 09:00:00", "z.csv", "f" * 64, 1.0), ("2024-01-15 10:00:00", "a.csv", "1" * 64, 2.0)]
    versions += [("2024-01-15 10:00:00", "b.csv", "2" * 64, 3.0), ("2024-01-15 10:00:00", "b.csv", "3" * 64, 4.0)]
    parts = None
    for when, source, digest, amount in versions:
        part = base.withColumns(
            {
                "transaction_ts": F.lit(when).cast("timestamp"),
                "source_file": F.lit(source),
                "record_hash": F.lit(digest),
                "amount": F.lit(amount),
            }
        )
        parts = part if parts is None else parts.unionByName(part)
    assert latest_per_transaction(parts, ["amount"]).collect()[0][0] == 4.0
    assert latest_per_transaction(parts).count() == 1


def test_blank_transaction_ids_collapse(spark):
    rows = [payment(""), payment("", amount="5"), payment("T1")]
    assert latest_per_transaction(audit(spark, rows)).count() == 2


def test_hot_transaction_is_cut_before_the_shuffle(spark, capsys):
    latest_per_transaction(audit(spark, [payment()]), ["transaction_id", "status"]).explain()
    text = capsys.readouterr().out
    shuffle = text.index("Exchange hashpartitioning(")
    assert "WindowGroupLimit" in text[:shuffle] and "WindowGroupLimit" in text[shuffle:]

from __future__ import annotations

import pytest

from ledgerflow import session
from ledgerflow.operators.joins import broadcast_if_small, left_join_dimension, measured_bytes
from payments import lookup


def test_staged_tables_go_to_the_shared_folder(spark):
    folder = spark.conf.get("spark.checkpoint.dir", None)
    staged = session.stage(spark.range(3), "numbers")
    assert staged.count() == 3
    if folder:
        assert session.shared_folder(spark) == folder.rstrip("/")
        assert all(folder in path for path in staged.inputFiles())


def test_staging_twice_keeps_both(spark):
    one, two = session.stage(spark.range(1), "n"), session.stage(spark.range(2), "n")
    assert (one.count(), two.count()) == (1, 2)


def test_shuffles_grow_with_the_input(spark, tmp_path):
    setting = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    (tmp_path / "a.csv").write_bytes(b"x" * 10_000)
    try:
        with session.sized_shuffles(spark, str(tmp_path), {}) as number:
            assert number == int(spark.conf.get("spark.sql.shuffle.partitions"))
        assert spark.conf.get(setting, None) is None
        spark.conf.set(setting, "7")
        with session.sized_shuffles(spark, str(tmp_path), {}, 100) as number:
            assert number == 100 == int(spark.conf.get(setting))
        assert spark.conf.get(setting) == "7"
        with session.sized_shuffles(spark, str(tmp_path / "none"), {}, 100) as number:
            assert number == int(spark.conf.get("spark.sql.shuffle.partitions"))
    finally:
        spark.conf.unset(setting)


def test_splits_are_small_within_the_block(spark, tmp_path):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.range(0, 40_000, 1, 1).write.parquet(str(tmp_path / "t"))
    with session.small_splits(spark, 20_000):
        assert spark.read.parquet(str(tmp_path / "t")).rdd.getNumPartitions() > 4
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before


def test_methods_too_long_to_be_compiled_are_not_generated(spark):
    name = "spark.sql.codegen.hugeMethodLimit"
    spark.conf.unset(name)
    assert int(session.apply_job_settings(spark).conf.get(name)) == 8000


def test_a_run_removes_what_it_staged(spark, tmp_path):
    def run(fail):
        with session.staging_of_run(spark):
            staged.append(session.stage(spark.range(2), "gone"))
            staged.append(session.stage(spark.range(2), "kept", keep=True))
            if fail:
                raise KeyError("broken")

    for fail in (False, True):
        staged = []
        if fail:
            with pytest.raises(KeyError):
                run(fail)
        else:
            run(fail)
        gone, kept = (frame.inputFiles()[0].rsplit("/", 1)[0] for frame in staged)
        assert not session.path_exists(spark, gone) and session.path_exists(spark, kept)


class Elsewhere:
    """A session as a cluster would configure it."""

    def __init__(self, master, folder):
        self.sparkContext = type("Context", (), {"master": master})
        self.conf = type("Conf", (), {"get": staticmethod(lambda key, default=None: folder or default)})


def test_a_cluster_must_name_a_shared_folder():
    assert session.shared_folder(Elsewhere("yarn", "hdfs://x/stage/")) == "hdfs://x/stage"
    assert session.shared_folder(Elsewhere("local-cluster[2,1,1024]", "file:/mnt/shared")) == "file:/mnt/shared"
    for master, folder in (("yarn", None), ("local-cluster[2,1,1024]", None), ("spark://x:7077", "file:/tmp/x")):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            session.shared_folder(Elsewhere(master, folder))


def test_broadcast_needs_a_measured_size(spark, capsys):
    shops = lookup(spark, ("M1", "a", None), ("M2", "bb", "cc"))
    assert measured_bytes(shops) == 6 * 16 + 2 + 1 + 2 + 2 + 2
    assert measured_bytes(shops.filter("false")) == 0
    facts = spark.createDataFrame([("M1", 1), ("M2", 2), ("M9", 3), (None, 4)], "merchant_id string, n int")
    facts.join(broadcast_if_small(shops), "merchant_id", "left").explain(True)
    assert "ResolvedHint (strategy=broadcast)" in capsys.readouterr().out
    facts.join(broadcast_if_small(shops, 10), "merchant_id", "left").explain(True)
    assert "ResolvedHint" not in capsys.readouterr().out


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_left_join_keeps_every_row_and_repeats_for_repeated_keys(spark, limit):
    shops = lookup(spark, ("M1", "a", "x"), ("M1", "b", "x"))
    facts = spark.createDataFrame([("M1", 1), ("M9", 3), (None, 4)], "merchant_id string, n int")
    rows = left_join_dimension(facts, shops, "merchant_id", limit).collect()
    assert sorted((r["n"], r["merchant_name"] or "") for r in rows) == [(1, "a"), (1, "b"), (3, ""), (4, "")]


def test_paths_and_globs_are_found(spark, tmp_path):
    (tmp_path / "day=1").mkdir()
    (tmp_path / "day=1" / "a.csv").touch()
    assert session.path_exists(spark, str(tmp_path))
    assert session.path_exists(spark, f"{tmp_path}/day=*/a.csv")
    assert not session.path_exists(spark, f"{tmp_path}/day=2")
    assert not session.path_exists(spark, f"{tmp_path}/day=*/b.csv")

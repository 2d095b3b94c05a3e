"""Loads into stored tables: repeats, markers, broken attempts, changed inputs."""

import os
import shutil

import pytest
from pyspark.sql import functions as F

from signalbox.plans import store
from signalbox.plans.services import KEYS, load_all
from signalbox.session import materialize, path_exists, release_run, run_root, shared_dir
from signalbox.sources.binding import cancel_code_rows, service_rows
from signalbox.sources.tables import Tables

from .conftest import SMALL


@pytest.fixture
def batch(spark):
    t = Tables(spark, SMALL)
    return service_rows(t).where(F.col("l_partkey") % 5 == 0), cancel_code_rows(t)


@pytest.mark.parametrize("marker", ["true", "false"])
def test_second_load_appends_nothing_with_or_without_markers(spark, tmp_path, batch, marker):
    conf, key = spark.sparkContext._jsc.hadoopConfiguration(), "mapreduce.fileoutputcommitter.marksuccessfuljobs"
    conf.set(key, marker)
    try:
        first = load_all(spark, *batch, f"{tmp_path}/wh")
        assert os.path.exists(f"{tmp_path}/wh/company/_SUCCESS") == (marker == "true")
        assert all(first.values())
        assert set(load_all(spark, *batch, f"{tmp_path}/wh").values()) == {0}
        assert set(load_all(spark, *batch, f"file://{tmp_path}/wh").values()) == {0}
    finally:
        conf.set(key, "true")


def test_a_load_that_breaks_off_is_completed(spark, tmp_path, batch):
    root = f"{tmp_path}/wh"
    whole = load_all(spark, *batch, f"{tmp_path}/fresh")
    load_all(spark, *batch, root)
    shutil.rmtree(f"{root}/cancellation")
    os.makedirs(f"{root}/cancellation/_temporary/0")
    again = load_all(spark, *batch, root)
    assert {n: c for n, c in again.items() if c} == {"cancellation": whole["cancellation"]}


def test_a_target_that_repeats_a_key_is_refused(spark, tmp_path, batch):
    load_all(spark, *batch, f"{tmp_path}/wh")
    spark.read.parquet(f"{tmp_path}/wh/station").limit(1).write.mode("append").parquet(f"{tmp_path}/wh/station")
    with pytest.raises(ValueError, match="station"):
        load_all(spark, *batch, f"{tmp_path}/wh")


def test_no_fact_is_loaded_twice_and_months_are_few_files(spark, tmp_path, batch):
    load_all(spark, *batch, f"{tmp_path}/wh")
    for name in ("service_details", "delay_details", "cancellation"):
        rows = spark.read.parquet(f"{tmp_path}/wh/{name}")
        assert rows.count() == rows.select(*KEYS[name]).distinct().count()
        months = rows.select("run_month").distinct().count()
        files = len(rows.inputFiles())
        assert files <= months + 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_path_exists_asks_the_file_system(spark, tmp_path):
    assert not path_exists(spark, f"{tmp_path}/none") and not path_exists(spark, f"file://{tmp_path}/none")
    os.makedirs(f"{tmp_path}/half/_temporary")
    assert not path_exists(spark, f"{tmp_path}/half")
    spark.range(1).write.parquet(f"{tmp_path}/full")
    os.remove(f"{tmp_path}/full/_SUCCESS")
    assert path_exists(spark, f"{tmp_path}/full") and path_exists(spark, f"file:{tmp_path}/full")
    with pytest.raises(Exception):  # noqa: B017 - an error is not "absent"
        path_exists(spark, "nosuchscheme://host/path")


def test_store_follows_its_inputs_and_skips_broken_attempts(spark, tmp_path):
    for name in os.listdir(SMALL):
        (tmp_path / name).symlink_to(f"{SMALL}/{name}")
    before = store.services_store(spark, str(tmp_path)).company.count()
    assert store.services_store(spark, str(tmp_path)).company.count() == before
    (tmp_path / "supplier.parquet").unlink()
    spark.read.parquet(f"{SMALL}/supplier.parquet").where("s_suppkey < 4").coalesce(1).write.parquet(f"{tmp_path}/supplier.parquet")
    assert store.services_store(spark, str(tmp_path)).company.count() < before


def test_working_tables_lie_in_one_folder_and_can_be_removed(spark):
    df = materialize(spark.range(3), "to-be-removed")
    assert df.count() == 3 and run_root(spark).startswith(shared_dir(spark))
    assert path_exists(spark, run_root(spark)) and callable(release_run)


def test_working_tables_are_written_without_overlong_code(spark, tmp_path):
    """Also in a session that was not made by ``get_session``: methods that the JIT refuses run many times slower."""
    from signalbox.session import counted
    name, seen = "spark.sql.codegen.hugeMethodLimit", []
    before = spark.conf.get(name)
    spark.conf.set(name, "65535")
    try:
        assert counted(spark.range(3), lambda df: (seen.append(spark.conf.get(name)), df.write.parquet(f"{tmp_path}/t"))) == 3
        assert seen == ["8000"] and spark.conf.get(name) == "65535"
    finally:
        spark.conf.set(name, before)

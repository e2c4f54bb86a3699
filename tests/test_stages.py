"""Stages that outlive their driver: what a restart reads, what it builds again, what it never reads."""

from __future__ import annotations

import glob
import os

import pytest
from pyspark.sql import functions as F

from depotline import stages
from depotline.plans import run
from depotline.plans.network import Network
from depotline.session import checkpoint_dir
from depotline.sources import sinks


@pytest.fixture()
def source(spark, tmp_path):
    spark.range(20).write.parquet(str(tmp_path / "in"))
    return str(tmp_path / "in")


def local(path):
    return path.removeprefix("file:")


def counted(built, label, df):
    def build():
        built.append(label)
        return df

    return build


def test_restart_reads_complete_stages_and_builds_the_rest(spark, source):
    built, data = [], spark.read.parquet(source)
    job = stages.Job(spark, "restart", [source])
    first = job.stage("first", counted(built, "first", data.withColumn("k", F.col("id") % 3)))
    failing = first.withColumn("x", F.when(F.col("id") == 19, F.raise_error(F.lit("lost"))).otherwise(F.lit(1)))
    with pytest.raises(Exception, match="lost"):
        job.stage("second", counted(built, "second", failing))
    again = stages.Job(spark, "restart", [source])  # as another driver would
    first = again.stage("first", counted(built, "first", data))
    second = again.stage("second", counted(built, "second", first.groupBy("k").count()))
    assert built == ["first", "second", "second"]
    assert first.columns == ["id", "k"] and sorted(map(tuple, second.collect())) == [(0, 7), (1, 7), (2, 6)]
    assert again.close() and not again.close()
    assert not glob.glob(f"{local(checkpoint_dir(spark))}/jobs/restart")


def test_changed_inputs_and_code_give_other_stages(spark, source, monkeypatch):
    built = []

    def once():
        return stages.Job(spark, "inputs", [source]).stage("s", counted(built, "s", spark.read.parquet(source))).count()

    assert [once(), once()] == [20, 20] and len(built) == 1
    spark.range(5).write.mode("append").parquet(source)
    assert once() == 25 and len(built) == 2
    monkeypatch.setattr(stages, "code_digest", lambda: "another version")
    assert once() == 25 and len(built) == 3
    other = stages.Job(spark, "inputs", [source], "threshold 2")
    assert other.stage("s", counted(built, "s", spark.range(1))).count() == 1 and len(built) == 4
    other.close()
    assert not os.path.exists(f"{local(checkpoint_dir(spark))}/jobs/inputs")


def test_leftovers_without_a_marker_are_not_read(spark, source):
    job = stages.Job(spark, "killed", [source])
    spark.range(3).write.parquet(f"{job._folder}/s/attempt-dead")  # complete files, but never committed
    assert job.stage("s", lambda: spark.range(7)).count() == 7
    assert stages.Job(spark, "killed", [source]).stage("s", lambda: spark.range(1)).count() == 7
    job.close()


def test_without_a_name_nothing_is_reused(spark):
    built = []
    for _ in range(2):
        assert stages.stored(None, "s", counted(built, "s", spark.range(4))).count() == 4
    assert built == ["s", "s"]


@pytest.mark.parametrize("name", ["", "a/b", "..", "."])
def test_names_stay_inside_their_folder(spark, name):
    with pytest.raises(ValueError, match="name"):
        stages.Job(spark, name, [])


def test_empty_stage_keeps_its_columns(spark):
    job = stages.Job(spark, "empty", [])
    assert job.stage("s", lambda: spark.range(0)).columns == ["id"]
    assert stages.Job(spark, "empty", []).stage("s", lambda: spark.range(1)).count() == 0
    job.close()


def test_killed_marts_resume(spark, sf_dir, tmp_path, monkeypatch):
    """The export fails at its fourth mart; the restart finds weekly grain, stock and plan, and gives the same marts."""
    source, root = Network.from_benchmark(spark, sf_dir), str(tmp_path)
    tables = {
        "daily_demand": source.demand, "event_calendar": source.calendar, "sku_master": source.skus, "warehouses": source.warehouses,
        "warehouse_region_costs": source.lanes.withColumn("carbon_kg_per_unit", F.lit(0.0)), "starting_inventory": source.stock,
    }
    for name, df in tables.items():
        sinks.write_processed(df, name, root)
    plain = {name: spark.read.parquet(path).count() for name, path in run.export_marts(spark, root).items()}
    built = []
    for name in ("weekly", "plan"):
        whole = getattr(Network, name)
        monkeypatch.setattr(Network, name, lambda self, *a, whole=whole, name=name: (built.append(name), whole(self, *a))[1])
    write = sinks.write_table
    with monkeypatch.context() as m:
        m.setattr(sinks, "write_table", lambda df, path, *a, **k: (_ for _ in ()).throw(RuntimeError("killed")) if "cost" in path else write(df, path, *a, **k))
        with pytest.raises(RuntimeError, match="killed"):
            run.export_marts(spark, root, job="marts-test")
    assert sorted(built) == ["plan", "weekly"]
    resumed = {name: spark.read.parquet(path).count() for name, path in run.export_marts(spark, root, job="marts-test").items()}
    assert sorted(built) == ["plan", "weekly"] and resumed == plain
    assert not os.path.exists(f"{local(checkpoint_dir(spark))}/jobs/marts-test")

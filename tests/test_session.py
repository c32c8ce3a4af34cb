from __future__ import annotations

from types import SimpleNamespace

import pytest

from trackspark.session import fresh_path, shared_dir


def fake(master, named=None, current=None):
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: current)
    return SimpleNamespace(conf={"spark.checkpoint.dir": named} if named else {}, sparkContext=context)


def test_the_folder_the_cluster_names_comes_first():
    assert shared_dir(fake("yarn", "hdfs:/shared", "hdfs:/other")) == "hdfs:/shared"
    assert shared_dir(fake("yarn", None, "hdfs:/other")) == "hdfs:/other"


def test_no_local_folder_on_a_cluster():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(fake("yarn"))


def test_fresh_paths_differ(spark):
    a, b = fresh_path(spark, "x"), fresh_path(spark, "x")
    assert a != b and a.startswith(shared_dir(spark))


def test_time_zone_and_adaptive_execution(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"

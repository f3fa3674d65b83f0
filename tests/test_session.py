from types import SimpleNamespace

import pytest

from edgeloom.session import DEFAULTS, scratch_path


def session_with(**conf):
    settings = {key.replace("_", "."): value for key, value in conf.items()}
    return SimpleNamespace(conf=SimpleNamespace(get=settings.get))


def test_scratch_is_in_the_folder_the_cluster_names():
    spark = session_with(spark_master="yarn", spark_checkpoint_dir="hdfs:///shared/")
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first.startswith("hdfs:///shared/edgeloom/x-") and first != second


def test_no_machine_local_scratch_on_a_cluster():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(session_with(spark_master="yarn"), "x")


def test_local_session_may_use_a_temporary_folder():
    assert "/edgeloom/x-" in scratch_path(session_with(spark_master="local[2]"), "x")


def test_defaults_are_applied(spark):
    assert all(spark.conf.get(key) == value for key, value in DEFAULTS.items())
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"

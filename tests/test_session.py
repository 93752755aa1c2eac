"""Shared-folder handling: the session's spark.checkpoint.dir is used, never a private temp dir."""

import pytest

from airlens.session import cluster_settings, ensure_checkpoint_dir, scratch_path


def test_scratch_lives_under_the_session_checkpoint_dir(spark):
    root = ensure_checkpoint_dir(spark)
    configured = spark.conf.get("spark.checkpoint.dir", None)
    set_in_spark = spark.sparkContext.getCheckpointDir()
    assert set_in_spark.startswith(root.rstrip("/")) or root == set_in_spark
    if configured:
        assert root.rstrip("/").endswith(configured.rstrip("/"))
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(root.rstrip("/") + "/airlens/x-")


def test_cluster_settings_scale_with_the_cluster():
    small, big = cluster_settings(64, 1.0), cluster_settings(8000, 100.0)
    assert int(small["spark.sql.shuffle.partitions"]) == 2048
    assert int(big["spark.sql.shuffle.partitions"]) == 200_000
    assert big["spark.sql.adaptive.enabled"] == "true"


def test_a_cluster_without_a_shared_folder_is_refused():
    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())

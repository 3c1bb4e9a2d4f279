"""Session helpers: cluster settings and the shared checkpoint folder."""

from __future__ import annotations

from sparksignal.session import checkpoint_dir, cluster_conf, scratch_path


def test_cluster_conf_sizes_partitions():
    conf = cluster_conf(executors=1000, cores_per_executor=8, input_bytes=100 << 40)
    assert int(conf["spark.sql.shuffle.partitions"]) == (100 << 40) // (256 << 20)
    assert conf["spark.sql.adaptive.enabled"] == "true"
    assert int(cluster_conf(10, 4)["spark.sql.shuffle.partitions"]) == 120


def test_checkpoint_dir_is_stable_and_scratch_paths_are_fresh(spark):
    first = checkpoint_dir(spark)
    assert checkpoint_dir(spark) == first
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(first.rstrip("/"))
    assert spark.conf.get("spark.ui.enabled") == "false"

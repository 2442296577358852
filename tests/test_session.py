"""Session helpers: active session reuse, shared folder, cluster sizing."""

from scoreline.session import cluster_conf, get_spark, scratch_path, shared_dir


def test_active_session_is_reused(spark):
    assert get_spark() is spark


def test_scratch_paths_live_under_the_checkpoint_dir(spark):
    base = shared_dir(spark)
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a.startswith(base) and b.startswith(base) and a != b


def test_cluster_conf_scales_with_input():
    small, big = cluster_conf(10 << 30), cluster_conf(100 * 10**12)
    assert int(small["spark.sql.shuffle.partitions"]) == 200
    assert int(big["spark.sql.shuffle.partitions"]) > 300_000
    assert big["spark.sql.autoBroadcastJoinThreshold"] == "-1"
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"

"""Cluster sizing and checkpoint folder rules."""

from slotwise.session import SESSION_CONF, checkpoint_dir, cluster_conf


def test_cluster_conf_scales_with_input():
    small, big = cluster_conf(1 << 30), cluster_conf(100 << 40)
    assert int(small["spark.sql.shuffle.partitions"]) == 200          # floor
    assert int(big["spark.sql.shuffle.partitions"]) == (100 << 40) // (128 << 20)
    # buckets follow the input without a cap, in powers of two
    buckets = int(big["slotwise.buckets"])
    assert buckets & (buckets - 1) == 0 and 1 / 8 <= buckets / int(big["spark.sql.shuffle.partitions"]) <= 1 / 2
    for k, v in SESSION_CONF.items():
        assert big[k] == v


def test_checkpoint_dir_comes_from_the_session(spark):
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert checkpoint_dir(spark) == configured

"""Session helpers: defaults respect the launcher, sizing scales with cores."""

from lakemart.session import apply_cluster_conf, apply_defaults, checkpoint_dir, cluster_conf


def test_defaults_keep_launcher_settings(spark):
    # conftest's launcher set 8 shuffle partitions explicitly: defaults must not touch it.
    apply_defaults(spark)
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    keys = list(cluster_conf(8000))
    saved = {k: spark.conf.get(k, None) for k in keys}
    try:
        apply_cluster_conf(spark, 8000)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "8"
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == str(256 * 1024 * 1024)
    finally:  # the session is shared with the other tests
        for k, v in saved.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_cluster_conf_scales():
    small, big = cluster_conf(8), cluster_conf(8000)
    assert int(small["spark.sql.shuffle.partitions"]) == 200
    assert int(big["spark.sql.shuffle.partitions"]) == 32000
    assert int(big["spark.sql.adaptive.coalescePartitions.initialPartitionNum"]) == 64000


def test_checkpoint_dir_is_reused(spark):
    assert checkpoint_dir(spark) == checkpoint_dir(spark)

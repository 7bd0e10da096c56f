"""Session defaults and cluster-safe scratch locations."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every lakemart job relies on. They are applied only where the
# session (cluster config, spark-submit --conf) has not set them already.
DEFAULT_CONF = {
    # Oracle comparisons and date_trunc results must not depend on the host zone.
    "spark.sql.session.timeZone": "UTC",
    # AQE: runtime coalescing of small shuffle partitions, broadcast conversion
    # from measured sizes, and splitting of skewed join partitions (one key may
    # hold a third of all rows, e.g. the "unassigned" employee 0).
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def cluster_conf(total_cores: int) -> dict:
    """Shuffle and scan sizing for a cluster with ``total_cores`` executor cores.

    Partition counts start high (several waves per core) and AQE coalesces
    them to ~128 MB each at runtime, so no shuffle partition has to hold more
    than an executor core's share of memory, whatever the data volume; scan
    splits of 256 MB of parquet shrink further after column pruning. Skewed
    join partitions above 512 MB (and 5x the median) are split by AQE.
    """
    return {
        "spark.sql.shuffle.partitions": str(max(200, 4 * total_cores)),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(max(400, 8 * total_cores)),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
        "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * 1024 * 1024),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    }


def apply_cluster_conf(spark: SparkSession, total_cores: int) -> SparkSession:
    """Apply :func:`cluster_conf` where the cluster has not set a value."""
    for k, v in cluster_conf(total_cores).items():
        if not _explicitly_set(spark, k):
            spark.conf.set(k, v)
    return spark


def get_session(master: str | None = None, app_name: str = "lakemart",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with lakemart's defaults.

    On a cluster, call with ``master=None`` so the launcher decides. Local
    tests pass ``master="local[8]"`` and a small ``shuffle_partitions``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        # No web UI on local runs: it would open a port.
        builder = builder.config("spark.ui.enabled", "false")
        builder = builder.config("spark.driver.memory", os.environ.get("LAKEMART_DRIVER_MEMORY", "8g"))
    # Reliable checkpoint files are removed once their DataFrame is garbage-collected.
    builder = builder.config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    apply_defaults(spark)
    return spark


def _explicitly_set(spark: SparkSession, key: str) -> bool:
    """True when the launcher (spark-submit / builder) set ``key`` itself;
    ``spark.conf.get`` would also return Spark's built-in default. Without a
    local SparkContext (Spark Connect) the launcher's choice cannot be seen,
    so it is treated as set and left alone."""
    try:
        return spark.sparkContext.getConf().contains(key)
    except Exception:  # Spark Connect: no SparkContext on the client
        return True


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Set lakemart's SQL defaults on an existing session unless the launcher set them.
    The session time zone is always pinned to UTC (date truncation must not
    depend on the host)."""
    for k, v in DEFAULT_CONF.items():
        if k == "spark.sql.session.timeZone" or not _explicitly_set(spark, k):
            spark.conf.set(k, v)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    On a cluster this setting must point at shared storage (HDFS/S3/ABFS);
    lakemart never invents a machine-local folder there. Only when the setting
    is absent (local tests) a fresh scratch folder is created and registered.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: checkpoints follow the server's configuration
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("spark.checkpoint.dir is not set on the server")
        return configured
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return configured
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set: point it at shared storage "
                           "(HDFS/S3/ABFS); a machine-local folder would not survive executor loss")
    local = tempfile.mkdtemp(prefix="lakemart-ckpt-")
    spark.conf.set("spark.checkpoint.dir", local)
    sc.setCheckpointDir(local)
    return local


def shuffled(df):
    """``df`` as the side of a join that is hashed and grows with the input: both sides are shuffled by the key, and
    nothing passes through the driver. Without the hint Spark broadcasts by the bytes of compressed
    files, or of short rows, which a hashed relation exceeds many times."""
    return df.hint("shuffle_hash")


def materialize(df):
    """Eagerly write ``df`` to the shared checkpoint folder and cut its lineage.

    Used for small intermediate results that later steps read many times
    (e.g. a forecast's training series feeding several scalar fits), so the
    upstream scan and aggregation run once. Reliable checkpoints survive the
    loss of an executor, unlike cached or locally checkpointed blocks.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)

"""Session construction and cluster-wide settings.

Everything that depends on the cluster (checkpoint folder, shuffle width)
is *read* from the active session; defaults are only filled in when unset,
which is the local/test case.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings that matter for correctness, independent of cluster size.
CORRECTNESS_CONF = {
    # Business dates are compared as wall-clock UTC, like the oracle.
    "spark.sql.session.timeZone": "UTC",
}

# Settings that matter for throughput at scale.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # 128 MiB splits keep a 100 TB scan at ~800k tasks; AQE coalesces
    # the shuffle side down from spark.sql.shuffle.partitions.
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.parquet.aggregatePushdown": "true",
}


def get_spark(master: str | None = None, app: str = "saleswh",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Return (or create) a session configured for the warehouse.

    On a cluster ``master`` is None and the launcher's settings win; only
    keys that are not set yet receive our defaults.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(CORRECTNESS_CONF)
    conf.update(SCALE_CONF)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if extra:
        conf.update(extra)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the correctness settings to an existing session (driver-made)."""
    for k, v in CORRECTNESS_CONF.items():
        spark.conf.set(k, v)
    for k, v in SCALE_CONF.items():
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and committed tables.

    Read from ``spark.checkpoint.dir``.  Where it is unset, a local master
    gets a fresh scratch folder; on a cluster that is an error, as every
    executor would write to its own disk.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="saleswh-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    return d.rstrip("/")


def path_on(spark: SparkSession, path: str):
    """(file system, path) of a path in any store that Spark reads."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def work_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder (never machine-local on a cluster)."""
    return "/".join([checkpoint_dir(spark), *parts])

"""Session settings and the shared folder for materialised tables."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Settings every run relies on. Time zone: opt-in instants are converted
# explicitly; UTC keeps the rest of the session free of DST surprises.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcast only what was measured: static estimates can undercount
    # generators (explode) and joins, so the planner's estimate-based choice
    # is off, and AQE turns a join into a broadcast join only when the
    # finished shuffle stage of a side measured under 32 MB. No operator
    # forces a broadcast hint.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
}


# Sizing for a large cluster (applied by ``apply_cluster_defaults`` only where
# the session sets nothing): partitions are sized in bytes, not counted, so
# they stay within executor memory at any scale. AQE starts from many
# shuffle partitions and coalesces them to ~256 MB; a partition over 5x the
# median (and 512 MB) is split by the skew-join rule.
CLUSTER_DEFAULTS = {
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    # coalesce to the advisory size (the default favours parallelism and
    # ignores it, which leaves many tiny partitions on a large cluster)
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * 1024 * 1024),
    "spark.sql.adaptive.rebalancePartitionsSmallPartitionFactor": "0.2",
}


def apply_cluster_defaults(spark: SparkSession) -> None:
    """Set CLUSTER_DEFAULTS where the session has no explicit value."""
    explicit = {k for k, _ in spark.sparkContext.getConf().getAll()}
    for k, v in CLUSTER_DEFAULTS.items():
        if k not in explicit:
            spark.conf.set(k, v)


def build_session(master: str | None = None, shuffle_partitions: int = 8, app: str = "cohortlift",
                  extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(SESSION_CONF)
    conf.update({
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": os.environ.get("COHORTLIFT_DRIVER_MEMORY", "16g"),
    })
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_conf(spark: SparkSession) -> None:
    """Apply the run settings to an existing session (runtime-settable ones)."""
    for k, v in SESSION_CONF.items():
        spark.conf.set(k, v)


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``), read from the session.

    Unset, it is an error, except on a single-machine master, where one folder
    per application under /tmp stands in.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to storage shared by all executors")
        d = f"/tmp/cohortlift-{spark.sparkContext.applicationId}"
    return d.rstrip("/")

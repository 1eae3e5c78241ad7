"""SparkSession construction with the settings the builders rely on."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import SparkSession

#: Tables dealt by company are joined by company and month where they are: a company's
#: months are bounded by the calendar, so dealing by fewer keys cannot skew them.
JOIN_WHERE_DEALT = {"spark.sql.requireAllClusterKeysForCoPartition": "false"}

# Settings every builder assumes: UTC session clock (dates never shift),
# AQE on (runtime coalescing, skew-join splitting, SMJ->BHJ conversion on
# measured sizes), and a broadcast threshold that Catalyst applies to
# *measured/estimated* sizes, so nothing is broadcast blindly.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",  # checkpoint files go with their DataFrame
    **JOIN_WHERE_DEALT,
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "churnlens", extra: dict | None = None) -> SparkSession:
    """Return (or create) a session with BASE_CONF applied.

    On a cluster, ``master`` is left to spark-submit and shuffle partitions
    should be sized to ~128-256 MB per partition of the largest shuffle
    (events-scale inputs); locally we default to the core count.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    for k, v in conf.items():
        if not k.startswith("spark.ui") and not k.startswith("spark.driver"):
            try:
                spark.conf.set(k, v)
            except Exception:  # static conf already fixed by an existing session
                pass
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir`` (a folder all executors share).

    Only a local master may run without that setting: it gets a private
    scratch folder. On a cluster a machine-local folder would be written on
    every executor's own disk, so the missing setting is an error there."""
    sc = spark.sparkContext
    active = sc.getCheckpointDir()
    if active:
        return active
    current = sc.getConf().get("spark.checkpoint.dir", None)
    if not current:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError(f"set spark.checkpoint.dir to a shared folder (master {sc.master})")
        current = tempfile.mkdtemp(prefix="churnlens-ckpt-")
    sc.setCheckpointDir(current)
    return sc.getCheckpointDir() or current

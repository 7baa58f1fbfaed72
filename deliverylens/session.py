"""Spark session and shared-storage helpers."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def get_spark(app: str = "deliverylens", cores: int | str = "*",
              shuffle_partitions: int = 8) -> SparkSession:
    """Local session with the settings the library assumes.

    On a cluster, pass your own session instead; only the time zone matters
    for results (durations are computed on wall-clock timestamps).
    """
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder for materialised tables: the cluster's ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a fresh folder under
    the system temp dir (as in tests); on a cluster the setting is required,
    because a machine-local folder would not survive executor loss.
    """
    sc = spark.sparkContext
    configured = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/...)")
    path = tempfile.mkdtemp(prefix="deliverylens-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path

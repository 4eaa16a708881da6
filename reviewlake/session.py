"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app: str = "reviewlake", extra: dict | None = None) -> SparkSession:
    """Session for tests, bench and local runs.

    On a cluster the deployment supplies master, memory and
    ``spark.checkpoint.dir``; this only fills in the query-engine settings
    the library relies on (AQE, UTC session time, no UI).
    """
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(master or f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or int(cpus)))
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


# Runtime SQL settings for large inputs (hundreds of TB): AQE picks the
# partition count from a generous start, skewed partitions are split, scan
# splits and shuffle partitions target about 256 MB.
SCALE_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.session.timeZone": "UTC",
}


def cluster_settings(spark: SparkSession, overrides: dict | None = None) -> SparkSession:
    """Apply ``SCALE_SETTINGS`` (and ``overrides``) to a running session."""
    for k, v in {**SCALE_SETTINGS, **(overrides or {})}.items():
        spark.conf.set(k, v)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Read from ``spark.checkpoint.dir`` (set by the cluster to a shared
    filesystem). Only a local session without it, as in tests, gets a scratch
    folder; elsewhere executors would write to their own disks, so it raises.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise RuntimeError(f"spark.checkpoint.dir is not set; on {master} it must name a folder that all executors share")
        d = tempfile.mkdtemp(prefix="reviewlake-ckpt-")
        try:
            spark.conf.set("spark.checkpoint.dir", d)
        except Exception:  # noqa: BLE001 - a read-only conf: the context setting below suffices
            pass
    spark.sparkContext.setCheckpointDir(d)
    return d

"""Session defaults and the shared working folder.

On a cluster the working folder is whatever ``spark.checkpoint.dir`` names
(shared storage). A private temporary folder is only created when that
setting is absent, which is the case for local tests.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def get_session(
    master: str | None = None,
    shuffle_partitions: int = 8,
    app_name: str = "tessera",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session with the settings the library assumes (UTC, ANSI, AQE, no UI)."""
    os.environ.setdefault("SPARK_LOCAL_IP", "127.0.0.1")
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = {
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.python.filterPushdown.enabled": "true",
        # checkpoint files go when nothing refers to them any more
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.ui.enabled": "false",
        "spark.driver.host": "127.0.0.1",
    }
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and landed tables.

    Reads ``spark.checkpoint.dir`` (or the directory already set on the
    context); only when neither is set does it create a private folder and
    register it, which is what happens in tests and local runs.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="tessera-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared working folder for one landed table."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/tessera-{name}-{uuid.uuid4().hex[:12]}"

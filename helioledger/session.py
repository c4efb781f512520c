"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    # Readings carry local wall-clock time without a zone.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A split of a skewed join is worth the extra exchange it may need.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A repeated field in a reading file keeps its last value.
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.ui.enabled": "false",
}


def get_session(master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings above; ``extra`` uses ``__`` for dots."""
    builder = SparkSession.builder.appName("helioledger")
    if master:
        builder = builder.master(master)
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    for name, value in extra.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


_local_root: str | None = None


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder for tables that cut lineage.

    The folder is the one the cluster names in ``spark.checkpoint.dir``.  Only a
    local session without that setting falls back to a temporary folder, because
    on a cluster executors do not share the driver's disk.
    """
    global _local_root
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        _local_root = _local_root or tempfile.mkdtemp(prefix="helioledger-")
        root = _local_root
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"

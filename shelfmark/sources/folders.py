"""The folder that all executors see."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def shared_root(spark: SparkSession) -> str:
    """spark.checkpoint.dir, else the context's checkpoint folder, else, on a local master alone, a temporary folder. Elsewhere
    one must be set: executors of other machines don't see the driver's disk."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = f"file://{tempfile.mkdtemp(prefix='shelfmark-')}"
    return root.rstrip("/")

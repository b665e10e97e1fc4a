"""The folder that driver and executors share."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

_local = ""


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; only in local mode, where it may be unset, a temporary one."""
    global _local
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        folder = _local = _local or "file://" + tempfile.mkdtemp(prefix="spark-tickloom-")
    return folder.rstrip("/")

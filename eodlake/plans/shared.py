"""The folder that driver and executors share, for tables that a job writes."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def fresh(spark: SparkSession, tag: str) -> str:
    """A new path under ``spark.checkpoint.dir`` (a temporary folder in local mode where that is unset); it goes with the driver's JVM."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", root)
    path = f"{root.rstrip('/')}/eodlake-{tag}-{uuid.uuid4().hex}"
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    return path

"""Folders for what queries write between steps."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder of spark.checkpoint.dir; where that is unset, and all runs on this machine as in tests, in a temporary one."""
    root = spark.conf.get("spark.checkpoint.dir", None) or getattr(spark, "_lexirank_scratch", None)
    if not root:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = spark._lexirank_scratch = "file://" + tempfile.mkdtemp(prefix="lexirank-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str = "step") -> DataFrame:
    """df as a written table: its lineage ends here."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

"""Durable intermediate tables in the folder that the cluster shares."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; where that is unset, and all runs on this machine as in tests, a new temporary one."""
    found = spark.conf.get("spark.checkpoint.dir", None) or getattr(spark, "_lexirank_dir", None)
    if not found:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="lexirank-")
        spark._lexirank_dir = found
    return found.rstrip("/")


def importable(spark: SparkSession) -> None:
    """Python workers of this session find the package where this process found it."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in paths.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, paths]))


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other call gets."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet into the shared folder and read it back: lineage ends there, and lost executors lose nothing."""
    path = new_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._lexirank_path = path
    return out


def discard(*frames: DataFrame) -> None:
    """Delete the files of tables that materialize() gave, once nothing reads them."""
    for df in frames:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df._lexirank_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)

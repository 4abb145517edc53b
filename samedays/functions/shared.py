"""The folder that driver and executors share, for tables that cut a lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir.

    Unset, a local session gets a temporary folder of its own. A cluster does not: its
    executors would each write to a disk of their own, so the job stops and says so.
    """
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="samedays-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def delete_at_exit(spark: SparkSession, path: str) -> None:
    """Have the driver delete what stands at a path when its session's process ends."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder where nothing is yet; what is written there is deleted when the session's process ends."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(target)
    delete_at_exit(spark, path)
    return path


def kept(frame: DataFrame) -> DataFrame:
    """The same rows, read from a table just written in the shared folder."""
    spark = frame.sparkSession
    path = f"{fresh_path(spark, 'kept')}/rows"
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)

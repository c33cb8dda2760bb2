"""Written stages: a table that several branches of a plan read is made once, in the folder that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Where it is unset, one under the warehouse, but only on one machine (master local)."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/checkpoints"
    return folder.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` to the shared folder and reads it again: its plan runs once, and a lost executor loses nothing of it."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    found = df.sparkSession.read.schema(df.schema).parquet(path)
    found._folder = path
    return found


def path_of(spark: SparkSession, path: str):
    """(file system, path) of Hadoop's, for a path of any store."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def drop(*stages: DataFrame) -> None:
    """Deletes stages that nothing will read again."""
    for df in stages:
        fs, path = path_of(df.sparkSession, df._folder)
        fs.delete(path, True)

"""Intermediate tables in the folder all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; where that is unset, one below the warehouse."""
    given = spark.conf.get("spark.checkpoint.dir", None)
    return given or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/checkpoints"


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh place for a table in the shared folder; what is there is deleted when the application ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    # A place that isn't there yet can't be marked, so it is made.
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(folder)
    files.deleteOnExit(folder)
    return path


def fixed(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: what is read twice is the same twice, and a lost executor costs one
    read. The folder is deleted when the application ends.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.mode("append").parquet(path)
    return spark.read.schema(df.schema).parquet(path)

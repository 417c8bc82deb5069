"""Helpers of the operators: the shared folder, written intermediate tables, names that clash with nothing."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; where that is unset, one below the warehouse."""
    given = spark.conf.get("spark.checkpoint.dir", None)
    return given or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/checkpoints"


def cut(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: lineage ends here, a lost executor costs one read.

    The folder is deleted when the application ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(conf).deleteOnExit(folder)
    return spark.read.schema(df.schema).parquet(path)


def released(batches: Iterator) -> Iterator:
    """The same Arrow batches; what Arrow's pool keeps of finished ones goes back to the system, as workers are used again."""
    for batch in batches:
        yield batch
        pa.default_memory_pool().release_unused()


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until ``df`` has no column of that name in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def importable(spark: SparkSession) -> None:
    """Lets Python workers import this package from where the driver has it; elsewhere ship it with ``--py-files``."""
    root, have = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in have.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, (root, have)))

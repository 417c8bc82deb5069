"""Tables written by earlier jobs, and the writers."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from veracity_prep.functions.scores import has_tags, size_text, two_decimals
from veracity_prep.operators.metadata import csv_ready
from veracity_prep.sources.files import or_empty


def write_table(df: DataFrame, path: str, *partitions: str, fmt: str = "parquet") -> None:
    """Write a table once, in one directory per part; the directory as a whole is the combined table.

    A CSV table gets a header and JSON text for nested columns.
    """
    if fmt == "csv":
        df = csv_ready(df)
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    if partitions:
        writer = writer.partitionBy(*partitions)
    writer.save(path)


def write_counted(df: DataFrame, path: str, *partitions: str, counts: Sequence[Column], fmt: str = "parquet") -> DataFrame:
    """Write a table and return the given aggregates over its rows as one row, both from the same pass."""
    seen = Observation()
    write_table(df.observe(seen, *counts), path, *partitions, fmt=fmt)
    row = seen.get
    return df.sparkSession.createDataFrame([tuple(row.values())], ", ".join(f"`{name}` bigint" for name in row))


def write_buckets(df: DataFrame, path: str, keys: Sequence[str], buckets: int) -> None:
    """Write a table in buckets of its keys, sorted by them: one file for each bucket that has rows."""
    spark, name = df.sparkSession, f"written_{uuid.uuid4().hex}"
    writer = df.repartition(buckets, *keys).write.mode("overwrite").format("parquet").option("path", path)
    writer.bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)
    # The catalog is only the way to the writer; the files are the table.
    spark.sql(f"DROP TABLE {name}")


def read_buckets(spark: SparkSession, path: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """A table of :func:`write_buckets`: joins and groupings by its keys need no exchange of its rows."""
    name, clustered = f"read_{uuid.uuid4().hex}", ", ".join(f"`{k}`" for k in keys)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema.fields)
    place = path.replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({clustered}) SORTED BY ({clustered}) "
        f"INTO {buckets} BUCKETS LOCATION '{place}'"
    )
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return table


def read_table(spark: SparkSession, path: str, schema: str, fmt: str = "parquet") -> DataFrame:
    """A written table, all parts together; an empty table of ``schema`` when there is none.

    In a CSV table an empty field is NULL and a quoted empty one the empty string, as the writer makes them.
    """

    def scan() -> DataFrame:
        reader = spark.read.schema(schema).format(fmt)
        # The mark for NULL is one that no field holds: as the empty string it would take quoted empty fields too.
        return (reader.options(header=True, nullValue="\x00", emptyValue="", multiLine=True) if fmt == "csv" else reader).load(path)

    return or_empty(spark, scan, schema)


def read_existing(spark: SparkSession, path: str) -> DataFrame:
    """A written Parquet table with the schema it was written with; a missing table is an error."""
    return spark.read.parquet(path)


def image_summary(images: DataFrame, *ids: str) -> DataFrame:
    """Flat summary of processed images: ids, path, ``WxH``, aspect ratio with two decimals and ``has_exif``."""
    size = F.col("original_size")
    return images.select(
        *ids,
        "processed_path",
        size_text(size[0], size[1]).alias("original_size"),
        two_decimals(F.col("aspect_ratio")).alias("aspect_ratio"),
        has_tags(F.col("exif")).alias("has_exif"),
    )

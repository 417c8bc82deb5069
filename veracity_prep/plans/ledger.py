"""The ledger of a preparation: which stage was finished from which inputs and settings."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veracity_prep.sources.files import or_empty

LEDGER = "stage string, fingerprint string, files bigint, finished timestamp"


def listing_mark(spark: SparkSession, root: str) -> tuple[int, int]:
    """Number of files below a root, and a mark of their names, times and sizes, from the listing alone."""

    def scan() -> DataFrame:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
        return files.select(F.col("path"), F.unix_micros("modificationTime").alias("time"), F.col("length"))

    files = or_empty(spark, scan, "path string, time bigint, length bigint")
    row = files.agg(F.count(F.lit(1)), F.coalesce(F.bit_xor(F.xxhash64("path", "time", "length")), F.lit(0))).first()
    return row[0], row[1]


def fingerprint(spark: SparkSession, roots: Iterable[str], settings: object, tables: Iterable[DataFrame] = ()) -> tuple[str, int]:
    """Fingerprint of the inputs of a stage, and how many files they are: the listings of ``roots``, the rows of small
    ``tables``, and the settings."""
    marks = [(root, *listing_mark(spark, root)) for root in sorted(roots)]
    rows = [list(t.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64(*t.columns))).first()) for t in tables]
    text = json.dumps([marks, rows, repr(settings)])
    return hashlib.sha256(text.encode()).hexdigest(), sum(m[1] for m in marks)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """All finished stages: ``stage, fingerprint, files, finished``."""
    return or_empty(spark, lambda: spark.read.schema(LEDGER).parquet(path), LEDGER)


def is_done(spark: SparkSession, path: str, stage: str, mark: str) -> bool:
    """Whether the last time a stage was finished, it had this fingerprint."""
    last = read_ledger(spark, path).where(F.col("stage") == stage).agg(F.max_by("fingerprint", "finished")).first()[0]
    return last == mark


def commit(spark: SparkSession, path: str, stage: str, mark: str, files: int) -> None:
    """Note a finished stage. It is the last thing a stage does, so an unfinished one is done again."""
    row = spark.createDataFrame([(stage, mark, files)], "stage string, fingerprint string, files bigint")
    row.withColumn("finished", F.current_timestamp()).coalesce(1).write.mode("append").parquet(path)

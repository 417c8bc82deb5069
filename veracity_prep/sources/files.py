"""Small helpers shared by the file scans."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def or_empty(spark: SparkSession, scan: Callable[[], DataFrame], schema: str) -> DataFrame:
    """The scan, or an empty table of ``schema`` when its path does not exist."""
    try:
        return scan()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def plain_path(path: Column) -> Column:
    """A file path without percent-escapes."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))

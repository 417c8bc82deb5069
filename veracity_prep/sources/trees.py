"""File trees: one listing, and compaction into a table that later jobs read instead of the tree."""

from __future__ import annotations

import uuid
from collections.abc import Collection
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veracity_prep.operators.shared import fixed
from veracity_prep.sources.files import or_empty, plain_path

_FILE = "path string, modified timestamp, length bigint, role string, value string"
#: A file of a compacted tree: its content as text, and the run that read it.
_HELD = "path string, modified timestamp, length bigint, value string, batch string, role string"
_GONE = "path string, modified timestamp, batch string"
_SAME = ["path", "modified"]


class Compaction(NamedTuple):
    """Files a compaction read, and files of earlier ones that no longer hold."""

    read: int
    gone: int


def role_of(path: Column, roles: dict[str, str]) -> Column:
    """The first role whose pattern the path matches; NULL for other files."""
    return F.coalesce(*[F.when(path.rlike(pattern), name) for name, pattern in roles.items()])


def tree_files(spark: SparkSession, root: str, roles: dict[str, str], glob: str = "*") -> DataFrame:
    """``path, modified, length, role, value`` of the files below ``root`` that have a role; a missing root has none.

    The tree is listed once, here; all that is derived from the result shares that listing. All columns but ``value``
    come from the listing: filters on them choose the files before any is opened, and without ``value`` none is.
    """

    def scan() -> DataFrame:
        files = spark.read.format("binaryFile").options(recursiveFileLookup=True, pathGlobFilter=glob).load(root)
        path = plain_path(F.col("_metadata.file_path"))
        return files.select(
            path.alias("path"),
            F.col("_metadata.file_modification_time").alias("modified"),
            F.col("_metadata.file_size").alias("length"),
            role_of(path, roles).alias("role"),
            F.col("content").cast("string").alias("value"),
        ).where(role_of(path, roles).isNotNull())

    return or_empty(spark, scan, _FILE)


def compact_tree(
    spark: SparkSession, root: str, table: str, roles: dict[str, str], glob: str = "*", names_only: Collection[str] = ()
) -> Compaction:
    """Bring the table of a tree up to date: files that are new or changed are read once, all others stay closed.

    The table has one directory for each role; the contents of roles in ``names_only`` are left out and never read. Files
    are told apart by path and modification time. What is new is the listing without what the table holds. The scan
    takes the files from the earliest time among the new ones on, without those that are there. The rows are dealt
    out so that the written files have even size, however small or uneven the read ones are. Entries whose file was
    changed or removed are noted as gone. Each step is one append, so a failed run is simply repeated.
    """
    files = tree_files(spark, root, roles, glob)
    listing = fixed(files.select(*_SAME), "listing")
    held = fixed(_held(spark, table).select(*_SAME, "batch"), "held")
    gone = fixed(held.join(listing, _SAME, "left_anti"), "gone")
    first, count = listing.join(held, _SAME, "left_anti").agg(F.min(F.unix_micros("modified")), F.count(F.lit(1))).first()
    if count:
        # A literal bound reaches the listing; what is left to compare with is only what came after it.
        since = F.col("modified") >= F.timestamp_micros(F.lit(first))
        bare = F.col("role").isin(*names_only)
        parts = [files.where(~bare), files.where(bare).withColumn("value", F.lit(None).cast("string"))]
        fresh = (parts[0].unionByName(parts[1]) if names_only else files).where(since).join(held.where(since), _SAME, "left_anti")
        rows = fresh.withColumn("batch", F.lit(uuid.uuid4().hex)).hint("rebalance", "role")
        rows.write.mode("append").partitionBy("role").parquet(f"{table}/files")
    lost = gone.count()
    if lost:
        gone.write.mode("append").parquet(f"{table}/gone")
    return Compaction(count, lost)


def _held(spark: SparkSession, table: str) -> DataFrame:
    """The files of the table that still hold."""
    files = or_empty(spark, lambda: spark.read.schema(_HELD).parquet(f"{table}/files"), _HELD)
    gone = or_empty(spark, lambda: spark.read.schema(_GONE).parquet(f"{table}/gone"), _GONE)
    return files.join(gone, [*_SAME, "batch"], "left_anti")


def compacted_files(spark: SparkSession, table: str) -> DataFrame:
    """``path, modified, length, value, role`` of a compacted tree; a filter on ``role`` prunes the other directories."""
    return _held(spark, table).drop("batch")

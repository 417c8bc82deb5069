"""Thread trees: ``<event>/{rumours,non-rumours}/<thread>/{source-tweets,reactions,annotation.json}``."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veracity_prep.sources.trees import compact_tree, compacted_files, role_of, tree_files

# Directory names of the tree.
TREE_ROOT = "all-rnr-annotated-threads"
_THREAD = r"/([^/]+)/(rumours|non-rumours)/([^/]+)/"
_SOURCE = _THREAD + r"source-tweets/([^/]+\.json)$"
_REACTION = _THREAD + r"reactions/(.+\.json)$"
_ANNOTATION = _THREAD + r"(annotation\.json)$"
ROLES = {"source": _SOURCE, "reaction": _REACTION, "annotation": _ANNOTATION}


class ThreadFiles(NamedTuple):
    """Files of a thread corpus by role, each ``event, kind, thread_id, file, value``.

    ``reaction_names`` lists all reaction files without their contents.
    """

    sources: DataFrame
    reactions: DataFrame
    annotations: DataFrame
    reaction_names: DataFrame


def thread_keys(path: Column, pattern: str) -> list[Column]:
    """Columns parsed from a file path."""
    names = ("event", "kind", "thread_id", "file")
    return [F.regexp_extract(path, pattern, i).alias(n) for i, n in enumerate(names, 1)]


def parse_thread_files(files: DataFrame) -> ThreadFiles:
    """Split ``path, value`` rows by the role of the file."""
    return thread_files(files.withColumn("role", role_of(F.col("path"), ROLES)))


def thread_files(files: DataFrame) -> ThreadFiles:
    """Split ``path, role, value`` rows by role."""

    def part(role: str) -> DataFrame:
        return files.where(F.col("role") == role).select(*thread_keys(F.col("path"), ROLES[role]), "value")

    reactions = part("reaction")
    return ThreadFiles(part("source"), reactions, part("annotation"), reactions.drop("value"))


def read_thread_files(spark: SparkSession, root: str) -> ThreadFiles:
    """Scan a thread corpus: listed once, and each role opens its own files only."""
    return thread_files(tree_files(spark, f"{root}/{TREE_ROOT}", ROLES, "*.json"))


def compact_threads(spark: SparkSession, root: str, table: str) -> ThreadFiles:
    """The same files from a compacted table, after what is new in the tree was added to it."""
    compact_tree(spark, f"{root}/{TREE_ROOT}", table, ROLES, "*.json")
    return thread_files(compacted_files(spark, table))

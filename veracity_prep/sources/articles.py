"""Article trees: ``<publisher>/{fake,real}/<article>/{news content.json,tweets/*.json}``."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veracity_prep.operators.metadata import ARTICLE_SOURCES
from veracity_prep.sources.trees import compact_tree, compacted_files, role_of, tree_files

# Directory and file names of the tree.
_ARTICLE = rf"/({'|'.join(ARTICLE_SOURCES)})/(fake|real)/([^/]+)/"
_CONTENT = _ARTICLE + r"(news(?: |%20)content\.json)$"
_TWEET = _ARTICLE + r"tweets/([^/]+\.json)$"
ROLES = {"content": _CONTENT, "tweet": _TWEET}


class ArticleFiles(NamedTuple):
    """Content files ``source, label, article_id, file, value`` and the names of the tweet files."""

    contents: DataFrame
    tweet_names: DataFrame


def _keys(path: Column, pattern: str) -> list[Column]:
    names = ("source", "label", "article_id", "file")
    return [F.regexp_extract(path, pattern, i).alias(n) for i, n in enumerate(names, 1)]


def parse_article_files(files: DataFrame) -> ArticleFiles:
    """Split ``path, value`` rows by the role of the file."""
    return article_files(files.withColumn("role", role_of(F.col("path"), ROLES)))


def article_files(files: DataFrame) -> ArticleFiles:
    """Split ``path, role, value`` rows by role."""
    path, role = F.col("path"), F.col("role")
    contents = files.where(role == "content").select(*_keys(path, _CONTENT), "value")
    return ArticleFiles(contents, files.where(role == "tweet").select(*_keys(path, _TWEET)))


def read_article_files(spark: SparkSession, root: str) -> ArticleFiles:
    """Scan an article corpus: listed once, and tweet files stay closed."""
    return article_files(tree_files(spark, root, ROLES, "*.json"))


def compact_articles(spark: SparkSession, root: str, table: str) -> ArticleFiles:
    """The same files from a compacted table, after what is new in the tree was added to it."""
    compact_tree(spark, root, table, ROLES, "*.json", names_only=["tweet"])
    return article_files(compacted_files(spark, table))

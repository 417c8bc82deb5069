"""Registration of queries, and the inputs they derive from the test tables.

The adapters are SQL that Spark and DuckDB read alike: ``{documents}`` stands for a table.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


class Inputs:
    """Test tables and adapters of one session."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._tables: dict[str, DataFrame] = {}

    def __call__(self, table: str) -> DataFrame:
        if table not in self._tables:
            self._tables[table] = self.spark.read.parquet(f"{self.sf_dir}/{table}.parquet")
        return self._tables[table]

    def adapt(self, sql: str) -> DataFrame:
        used = {t: self(t) for t in TABLES if "{" + t + "}" in sql}
        return self.spark.sql(sql, **used)

    def shared_folder(self) -> str:
        """A fresh folder in the place the cluster shares, or in the warehouse where none is set."""
        base = self.spark.conf.get("spark.checkpoint.dir", None) or self.spark.conf.get("spark.sql.warehouse.dir")
        return f"{base}/{uuid.uuid4().hex}"


def query(sql: str | None = None, name: str | None = None):
    """Register a function of ``Inputs`` under its name, with its SQL twin."""

    def add(fn):
        key = name or fn.__name__
        QUERIES[key] = lambda spark, sf_dir: fn(Inputs(spark, sf_dir))
        if sql is not None:
            SQL[key] = duck(sql)
        return fn

    return add


def duck(sql: str) -> str:
    """SQL with plain table names."""
    for t in TABLES:
        sql = sql.replace("{" + t + "}", t)
    return sql


# Text with web addresses.
LINKED_TEXT = """
    SELECT d.doc_id, concat(d.text, ' see ', coalesce(p.url, 'https://x.org/a?b=1'), ' or www.x.org now') AS text
    FROM {documents} d LEFT JOIN {pages} p ON d.doc_id = p.page_id
"""

# Statements with a six-way rating and the rating history of their speaker.
STATEMENTS = """
    SELECT concat(CAST(e.event_id AS STRING), '.json') AS id,
        CASE e.event_id % 10 WHEN 0 THEN 'valid' WHEN 1 THEN 'test' ELSE 'train' END AS split,
        CASE WHEN e.event_id % 97 = 0 THEN 'other' WHEN e.event_type = 'signup' THEN 'true'
            WHEN e.event_type = 'purchase' THEN 'mostly-true' WHEN e.event_type = 'view' THEN 'half-true'
            WHEN e.event_type = 'click' THEN 'barely-true' WHEN e.event_id % 2 = 0 THEN 'pants-fire'
            ELSE 'false' END AS label,
        concat('User ', CAST(e.user_id AS STRING), ' said the ', e.event_type, ' no. ', CAST(e.event_id AS STRING),
            ' is at https://x.org/', CAST(e.event_id AS STRING), ' or mail u', CAST(e.user_id AS STRING), '@x.org') AS statement,
        concat(e.event_type, ',news') AS subject,
        CAST(e.user_id AS STRING) AS speaker,
        CASE WHEN e.user_id % 5 = 0 THEN NULL ELSE concat('job', CAST(e.user_id % 7 AS STRING)) END AS job_title,
        'Ohio' AS state_info, 'none' AS party,
        CASE WHEN e.user_id % 11 = 0 THEN NULL ELSE CAST(h.barely AS DOUBLE) END AS barely_true_counts,
        CASE WHEN e.user_id % 11 = 0 THEN NULL ELSE CAST(h.wrong AS DOUBLE) END AS false_counts,
        CASE WHEN e.user_id % 11 = 0 THEN NULL ELSE CAST(h.half AS DOUBLE) END AS half_true_counts,
        CASE WHEN e.user_id % 11 = 0 THEN NULL ELSE CAST(h.mostly AS DOUBLE) END AS mostly_true_counts,
        CASE WHEN e.user_id % 11 = 0 THEN NULL ELSE CAST(h.pants AS DOUBLE) END AS pants_on_fire_counts,
        concat('event ', CAST(e.event_id AS STRING)) AS context
    FROM {events} e JOIN (
        SELECT user_id,
            sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS barely,
            sum(CASE WHEN event_type = 'error' AND event_id % 2 = 1 THEN 1 ELSE 0 END) AS wrong,
            sum(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS half,
            sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS mostly,
            sum(CASE WHEN event_type = 'error' AND event_id % 2 = 0 THEN 1 ELSE 0 END) AS pants
        FROM {events} GROUP BY user_id) h ON e.user_id = h.user_id
"""

# Tweets of conversation threads; the text is missing where ``has_text`` is 0.
TWEETS = """
    SELECT concat('e', CAST(conv_id % 4 AS STRING)) AS event,
        CASE WHEN conv_id % 3 = 0 THEN 'non-rumours' ELSE 'rumours' END AS kind,
        CAST(conv_id AS STRING) AS thread_id, turn, role, text,
        CASE WHEN (conv_id + turn) % 17 = 0 THEN 0 ELSE 1 END AS has_text,
        concat('t', lpad(CAST(turn AS STRING), 4, '0'), '.json') AS file
    FROM {conversations}
"""

# Annotations of threads: flags that may be absent, whole annotations missing for every 13th.
ANNOTATIONS = """
    SELECT l.doc_id,
        CASE WHEN l.doc_id % 11 = 0 THEN NULL ELSE l.toxic END AS misinformation,
        CASE WHEN l.doc_id % 7 = 0 THEN NULL ELSE l.quality END AS verified
    FROM {labels} l WHERE l.doc_id % 13 <> 0
"""

# Articles of two publishers with a fake/real label.
ARTICLES = """
    SELECT CASE WHEN d.doc_id % 2 = 0 THEN 'gossipcop' ELSE 'politifact' END AS source,
        CASE WHEN l.quality = 1 THEN 'real' ELSE 'fake' END AS label,
        concat('a', CAST(d.doc_id AS STRING)) AS article_id, d.doc_id,
        CASE WHEN d.doc_id % 13 = 0 THEN '' ELSE d.text END AS text,
        CASE WHEN d.doc_id % 26 = 0 THEN NULL ELSE concat('t', CAST(d.doc_id AS STRING)) END AS title,
        CASE WHEN d.doc_id % 39 = 0 THEN NULL ELSE d.lang END AS description,
        d.source AS author
    FROM {documents} d JOIN {labels} l ON d.doc_id = l.doc_id
"""

# Images of articles, some of an unknown publisher and some without an article.
ARTICLE_IMAGES = """
    SELECT CASE WHEN p.page_id % 10 = 9 THEN 'other' WHEN p.page_id % 2 = 0 THEN 'gossipcop' ELSE 'politifact' END AS source,
        CASE WHEN p.page_id % 3 = 0 THEN 'real' ELSE 'fake' END AS label,
        CASE WHEN p.page_id % 25 = 7 THEN '' ELSE concat('a', CAST(p.page_id AS STRING)) END AS article_id,
        concat('img_', CAST(k.k AS STRING), '.jpg') AS original_filename,
        concat('content_', CAST(p.page_id AS STRING), '.json') AS content_file,
        concat('/raw/', CAST(p.page_id AS STRING), '/img_', CAST(k.k AS STRING), '.jpg') AS original_path,
        concat('/done/', CAST(p.page_id AS STRING), '_img_', CAST(k.k AS STRING), '.jpg') AS processed_path,
        CAST(100 + p.page_id % 50 AS INT) AS width, CAST(80 + p.page_id % 30 AS INT) AS height
    FROM {pages} p JOIN (SELECT 1 AS m, 0 AS k UNION ALL SELECT 2 AS m, 0 AS k UNION ALL SELECT 2 AS m, 1 AS k
        UNION ALL SELECT 3 AS m, 0 AS k UNION ALL SELECT 3 AS m, 1 AS k UNION ALL SELECT 3 AS m, 2 AS k) k ON k.m = p.page_id % 4
"""

# Lines of an image list: ragged, with mixed-case annotations and blanks around.
IMAGE_LINES = """
    SELECT concat(CASE WHEN page_id % 5 = 0 THEN '  ' ELSE '' END, 'im', CAST(page_id AS STRING), chr(9), url, chr(9),
        CASE page_id % 5 WHEN 0 THEN 'fake' WHEN 1 THEN 'Real' WHEN 2 THEN 'FAKE' WHEN 3 THEN 'real' ELSE 'humor' END,
        CASE WHEN page_id % 12 = 0 THEN '' ELSE concat(chr(9), 'ev', CAST(page_id % 6 AS STRING)) END,
        CASE WHEN page_id % 15 = 1 THEN concat(chr(9), 'more') ELSE '' END) AS value
    FROM {pages}
"""

# Lines of a tweet mapping; some images are in no list.
TWEET_LINES = """
    SELECT concat('tw', CAST(event_id AS STRING), chr(9), 'im', CAST(event_id % 300 AS STRING), chr(9), 'fake',
        CASE WHEN event_id % 50 = 3 THEN '' ELSE concat(chr(9), event_type) END) AS value
    FROM {events}
"""

# Image files by class, with repeated stems and other files between them.
IMAGE_FILES = """
    SELECT concat('/data/images/', CASE WHEN p.page_id % 5 IN (0, 2) THEN 'fake' ELSE 'real' END, '/im',
        CAST(p.page_id AS STRING), x.ext) AS path, CAST(10 + p.page_id AS INT) AS width, 10 AS height
    FROM {pages} p JOIN (SELECT 0 AS r, '.png' AS ext UNION ALL SELECT 0 AS r, '.jpg' AS ext
        UNION ALL SELECT 3 AS r, '.gif' AS ext UNION ALL SELECT 6 AS r, '.jpeg' AS ext
        UNION ALL SELECT 6 AS r, '.txt' AS ext) x ON p.page_id % 9 = x.r
"""

# Labelled items for splits; documents without a label are unknown.
SPLIT_ITEMS = """
    SELECT CAST(d.doc_id AS STRING) AS id, d.source,
        CASE WHEN l.doc_id IS NULL THEN 'unknown' WHEN l.quality = 0 THEN 'false' WHEN l.toxic = 1 THEN 'mixed'
            ELSE 'true' END AS label, 'documents' AS dataset
    FROM {documents} d LEFT JOIN {labels} l ON d.doc_id = l.doc_id
"""

"""Metadata, links, statistics and integration over the derived corpora."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import sqltext as S
from checks.articles import ITEMS as ARTICLE_ITEMS
from checks.articles import articles
from checks.statements import LABEL, SCORE, statements
from checks.tables import ARTICLE_IMAGES, STATEMENTS, Inputs, query
from checks.threads import THREADS, threads
from veracity_prep.functions.scores import aspect_ratio
from veracity_prep.functions.text import ENGLISH_STOPWORDS
from veracity_prep.operators.metadata import article_image_links, flat_metadata, last_by_key
from veracity_prep.operators.stats import (
    dataset_statistics,
    distribution,
    item_counts,
    presence_counts,
    value_counts,
)
from veracity_prep.plans.integrate import (
    TEXT_KEYS,
    article_image_records,
    build_metadata,
    corpus_texts,
    integrate,
    simplify,
    single_images,
)
from veracity_prep.sources.processed import read_buckets, write_buckets


def article_images(t: Inputs):
    w, h = F.col("width"), F.col("height")
    images = t.adapt(ARTICLE_IMAGES).select(
        "source", "label", "article_id", "original_filename", "content_file", "original_path", "processed_path",
        F.array(w, h).alias("original_size"), aspect_ratio(w, h).alias("aspect_ratio"), F.lit("jpg").alias("format"),
    )
    return images


def corpora(t: Inputs):
    return {"statements": statements(t), "threads": threads(t), "articles": articles(t)}


def combined(t: Inputs):
    return build_metadata(corpora(t), article_image_links(article_images(t))).combined


def links_sql(list_rows: int) -> str:
    """Number of links of each article, and the JSON of the first ``list_rows`` of them."""
    return f"""SELECT source, article_id, max(of_article) AS n,
        string_agg(concat('{{"path":"', processed_path, '","original_path":"', original_path, '","size":[', width, ',', height, ']'), '+'
        ORDER BY processed_path) FILTER (place <= {list_rows}) AS paths
    FROM (SELECT *, count(*) OVER (PARTITION BY source, article_id) AS of_article, row_number() OVER (PARTITION BY source, article_id ORDER BY processed_path) AS place
        FROM ({ARTICLE_IMAGES}) WHERE source IN ('gossipcop', 'politifact') AND article_id <> '') GROUP BY source, article_id"""


LINKS = links_sql(100_000)
COMBINED = f"""
    SELECT 'statements' AS dataset, id, '' AS source, {LABEL} AS label, label AS original_label, true AS has_text, false AS has_images,
        speaker, CAST({SCORE} AS DOUBLE) AS score, CAST(NULL AS VARCHAR) AS event, CAST(NULL AS VARCHAR) AS title, CAST(NULL AS BIGINT) AS image_count,
        CAST(NULL AS VARCHAR) AS article_id
    FROM ({STATEMENTS})
    UNION ALL SELECT 'threads', id, '', label, label, raw_text <> '', false, NULL, NULL, event, NULL, NULL, NULL FROM ({THREADS})
    UNION ALL SELECT 'articles', i.id, i.source, i.label, i.original_label, true, coalesce(l.n, 0) > 0, NULL, NULL, NULL, i.title, coalesce(l.n, 0), i.article_id
    FROM ({ARTICLE_ITEMS}) i LEFT JOIN ({LINKS}) l ON l.source = i.source AND l.article_id = i.article_id"""


@query(COMBINED)
def combined_metadata(t):
    return combined(t).select(
        "dataset", "id", "source", "label", "original_label", "has_text", "has_images", "speaker",
        F.round("reliability_score", 9).alias("score"), "event", "title", "image_count", "article_id",
    )


@query(
    f"""SELECT id, {LABEL} AS label, label AS original_label, subject, speaker, job_title AS speaker_job, context, '' AS source,
    true AS has_text, false AS has_images FROM ({STATEMENTS})"""
)
def statement_metadata(t):
    flat = flat_metadata(statements(t), "statements")
    assert "speaker_history" not in flat.columns
    return flat.select(
        "id", "label", "original_label", "subject", "speaker", "speaker_job", "context", "source", "has_text", "has_images"
    )


def linked_sql(list_rows: int) -> str:
    return f"""SELECT i.id, i.image_count AS declared_image_count, coalesce(l.n, 0) AS image_count, coalesce(l.n, 0) > 0 AS has_images,
        coalesce(l.paths, '') AS paths
    FROM ({ARTICLE_ITEMS}) i LEFT JOIN ({links_sql(list_rows)}) l ON l.source = i.source AND l.article_id = i.article_id"""


@query(linked_sql(100_000))
def linked_article_metadata(t):
    return _linked(t, 100_000)


@query(linked_sql(2))
def linked_article_metadata_in_chunks(t):
    """Two links to a row: the metadata hold the first ones, and count all."""
    return _linked(t, 2)


def _linked(t: Inputs, list_rows: int):
    links = article_image_links(article_images(t), list_rows)
    linked = build_metadata({"articles": articles(t)}, links).by_corpus["articles"]
    paths = bare_paths(F.col("image_paths"))
    return linked.select("id", "declared_image_count", "image_count", "has_images", paths.alias("paths"))


def bare_paths(paths):
    """JSON of links as the SQL makes it. The ratio is left out: its digits differ between engines."""
    bare = F.regexp_replace(paths, r',"aspect_ratio":[0-9.]+\}', "")
    return F.replace(F.regexp_replace(bare, r"^\[|\]$", ""), F.lit("],{"), F.lit("]+{"))


@query(f"SELECT coalesce(dataset, 'combined') AS dataset, count(*) AS n FROM ({COMBINED}) GROUP BY ROLLUP (dataset)")
def items_by_dataset(t):
    return item_counts(combined(t))


@query(f"SELECT dataset, label, count(*) AS n FROM ({COMBINED}) WHERE label IS NOT NULL GROUP BY dataset, label")
def class_distribution(t):
    return distribution(combined(t), "label")


@query(f"SELECT dataset, source, count(*) AS n FROM ({COMBINED}) GROUP BY dataset, source")
def source_distribution(t):
    return distribution(combined(t), "source")


@query(
    f"""SELECT dataset, count(*) FILTER (has_text) AS with_text, count(*) FILTER (has_images) AS with_images,
    count(*) FILTER (has_text AND has_images) AS with_both FROM ({COMBINED}) GROUP BY dataset"""
)
def presence_by_dataset(t):
    return presence_counts(combined(t))


@query(f"SELECT label, count(*) AS n FROM ({COMBINED}) GROUP BY label")
def label_counts(t):
    return value_counts(combined(t), "label")


_STATS = " UNION ALL ".join(
    f"SELECT {d} AS dataset, '{s}' AS statistic, '' AS key, count(*) FILTER ({c}) AS value FROM c {g}"
    for d, g in (("dataset", "GROUP BY dataset"), ("'combined'", ""))
    for s, c in (
        ("total_items", "true"),
        ("items_with_text", "has_text"),
        ("items_with_images", "has_images"),
        ("items_with_both", "has_text AND has_images"),
    )
) + "".join(
    f" UNION ALL SELECT {d}, '{s}', {k}, count(*) FROM c GROUP BY ALL"
    for d in ("dataset", "'combined'")
    for s, k in (("class_distribution", "label"), ("sources", "source"))
)


STATISTICS = f"WITH c AS ({COMBINED}) {_STATS}"


@query(STATISTICS)
def statistics_of_datasets(t):
    return dataset_statistics(combined(t))


# Repeated ids with a later position: the last one wins.
REPEATED = """SELECT CAST(user_id AS STRING) AS id, event_id AS position, event_type AS raw_text,
    concat(event_type, CAST(event_id AS STRING)) AS processed_text FROM {events}
    UNION ALL SELECT '' AS id, event_id AS position, 'x' AS raw_text, 'y' AS processed_text FROM {events} WHERE event_type = 'view'"""


@query(
    f"""SELECT id, raw_text, processed_text FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY position DESC) AS n
    FROM ({REPEATED})) WHERE n = 1 AND id <> ''"""
)
def last_text_by_id(t):
    return last_by_key(t.adapt(REPEATED), ["id"], "position", ["raw_text", "processed_text"])


TEXTS = f"""SELECT 'statements' AS dataset, id, statement AS raw_text, {S.preprocessed('c', ENGLISH_STOPWORDS)} AS processed_text
        FROM (SELECT id, statement, {S.clean_plain('statement')} AS c FROM ({STATEMENTS}))
    UNION ALL SELECT 'threads', id, raw_text, processed_text FROM ({THREADS})
    UNION ALL SELECT 'articles', id, raw_text, processed_text FROM ({ARTICLE_ITEMS})"""


@query(TEXTS)
def integrated_texts(t):
    return corpus_texts(corpora(t))


def records_sql(list_rows: int) -> str:
    """Image records of the articles with ``list_rows`` images to a row."""
    return f"""SELECT source, article_id, n, chunk, string_agg(concat(processed_path, ' ', original_filename, ' ', label, ' ',
        width, 'x', height), '|' ORDER BY processed_path) AS records
    FROM (SELECT *, count(*) OVER (PARTITION BY source, article_id) AS n,
            (row_number() OVER (PARTITION BY source, article_id ORDER BY processed_path) - 1) // {list_rows} AS chunk
        FROM ({ARTICLE_IMAGES}) WHERE article_id <> '') GROUP BY source, article_id, n, chunk"""


RECORDS = records_sql(100_000)


def record(i):
    return F.concat_ws(" ", i["path"], i["original_filename"], i["label"], F.array_join(i["original_size"].cast("array<string>"), "x"))


def _by_article(t: Inputs, list_rows: int):
    records = F.array_join(F.transform("items", record), "|").alias("records")
    return article_image_records(article_images(t), list_rows).select("source", "article_id", F.col("item_count").alias("n"), "chunk", records)


@query(RECORDS)
def images_by_article(t):
    return _by_article(t, 100_000)


@query(records_sql(2))
def images_by_article_in_chunks(t):
    """The same columns with two images to a row."""
    return _by_article(t, 2)


def _list_images(t: Inputs):
    return article_images(t).select(
        F.concat_ws("/", "source", "article_id").alias("image_id"),
        F.col("label").alias("annotation"), F.lit("ev").alias("event"), "processed_path", "original_size", "aspect_ratio", "format",
    )


@query(
    f"""SELECT image_id, path, annotation, width, height, ratio FROM (
        SELECT concat(source, '/', article_id) AS image_id, processed_path AS path, label AS annotation, width, height,
            round(width / height, 9) AS ratio, row_number() OVER (PARTITION BY source, article_id ORDER BY processed_path DESC) AS n
        FROM ({ARTICLE_IMAGES})) WHERE n = 1"""
)
def integrated_images(t):
    s = F.col("original_size")
    return single_images(_list_images(t)).select(
        "image_id", "path", "annotation", s[0].alias("width"), s[1].alias("height"), F.round("aspect_ratio", 9).alias("ratio")
    )


# The last record of each listed image, and a row of metadata for it that has no text.
SINGLE = f"""SELECT image_id, path, width, height FROM (
        SELECT concat(source, '/', article_id) AS image_id, processed_path AS path, width, height,
            row_number() OVER (PARTITION BY source, article_id ORDER BY processed_path DESC) AS n
        FROM ({ARTICLE_IMAGES})) WHERE n = 1"""


def single_metadata(t: Inputs):
    images = t.adapt(ARTICLE_IMAGES).select(F.concat_ws("/", "source", "article_id").alias("id"), "label").distinct()
    return flat_metadata(images, "images")


BUCKETS = 16


@query(
    f"""SELECT c.dataset, c.id, c.source, c.label, x.raw_text, x.processed_text, c.original_label, c.event,
        CASE WHEN c.dataset = 'articles' THEN coalesce(r.n, 0) ELSE 0 END AS n_images, coalesce(r.records, '') AS images
    FROM ({COMBINED}) c JOIN ({TEXTS}) x ON x.dataset = c.dataset AND x.id = c.id
    LEFT JOIN ({RECORDS}) r ON c.dataset = 'articles' AND r.source = c.source AND r.article_id = c.article_id
    UNION ALL SELECT 'images', m.id, '', m.label, NULL, NULL, m.label, NULL, 1, concat(s.path, ' ', s.width, 'x', s.height)
    FROM (SELECT DISTINCT concat(source, '/', article_id) AS id, label FROM ({ARTICLE_IMAGES})) m JOIN ({SINGLE}) s ON s.image_id = m.id"""
)
def simplified_items(t):
    metadata = combined(t).unionByName(single_metadata(t), allowMissingColumns=True)
    folder, whole = t.shared_folder(), corpora(t)
    tables = integrate(metadata, whole, _list_images(t), article_images(t), buckets=BUCKETS)
    write_buckets(tables.texts, folder, TEXT_KEYS, BUCKETS)
    tables = tables._replace(texts=read_buckets(t.spark, folder, TEXT_KEYS, BUCKETS))
    return simplify(tables).select(
        "dataset", "id", "source", "label", "text.raw_text", "text.processed_text",
        F.col("metadata.original_label").alias("original_label"), F.col("metadata.event").alias("event"),
        F.col("image_count").alias("n_images"),
        F.array_join(F.transform("images", record), "|").alias("images"),
    )

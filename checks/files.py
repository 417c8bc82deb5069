"""Scans and sinks: derived data are written to the shared folder as files and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import sqltext as S
from checks.articles import ITEMS as ARTICLE_ITEMS
from checks.articles import articles
from checks.images import LIST, MANIFEST, manifest
from checks.metadata import LINKS, bare_paths, combined
from checks.splits import STRATIFIED, items
from checks.statements import LABEL, SCORE, TOTAL
from checks.tables import IMAGE_LINES, STATEMENTS, Inputs, query
from checks.threads import THREADS, threads
from veracity_prep.functions.text import ENGLISH_STOPWORDS
from veracity_prep.operators.splits import stratified_split
from veracity_prep.plans.statements import load_statements
from veracity_prep.schemas import ARTICLE, THREAD
from veracity_prep.sources.images import read_image_list, read_manifest
from veracity_prep.sources.processed import read_existing, read_table, write_table
from veracity_prep.sources.statements import read_statements
from veracity_prep.sources.trees import compact_tree, compacted_files


def _statement_files(t: Inputs) -> str:
    """Statements as tab-separated files, the split in the file name."""
    folder = t.shared_folder()
    raw = t.adapt(STATEMENTS).select(
        "id", "label", "statement", "subject", "speaker", "job_title", "state_info", "party", "barely_true_counts",
        "false_counts", "half_true_counts", "mostly_true_counts", "pants_on_fire_counts", "context", "split",
    )
    names = {"train": "train.tsv", "valid": "valid.tsv", "test": "test.tsv"}
    for split, name in names.items():
        part = raw.where(F.col("split") == split).drop("split")
        part.write.options(sep="\t", emptyValue="", quote='"', escape='"').csv(f"{folder}/{name}")
    return folder


@query(
    f"""SELECT id, split, label, statement, job_title, barely_true_counts, pants_on_fire_counts, context FROM ({STATEMENTS})"""
)
def scan_statement_files(t):
    folder = _statement_files(t)
    out = None
    # Each written "file" is a folder of part files, so the split is the name of the folder here.
    for split in ("train", "valid", "test"):
        part = _read_parts(t, f"{folder}/{split}.tsv").withColumn("split", F.lit(split))
        out = part if out is None else out.unionByName(part)
    return out.select("id", "split", "label", "statement", "job_title", "barely_true_counts", "pants_on_fire_counts", "context")


def _read_parts(t: Inputs, folder: str):
    return read_statements(t.spark, folder, name_glob="*.csv").drop("split")


@query(
    f"""SELECT id, statement AS raw_text, {S.preprocessed('c', ENGLISH_STOPWORDS)} AS processed_text, label AS original_label,
        {LABEL} AS standard, speaker, job_title AS speaker_job, context, {SCORE} AS score
        FROM (SELECT *, {S.clean_plain('statement')} AS c FROM ({STATEMENTS}))"""
)
def statement_files_to_items(t):
    items = load_statements(t.spark, f"{_statement_files(t)}/*.tsv", name_glob="*.csv")
    m = [f"metadata.{c}" for c in ("speaker", "speaker_job", "context")]
    score = F.round("metadata.reliability_score", 9).alias("score")
    return items.select("id", "raw_text", "processed_text", "original_label", F.col("label").alias("standard"), *m, score)


@query(LIST)
def scan_image_list_file(t):
    folder = t.shared_folder()
    t.adapt(IMAGE_LINES).write.text(folder)
    return read_image_list(t.spark, f"{folder}/missing", folder)


@query(
    f"""SELECT source, label, article_id, unnest(string_split(images, '|')) AS image_file, content_file FROM ({MANIFEST})"""
)
def scan_image_manifest(t):
    folder = t.shared_folder()
    write_table(manifest(t), folder, fmt="json")
    return read_manifest(t.spark, folder, lines=True)


@query(f"SELECT id, event, label, reactions, reaction_count FROM ({THREADS})")
def scan_written_threads(t):
    folder = t.shared_folder()
    write_table(threads(t), folder, "event", fmt="json")
    back = read_table(t.spark, folder, THREAD, fmt="json")
    return back.select("id", "event", "label", F.array_join("reactions", "|").alias("reactions"), "reaction_count")


@query(
    f"""SELECT id, source, raw_text, processed_text, original_label, label, title, url, authors, image_urls, image_count, description, tweet_count
    FROM ({ARTICLE_ITEMS})"""
)
def scan_written_articles(t):
    folder = t.shared_folder()
    write_table(articles(t), folder, "source", "original_label")
    back, m = read_table(t.spark, folder, ARTICLE), F.col("metadata")
    return back.select(
        "id", "source", "raw_text", "processed_text", "original_label", "label",
        *[m[c].alias(c) for c in ("title", "url", "image_count", "description", "tweet_count")],
        F.array_join(m["authors"], "|").alias("authors"), F.array_join(m["image_urls"], "|").alias("image_urls"),
    )


# Every column of the combined metadata; a corpus has NULL in the columns of the others.
_OF_STATEMENTS = {
    "subject": "subject", "speaker": "speaker", "speaker_job": "job_title", "state": "state_info", "party": "party", "context": "context",
    "total_statements": TOTAL, "reliability_score": SCORE,
}
_OF_THREADS = {"event": "event", "rumor_id": "rumor_id", "non_rumor_id": "CASE WHEN NOT is_rumor THEN id END", "reaction_count": "reaction_count", "is_rumor": "is_rumor"}
_OF_ARTICLES = {
    "article_id": "i.article_id", "title": "i.title", "url": "i.url", "date_published": "''", "declared_image_count": "i.image_count", "description": "i.description",
    "tweet_count": "i.tweet_count", "image_count": "coalesce(l.n, 0)", "paths": "coalesce(l.paths, '')",
}


def _rest(own: dict[str, str]) -> str:
    names = [*_OF_STATEMENTS, *_OF_THREADS, *_OF_ARTICLES]
    return ", ".join(f"{own.get(n, 'NULL')} AS {n}" for n in names)


WHOLE_METADATA = f"""
    SELECT 'statements' AS dataset, id, '' AS source, {LABEL} AS label, label AS original_label, true AS has_text, false AS has_images, {_rest(_OF_STATEMENTS)} FROM ({STATEMENTS})
    UNION ALL SELECT 'threads', id, '', label, label, raw_text <> '', false, {_rest(_OF_THREADS)} FROM ({THREADS})
    UNION ALL SELECT 'articles', i.id, i.source, i.label, i.original_label, true, coalesce(l.n, 0) > 0, {_rest(_OF_ARTICLES)}
    FROM ({ARTICLE_ITEMS}) i LEFT JOIN ({LINKS}) l ON l.source = i.source AND l.article_id = i.article_id"""


@query(WHOLE_METADATA)
def scan_metadata_csv(t):
    folder = t.shared_folder()
    metadata = combined(t)
    write_table(metadata, folder, fmt="csv")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in metadata.schema.fields)
    back = read_table(t.spark, folder, schema, fmt="csv")
    return back.withColumn("reliability_score", F.round("reliability_score", 9)).withColumn("paths", bare_paths(F.col("image_paths"))).drop("image_paths")


@query(STRATIFIED)
def scan_written_split(t):
    folder = t.shared_folder()
    write_table(stratified_split(items(t)), folder, "split")
    return read_existing(t.spark, folder).select("id", "label", F.col("split").cast("string"), "copies")


# Roles of a tree of document files by the language in their directory; other languages have none.
TREE_ROLES = {"english": r"/lang=en/", "other": r"/lang=(?!en/)[a-z]+/"}


@query(
    """SELECT CASE WHEN lang = 'en' THEN 'english' ELSE 'other' END AS role, doc_id, source, md5(text) AS digest, doc_id % 2 AS wave
    FROM {documents} WHERE lang IS NOT NULL"""
)
def compacted_tree(t):
    """A tree of files that grows between two compactions: the second one reads only what came after the first."""
    tree, table = t.shared_folder(), t.shared_folder()
    docs = t("documents").where("lang is not null").withColumn("wave", F.col("doc_id") % 2)
    waves = []
    for wave in (0, 1):
        docs.where(F.col("wave") == wave).write.mode("append").partitionBy("lang", "source").json(tree)
        waves.append(compact_tree(t.spark, tree, table, TREE_ROLES, "*.json"))
    assert all(w.read > 0 and w.gone == 0 for w in waves) and compact_tree(t.spark, tree, table, TREE_ROLES, "*.json").read == 0
    source = F.regexp_extract("path", "/source=([^/]+)/", 1).alias("source")
    lines = compacted_files(t.spark, table).select("role", source, F.explode(F.split("value", "\n")).alias("line")).where("line <> ''")
    parsed = lines.withColumn("doc", F.from_json("line", "doc_id bigint, text string, wave bigint"))
    return parsed.select("role", "doc.doc_id", "source", F.md5("doc.text").alias("digest"), "doc.wave")

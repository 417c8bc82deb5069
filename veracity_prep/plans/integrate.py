"""Metadata of all corpora, the integrated tables and the simplified one-row-per-item table."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veracity_prep.operators.lists import chunked_lists, first_chunks
from veracity_prep.operators.metadata import flat_metadata, last_by_key, link_images, union_corpora
from veracity_prep.operators.stats import dataset_statistics
from veracity_prep.schemas import METADATA

#: Corpora whose items carry article images.
ARTICLES = "articles"
#: Corpus of single images.
IMAGES = "images"


class MetadataTables(NamedTuple):
    """Metadata of each corpus, of all corpora, and their statistics."""

    by_corpus: dict[str, DataFrame]
    combined: DataFrame
    statistics: DataFrame


def build_metadata(
    corpora: dict[str, DataFrame], article_links: DataFrame | None = None, spark=None
) -> MetadataTables:
    """Flat metadata of the processed corpora, article metadata linked to its images, all of it combined.

    ``article_links`` are those of :func:`~veracity_prep.operators.metadata.article_image_links`.
    Without any corpus (``spark`` given) the tables are empty.
    """
    by_corpus = {name: flat_metadata(items, name) for name, items in corpora.items()}
    if ARTICLES in by_corpus and article_links is not None:
        by_corpus[ARTICLES] = link_images(by_corpus[ARTICLES], article_links)
    combined = union_corpora(by_corpus.values())
    if combined is None:
        combined = spark.createDataFrame([], METADATA)
    return MetadataTables(by_corpus, combined, dataset_statistics(combined))


#: Keys of the texts, by which their table is bucketed.
TEXT_KEYS = ["dataset", "id"]


class IntegratedTables(NamedTuple):
    """Related tables of the integrated dataset; article image lists in chunks.

    ``buckets`` is the number of buckets of ``texts``, 0 where they aren't bucketed.
    """

    metadata: DataFrame
    texts: DataFrame
    images: DataFrame
    article_images: DataFrame
    buckets: int = 0


def corpus_texts(corpora: dict[str, DataFrame], buckets: int = 0) -> DataFrame:
    """Raw and processed text of each item, the last one where an id repeats: ``dataset, id, …``.

    With ``buckets`` the rows are dealt out by (dataset, id) into so many parts, once: the choice of the last one
    and :func:`~veracity_prep.sources.processed.write_buckets` keep that partitioning.
    """
    frames, kinds = [], {}
    for name, items in corpora.items():
        # Positions of different corpora have different types, and are compared inside a corpus only.
        kind = kinds.setdefault(items.schema["position"].dataType.simpleString(), f"_position_{len(kinds)}")
        frames.append(items.select(F.lit(name).alias("dataset"), "id", "raw_text", "processed_text", F.col("position").alias(kind)))
    texts = union_corpora(frames)
    texts = (texts.repartition(buckets, *TEXT_KEYS) if buckets else texts).withColumn("_position", F.struct(*kinds.values()))
    empty = F.lit("")
    return last_by_key(texts, TEXT_KEYS, "_position", ["raw_text", "processed_text"]).select(
        *TEXT_KEYS, F.coalesce("raw_text", empty).alias("raw_text"), F.coalesce("processed_text", empty).alias("processed_text")
    )


def _image_record(*extra: str) -> list[Column]:
    path = F.coalesce("processed_path", F.lit("")).alias("path")
    return [path, *[F.col(c) for c in extra], F.col("original_size"), F.col("aspect_ratio"), F.col("format")]


def single_images(images: DataFrame) -> DataFrame:
    """One record per image id, the last by path where an id repeats."""
    records = images.select("image_id", *_image_record("annotation", "event"))
    fields = ["path", "annotation", "event", "original_size", "aspect_ratio", "format"]
    return last_by_key(records, ["image_id"], "path", fields)


def article_image_records(images: DataFrame, list_rows: int = 100_000) -> DataFrame:
    """Image records of each article in chunks, by (source, article)."""
    present = images.where(F.coalesce(F.col("article_id"), F.lit("")) != "")
    record = F.struct(
        F.coalesce("processed_path", F.lit("")).alias("path"),
        *["original_filename", "source", "label", "original_size", "aspect_ratio", "format"],
    )
    return chunked_lists(present, ["source", "article_id"], record, list_rows)


def integrate(
    metadata: DataFrame,
    corpora: dict[str, DataFrame],
    images: DataFrame,
    article_images: DataFrame,
    list_rows: int = 100_000,
    buckets: int = 0,
) -> IntegratedTables:
    """Metadata, texts and images as related tables."""
    records = article_image_records(article_images, list_rows)
    return IntegratedTables(metadata, corpus_texts(corpora, buckets), single_images(images), records, buckets)


def simplify(tables: IntegratedTables) -> DataFrame:
    """One row per metadata row: ``dataset, id, source, label, text, image_count, images, metadata``.

    Texts are matched by (dataset, id), article images by (source, article), single images by id. ``image_count``
    counts all images of an item; ``images`` is empty where there are none and holds chunk 0 of the list of an
    article, whose following chunks, if there are any, stay rows of ``tables.article_images``.
    """
    metadata = tables.metadata
    names = metadata.columns
    kept = ["dataset", "id", "source", "label"]
    rest = F.struct(*[c for c in names if c not in kept]).alias("metadata")
    article_id = F.col("article_id") if "article_id" in names else F.lit(None).cast("string")
    text = F.struct("raw_text", "processed_text").alias("text")
    items = metadata.select(*kept, rest, article_id.alias("article_id"))

    absent = F.lit(None).cast("string")
    single = F.struct(
        "path",
        absent.alias("original_filename"),
        absent.alias("source"),
        absent.alias("label"),
        *["annotation", "event", "original_size", "aspect_ratio", "format"],
    )
    singles = tables.images.select(F.col("image_id").alias("id"), F.array(single).alias("images"))
    listed = F.transform(
        "items",
        lambda i: F.struct(
            *[i[c].alias(c) for c in ("path", "original_filename", "source", "label")],
            absent.alias("annotation"),
            absent.alias("event"),
            *[i[c].alias(c) for c in ("original_size", "aspect_ratio", "format")],
        ),
    )
    lists = first_chunks(tables.article_images).select("source", "article_id", "item_count", listed.alias("images"))

    # Each kind of corpus meets only its own images: in one join over all rows, the items without an article
    # would share a single key.
    none = F.array().cast(lists.schema["images"].dataType)
    found = F.when(F.col("item_count").isNull(), none).otherwise(F.col("images"))
    of_articles = items.where(F.col("dataset") == ARTICLES).join(lists, ["source", "article_id"], "left")
    of_images = items.where(F.col("dataset") == IMAGES).join(singles, "id", "left")
    others = items.where(~F.coalesce(F.col("dataset").isin(ARTICLES, IMAGES), F.lit(False)))
    zero = F.lit(0).cast("bigint")
    parts = [
        of_articles.withColumn("images", found).withColumn("image_count", F.coalesce("item_count", zero)),
        of_images.withColumn("images", F.coalesce("images", none)).withColumn("image_count", F.size("images").cast("bigint")),
        others.withColumn("images", none).withColumn("image_count", zero),
    ]
    # Texts come last: what is shuffled to meet them are narrow rows, and bucketed texts stay where they are.
    items = union_corpora([p.select(*kept, "image_count", "images", "metadata") for p in parts])
    if tables.buckets:
        items = items.repartition(tables.buckets, *TEXT_KEYS)
    whole = items.join(tables.texts.select(*TEXT_KEYS, text), TEXT_KEYS, "left")
    return whole.select(*kept, "text", "image_count", "images", "metadata")

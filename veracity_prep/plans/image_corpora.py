"""Image corpora: lists and manifests joined with the images on disk, and the plans of what to fetch."""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veracity_prep.functions.labels import annotation_bucket
from veracity_prep.functions.urls import extension_or_jpg
from veracity_prep.operators.lists import chunked_lists, first_chunks
from veracity_prep.operators.shared import shared_path
from veracity_prep.options import ImageOptions
from veracity_prep.sources.images import (
    files_by_stem,
    decode_images,
    image_paths,
    read_image_list,
    read_tweet_images,
)

CLASSES = ("fake", "real")

# Names of the two list files.
IMAGE_LIST_FILE = "set_images.txt"
TWEET_LIST_FILE = "tweets_images.txt"


def list_candidates(path: str, name: str) -> tuple[str, str]:
    """Where a list file may lie, the preferred place first."""
    return f"{path}/raw/{name}", f"{path}/{name}"


def listed_class(images: DataFrame, *classes: str) -> DataFrame:
    """List entries of the given classes, whatever the case; ``annotation`` becomes lower case."""
    lowered = images.withColumn("annotation", F.lower("annotation"))
    return lowered.where(F.col("annotation").isin(*(classes or CLASSES)))


def images_with_files(images: DataFrame, files: DataFrame) -> DataFrame:
    """List entries that have a file of their class and id."""
    return images.join(files, ["annotation", "image_id"])


def images_without_files(images: DataFrame, files: DataFrame) -> DataFrame:
    """List entries whose file is missing."""
    return images.join(files, ["annotation", "image_id"], "left_anti")


def image_tweets(mapping: DataFrame, list_rows: int = 100_000) -> DataFrame:
    """Tweets of each image in chunks."""
    return chunked_lists(mapping, ["image_id"], F.col("tweet_id"), list_rows)


def with_tweets(images: DataFrame, tweets: DataFrame) -> DataFrame:
    """Add ``tweet_count`` and ``tweet_ids``, both NULL for images no tweet uses.

    ``tweets`` are those of :func:`image_tweets`. ``tweet_count`` counts all tweets of an image, ``tweet_ids`` holds its
    chunk 0; the following chunks, if there are any, stay rows of ``tweets``.
    """
    renamed = first_chunks(tweets).select("image_id", F.col("item_count").alias("tweet_count"), F.col("items").alias("tweet_ids"))
    return images.join(renamed, "image_id", "left")


def _processed(images: DataFrame, target) -> list:
    """The columns common to all processed images, from columns of the property scan."""
    return [
        F.col("path").alias("original_path"),
        target.alias("processed_path"),
        F.array("width", "height").alias("original_size"),
        "aspect_ratio",
        "format",
        "exif",
    ]


def build_listed_images(
    images: DataFrame,
    properties: DataFrame,
    tweets: DataFrame,
    output: str,
    paths: DataFrame | None = None,
) -> DataFrame:
    """Processed images of a list: file, geometry, tags and the tweets that use them.

    The file of an id is chosen among all ``paths`` on disk (those of ``properties`` if there is no listing), valid
    or not; an entry whose chosen file is not a valid image is left out.
    """
    files = files_by_stem((properties if paths is None else paths).select("path"))
    found = images_with_files(listed_class(images), files).join(properties, "path")
    name = F.substring_index("path", "/", -1)
    columns = _processed(found, F.concat_ws("/", F.lit(output), "annotation", name))
    return with_tweets(found.select("image_id", "annotation", "event", "image_url", *columns), tweets)


def manifest_paths(manifest: DataFrame, root: str) -> DataFrame:
    """Manifest entries with the path their file should have."""
    return manifest.withColumn(
        "path", F.concat_ws("/", F.lit(root), "source", "label", "article_id", "image_file")
    )


def existing_entries(entries: DataFrame, inventory: DataFrame) -> DataFrame:
    """Manifest entries whose file is in the inventory."""
    return entries.join(inventory.select("path"), "path", "left_semi")


def build_article_images(manifest: DataFrame, properties: DataFrame, root: str, output: str) -> DataFrame:
    """Processed images of an article manifest; entries without a valid file are left out."""
    found = manifest_paths(manifest, root).join(properties, "path")
    name = F.concat_ws("_", "article_id", "image_file")
    columns = _processed(found, F.concat_ws("/", F.lit(output), "source", "label", name))
    return found.select(
        "source", "label", "article_id", F.col("image_file").alias("original_filename"), "content_file", *columns
    )


def plain_root(root: str) -> str:
    """A directory as the listings spell it."""
    return re.sub("^file:/+", "/", root)


class LoadedImages(NamedTuple):
    """Processed images of a corpus, and the decoded files they are made of."""

    records: DataFrame
    decoded: DataFrame


def load_listed_images(
    spark: SparkSession,
    path: str,
    output: str,
    tweets: DataFrame | None = None,
    table: str | None = None,
    options: ImageOptions | None = None,
) -> LoadedImages:
    """Processed images of a directory with ``images/<class>/`` and the two lists, in ``raw/`` or beside it.

    The listing meets the list first, and only files that are then wanted are opened. ``tweets`` are those of
    :func:`image_tweets`, from the tweet list where they aren't given. ``table`` keeps the decoded files for later
    runs; without one they last as long as the application.
    """
    if tweets is None:
        tweets = image_tweets(read_tweet_images(spark, *list_candidates(path, TWEET_LIST_FILE)))
    listed = read_image_list(spark, *list_candidates(path, IMAGE_LIST_FILE))
    listing = image_paths(spark, f"{path}/images")
    wanted = images_with_files(listed_class(listed), files_by_stem(listing)).select("path").join(listing, "path")
    decoded = decode_images(spark, wanted, table or shared_path(spark, "decoded"), options)
    return LoadedImages(build_listed_images(listed, decoded.drop("pixels"), tweets, output, listing), decoded)


def load_article_images(
    spark: SparkSession, path: str, entries: DataFrame, output: str, table: str | None = None, options: ImageOptions | None = None
) -> LoadedImages:
    """Processed images of a directory ``images/<publisher>/<label>/<article>/`` and the entries of its manifest.

    Files that no entry names stay closed; ``table`` as in :func:`load_listed_images`.
    """
    root = f"{path}/images"
    listing, plain = image_paths(spark, root), plain_root(root)
    wanted = existing_entries(manifest_paths(entries, plain), listing).select("path").join(listing, "path")
    decoded = decode_images(spark, wanted, table or shared_path(spark, "decoded"), options)
    return LoadedImages(build_article_images(entries, decoded.drop("pixels"), plain, output), decoded)


def pixels_of(records: DataFrame, decoded: DataFrame, options: ImageOptions | None = None) -> DataFrame:
    """Resampled pixels of processed images under the ``processed_path`` of their record."""
    width, height = (options or ImageOptions()).resize
    wanted = records.select(F.col("original_path").alias("path"), "processed_path").distinct()
    size = F.lit(height).alias("height"), F.lit(width).alias("width")
    return decoded.select("path", "pixels").join(wanted, "path").select("processed_path", *size, "pixels")


def listed_image_plan(images: DataFrame, root: str, inventory: DataFrame, limit: int = 0) -> DataFrame:
    """Fetches still to do: ``image_id, image_url, bucket, target``; ``limit`` takes the first ids only, 0 all."""
    bucket = annotation_bucket(F.col("annotation"))
    name = F.concat("image_id", extension_or_jpg(F.col("image_url")))
    if limit > 0:
        images = images.orderBy("image_id").limit(limit)
    plan = images.select(
        "image_id",
        "image_url",
        bucket.alias("bucket"),
        F.concat_ws("/", F.lit(root), bucket, name).alias("target"),
    )
    return plan.join(inventory.select(F.col("path").alias("target")), "target", "left_anti")


def article_manifest(inventory: DataFrame, contents: DataFrame, list_rows: int = 100_000) -> DataFrame:
    """Images of each article from the files on disk; articles without images or content do not appear.

    ``inventory`` holds ``source, label, article_id, name``, ``contents`` the articles with their ``content_file``. The
    result has ``source, label, article_id, image_count, chunk, images, content_file``: every article has its chunk 0, and
    ``image_count`` counts the images of all its chunks.
    """
    keys = ["source", "label", "article_id"]
    lists = chunked_lists(inventory, keys, F.col("name"), list_rows)
    columns = [*keys, F.col("item_count").alias("image_count"), "chunk", F.col("items").alias("images"), "content_file"]
    return lists.join(contents.select(*keys, "content_file"), keys).select(*columns)


def inventory_keys(paths: DataFrame) -> DataFrame:
    """Keys of article images from their paths: ``source, label, article_id, name``."""
    names = ("source", "label", "article_id", "name")
    pattern = r"([^/]+)/([^/]+)/([^/]+)/([^/]+)$"
    return paths.select(*[F.regexp_extract("path", pattern, i).alias(n) for i, n in enumerate(names, 1)])


"""Image lists, manifests, listings and decoded images."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veracity_prep.functions.scores import aspect_ratio
from veracity_prep.functions.text import strip_space
from veracity_prep.functions.urls import base_name, extension, format_name, stem
from veracity_prep.operators.images import decoded_images, image_tags
from veracity_prep.operators.shared import fixed
from veracity_prep.options import ImageOptions
from veracity_prep.schemas import DECODED, EXIF_TYPE, IMAGE_LIST, IMAGE_MANIFEST, TWEET_IMAGES
from veracity_prep.sources.files import or_empty, plain_path

# Extensions of image files; of equal stems the later one in this list wins.
EXTENSIONS = (".jpg", ".jpeg", ".png", ".gif")


def tab_fields(lines: DataFrame, names: Sequence[str]) -> DataFrame:
    """The first fields of tab-separated lines (column ``value``); lines with fewer fields are dropped."""
    parts = F.split(strip_space(F.col("value")), "\t", -1)
    fields = lines.select(parts.alias("_parts")).where(F.size("_parts") >= len(names))
    return fields.select(*[F.col("_parts")[i].alias(n) for i, n in enumerate(names)])


def _first_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Lines of the first of the files that exists."""
    for path in paths[:-1]:
        try:
            return spark.read.text(path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
    return or_empty(spark, lambda: spark.read.text(paths[-1]), "value string")


def read_image_list(spark: SparkSession, *paths: str) -> DataFrame:
    """``image_id, image_url, annotation, event`` from the first of ``paths`` that exists."""
    return tab_fields(_first_lines(spark, paths), IMAGE_LIST)


def read_tweet_images(spark: SparkSession, *paths: str) -> DataFrame:
    """``tweet_id, image_id, annotation, event`` from the first of ``paths`` that exists."""
    return tab_fields(_first_lines(spark, paths), TWEET_IMAGES)


def manifest_images(manifest: DataFrame) -> DataFrame:
    """One row per image of an article manifest: ``source, label, article_id, image_file, content_file``.

    An article may have one entry with all its images or several with some of them.
    """
    return manifest.select(
        "source",
        "label",
        "article_id",
        F.explode("images").alias("image_file"),
        F.coalesce("content_file", F.lit("")).alias("content_file"),
    )


def read_manifest(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """A JSON manifest of article images: one array, or one object per line with ``lines``."""

    def scan() -> DataFrame:
        return spark.read.schema(IMAGE_MANIFEST).json(path, multiLine=not lines)

    return manifest_images(or_empty(spark, scan, IMAGE_MANIFEST))


def image_paths(spark: SparkSession, root: str) -> DataFrame:
    """``path, size, modified`` of the image files below a directory; contents are not read."""

    def scan() -> DataFrame:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
        return files.select(local_path(F.col("path")).alias("path"), F.col("length").alias("size"), F.col("modificationTime").alias("modified"))

    paths = or_empty(spark, scan, "path string, size bigint, modified timestamp")
    return paths.where(extension(base_name(F.col("path"))).isin(*EXTENSIONS))


def files_by_stem(paths: DataFrame) -> DataFrame:
    """One file per ``annotation`` (its directory) and ``image_id`` (its stem): ``annotation, image_id, path``."""
    name = base_name(F.col("path"))
    rank = F.array_position(F.array(*map(F.lit, EXTENSIONS)), extension(name))
    listed = paths.select(
        F.regexp_extract("path", r"([^/]+)/[^/]*$", 1).alias("annotation"), stem(name).alias("image_id"), "path", rank.alias("_rank")
    )
    return listed.groupBy("annotation", "image_id").agg(F.max_by("path", F.struct("_rank", "path")).alias("path"))


def read_images(spark: SparkSession, *paths: str) -> DataFrame:
    """Decoded images below directories or of named files (column ``image``); broken files have width -1.

    ``image.origin`` is the plain path, as the file listing spells it: the scan itself gives it percent-encoded.
    """
    images = (
        spark.read.format("image")
        .options(recursiveFileLookup=True, dropInvalid=False, pathGlobFilter="*.{jpg,jpeg,png,gif}")
        .load(list(paths))
    )
    return images.withColumn("image", F.col("image").withField("origin", local_path(plain_path(F.col("image.origin")))))


def read_image_bytes(spark: SparkSession, *paths: str) -> DataFrame:
    """``path, content`` of JPEG files, the ones that may carry tags, below directories or of named files."""
    return (
        spark.read.format("binaryFile")
        .options(recursiveFileLookup=True, pathGlobFilter="*.{jpg,jpeg}")
        .load(list(paths))
        .select(local_path(F.col("path")).alias("path"), "content")
    )


def plain_glob(path: str) -> str:
    """A path, as :func:`local_path` spells it, as a pattern that matches just this path."""
    return ("file:" if path.startswith("/") else "") + re.sub(r"([*?\[\]{}\\])", r"\\\1", path)


def path_batches(paths: DataFrame, rows: int = 100_000) -> Iterator[list[str]]:
    """The paths of a table in lists of about ``rows``: all that a driver ever holds of them at a time."""
    batches = max(1, -(-paths.count() // rows))
    for batch in range(batches):
        part = paths.where(F.pmod(F.xxhash64("path"), F.lit(batches)) == batch)
        if names := [r["path"] for r in part.select("path").collect()]:
            yield names


def decode_images(
    spark: SparkSession, wanted: DataFrame, table: str, options: ImageOptions | None = None, batch_rows: int = 100_000
) -> DataFrame:
    """Bring a table of decoded images up to date with the files ``wanted`` (``path, modified``) and return their rows:
    ``path, modified, width, height, aspect_ratio, format, exif, pixels``, those of broken files left out.

    Only files that the table doesn't hold yet are opened: those that a list or manifest names and that are new or
    changed. One decoding gives size and pixels; JPEG files are read once more for their tags. Files are named to the
    scan batch by batch, and each batch is one append, so a failed run goes on where it stopped.
    """
    # Pixels of another size are another table.
    table = table + "/{}x{}".format(*(options or ImageOptions()).resize)
    wanted = fixed(wanted.select("path", "modified").distinct(), "wanted")
    held = or_empty(spark, lambda: spark.read.schema(DECODED).parquet(table), DECODED)
    missing = fixed(wanted.join(held.select("path", "modified"), ["path", "modified"], "left_anti"), "missing")
    for batch in path_batches(missing, batch_rows):
        names = [plain_glob(p) for p in batch]
        images = decoded_images(read_images(spark, *names), options)
        if tagged := [n for n in names if n.endswith((".jpg", ".jpeg"))]:
            images = images.join(image_tags(read_image_bytes(spark, *tagged)), "path", "left")
        else:
            images = images.withColumn("exif", F.lit(None).cast(EXIF_TYPE))
        rows = images.join(missing, "path").select("path", "modified", "width", "height", "exif", "pixels")
        rows.write.mode("append").parquet(table)
    size = F.col("width"), F.col("height")
    rows = or_empty(spark, lambda: spark.read.schema(DECODED).parquet(table), DECODED).join(wanted, ["path", "modified"], "left_semi")
    return rows.where((size[0] > 0) & (size[1] > 0)).select(
        "path", "modified", *size, aspect_ratio(*size).alias("aspect_ratio"), format_name(F.col("path")).alias("format"),
        F.coalesce("exif", F.create_map().cast(EXIF_TYPE)).alias("exif"), "pixels",
    )


def local_path(path: Column) -> Column:
    """One spelling of a file address: the two image scans write ``file:/x`` and ``file:///x``."""
    return F.regexp_replace(path, r"^file:/+", "/")

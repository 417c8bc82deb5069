"""Image lists, mappings, manifests, plans and jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.tables import ARTICLE_IMAGES, IMAGE_FILES, IMAGE_LINES, TWEET_LINES, Inputs, query
from veracity_prep.functions.labels import annotation_bucket
from veracity_prep.functions.scores import aspect_ratio, has_tags
from veracity_prep.operators.images import image_geometry, image_tags, resample_images
from veracity_prep.operators.metadata import linkable_images
from veracity_prep.operators.stats import download_summary, failed_downloads
from veracity_prep.options import ImageOptions
from veracity_prep.plans.image_corpora import (
    article_manifest,
    build_article_images,
    build_listed_images,
    existing_entries,
    image_tweets,
    images_with_files,
    images_without_files,
    listed_class,
    listed_image_plan,
    manifest_paths,
    with_tweets,
)
from veracity_prep.schemas import EXIF_TYPE, IMAGE_LIST, TWEET_IMAGES
from veracity_prep.sources.images import files_by_stem, manifest_images, tab_fields
from veracity_prep.sources.processed import image_summary


def image_list(t: Inputs):
    return tab_fields(t.adapt(IMAGE_LINES), IMAGE_LIST)


def tweet_list(t: Inputs):
    return tab_fields(t.adapt(TWEET_LINES), TWEET_IMAGES)


LIST = f"""SELECT f[1] AS image_id, f[2] AS image_url, f[3] AS annotation, f[4] AS event
    FROM (SELECT string_split(trim(value, ' '), chr(9)) AS f FROM ({IMAGE_LINES})) WHERE len(f) >= 4"""
MAPPING = f"""SELECT f[1] AS tweet_id, f[2] AS image_id, f[3] AS annotation, f[4] AS event
    FROM (SELECT string_split(value, chr(9)) AS f FROM ({TWEET_LINES})) WHERE len(f) >= 4"""


@query(LIST)
def image_list_lines(t):
    return image_list(t)


@query(MAPPING)
def tweet_mapping_lines(t):
    return tweet_list(t)


@query(f"SELECT image_id, lower(annotation) AS annotation FROM ({LIST}) WHERE lower(annotation) = 'fake'")
def listed_fakes(t):
    return listed_class(image_list(t), "fake").select("image_id", "annotation")


@query(
    f"SELECT image_id, CASE WHEN lower(annotation) IN ('fake', 'real') THEN lower(annotation) ELSE 'unknown' END AS bucket FROM ({LIST})"
)
def image_buckets(t):
    return image_list(t).select("image_id", annotation_bucket(F.col("annotation")).alias("bucket"))


FILES = f"""SELECT annotation, image_id, path, width, height FROM (
    SELECT *, row_number() OVER (PARTITION BY annotation, image_id ORDER BY rank DESC) AS n FROM (
        SELECT path, width, height, regexp_extract(path, '([^/]+)/[^/]*$', 1) AS annotation, regexp_extract(path, '([^/.]+)\\.[a-z]+$', 1) AS image_id,
            list_position(['jpg', 'jpeg', 'png', 'gif'], regexp_extract(path, '[a-z]+$')) AS rank FROM ({IMAGE_FILES}))
    WHERE rank > 0) WHERE n = 1"""


def image_files(t: Inputs):
    """The listing, other files left out as the scan does."""
    return t.adapt(IMAGE_FILES).where(~F.col("path").endswith(".txt"))


@query(f"SELECT annotation, image_id, path FROM ({FILES})")
def image_file_by_stem(t):
    return files_by_stem(image_files(t))


_JOINED = f"(SELECT *, lower(annotation) AS a FROM ({LIST})) l"


@query(f"SELECT l.image_id, l.a AS annotation, l.event, f.path FROM {_JOINED} JOIN ({FILES}) f ON f.annotation = l.a AND f.image_id = l.image_id")
def listed_images_with_files(t):
    found = images_with_files(listed_class(image_list(t)), files_by_stem(image_files(t)))
    return found.select("image_id", "annotation", "event", "path")


@query(
    f"SELECT l.image_id, l.a AS annotation FROM {_JOINED} WHERE l.a IN ('fake', 'real') AND NOT EXISTS "
    f"(SELECT 1 FROM ({FILES}) f WHERE f.annotation = l.a AND f.image_id = l.image_id)"
)
def listed_images_without_files(t):
    missing = images_without_files(listed_class(image_list(t)), files_by_stem(image_files(t)))
    return missing.select("image_id", "annotation")


TWEETS = f"SELECT image_id, count(*) AS n, string_agg(tweet_id, ' ' ORDER BY tweet_id) AS ids FROM ({MAPPING}) GROUP BY image_id"


@query(f"SELECT l.image_id, t.n AS tweet_count, t.ids AS tweet_ids FROM ({LIST}) l LEFT JOIN ({TWEETS}) t ON t.image_id = l.image_id")
def listed_images_with_tweets(t):
    return with_tweets(image_list(t), image_tweets(tweet_list(t))).select(
        "image_id", "tweet_count", F.array_join("tweet_ids", " ").alias("tweet_ids")
    )


@query(
    f"""SELECT image_id, n, chunk, string_agg(tweet_id, ' ' ORDER BY tweet_id) AS ids FROM (
        SELECT image_id, tweet_id, count(*) OVER (PARTITION BY image_id) AS n,
            (row_number() OVER (PARTITION BY image_id ORDER BY tweet_id) - 1) // 20 AS chunk FROM ({MAPPING}))
    GROUP BY image_id, n, chunk"""
)
def image_tweets_in_chunks(t):
    """Twenty tweets to a row; the rows of an image, one after the other, are its sorted list."""
    lists = image_tweets(tweet_list(t), list_rows=20)
    return lists.select("image_id", F.col("item_count").alias("n"), "chunk", F.array_join("items", " ").alias("ids"))


def _properties(t: Inputs):
    w, h = F.col("width"), F.col("height")
    tags = F.when(w % 3 == 0, F.create_map(F.lit("Make"), F.lit("m"))).otherwise(F.create_map().cast(EXIF_TYPE))
    return image_files(t).select(
        "path", w, h, aspect_ratio(w, h).alias("aspect_ratio"), F.regexp_extract("path", r"[a-z]+$", 0).alias("format"), tags.alias("exif")
    )


@query(
    f"""SELECT l.image_id, l.a AS annotation, l.event, l.image_url, f.path AS original_path,
        concat('/out/', l.a, '/', regexp_extract(f.path, '[^/]+$')) AS processed_path, f.width, round(f.width / f.height, 9) AS ratio,
        regexp_extract(f.path, '[a-z]+$') AS format, f.width % 3 = 0 AS has_exif, t.n AS tweet_count
    FROM {_JOINED} JOIN ({FILES}) f ON f.annotation = l.a AND f.image_id = l.image_id LEFT JOIN ({TWEETS}) t ON t.image_id = l.image_id"""
)
def listed_image_records(t):
    records = build_listed_images(image_list(t), _properties(t), image_tweets(tweet_list(t)), "/out")
    return records.select(
        "image_id", "annotation", "event", "image_url", "original_path", "processed_path",
        F.col("original_size")[0].alias("width"), F.round("aspect_ratio", 9).alias("ratio"), "format",
        has_tags(F.col("exif")).alias("has_exif"), "tweet_count",
    )


@query(
    f"""SELECT l.image_id, l.a AS annotation, concat('/out/', l.a, '/', regexp_extract(f.path, '[^/]+$')) AS processed_path,
        concat(f.width, 'x', f.height) AS original_size, printf('%.2f', f.width / f.height) AS aspect_ratio, f.width % 3 = 0 AS has_exif
    FROM {_JOINED} JOIN ({FILES}) f ON f.annotation = l.a AND f.image_id = l.image_id"""
)
def listed_image_summary(t):
    return image_summary(build_listed_images(image_list(t), _properties(t), image_tweets(tweet_list(t)), "/out"), "image_id", "annotation")


_EXT = r"regexp_extract(regexp_extract(image_url, '[^/]*$'), '^\.*[^.].*(\.[^.]*)$', 1)"
PLAN = f"""SELECT image_id, image_url, bucket, concat('/out/', bucket, '/', image_id, CASE WHEN e = '' THEN '.jpg' ELSE e END) AS target
    FROM (SELECT *, {_EXT} AS e, CASE WHEN lower(annotation) IN ('fake', 'real') THEN lower(annotation) ELSE 'unknown' END AS bucket FROM ({LIST}))"""


def _inventory(t: Inputs):
    return t("pages").select(F.concat(F.lit("/out/fake/im"), "page_id", F.lit(".jpg")).alias("path"))


@query(f"SELECT * FROM ({PLAN}) WHERE target NOT IN (SELECT concat('/out/fake/im', page_id, '.jpg') FROM {{pages}})")
def listed_image_fetches(t):
    return listed_image_plan(image_list(t), "/out", _inventory(t))


@query(f"SELECT * FROM (SELECT * FROM ({PLAN}) ORDER BY image_id LIMIT 20) WHERE NOT starts_with(target, '/none')")
def first_image_fetches(t):
    nothing = _inventory(t).select(F.concat(F.lit("/none"), "path").alias("path"))
    return listed_image_plan(image_list(t), "/out", nothing, limit=20)


OUTCOMES = """SELECT concat('im', CAST(page_id AS STRING)) AS image_id,
    CASE page_id % 5 WHEN 0 THEN 'exists' WHEN 1 THEN 'failed' ELSE 'success' END AS outcome FROM {pages}"""


@query(
    f"""SELECT count(*) AS total, count(*) FILTER (outcome = 'success') AS success, count(*) FILTER (outcome = 'exists') AS already_exists,
    count(*) FILTER (outcome = 'failed') AS failed FROM ({OUTCOMES})"""
)
def image_fetch_summary(t):
    return download_summary(t.adapt(OUTCOMES))


@query(f"SELECT image_id FROM ({OUTCOMES}) WHERE outcome = 'failed'")
def failed_image_fetches(t):
    return failed_downloads(t.adapt(OUTCOMES))


def _inventory_rows(t: Inputs):
    return t.adapt(ARTICLE_IMAGES).select("source", "label", "article_id", F.col("original_filename").alias("name"))


def manifest_sql(list_rows: int) -> str:
    """Articles with ``list_rows`` images to a row."""
    keys = "source, label, article_id"
    return f"""SELECT {keys}, image_count, chunk, string_agg(original_filename, '|' ORDER BY original_filename) AS images, min(content_file) AS content_file
    FROM (SELECT *, count(*) OVER (PARTITION BY {keys}) AS image_count,
            (row_number() OVER (PARTITION BY {keys} ORDER BY original_filename) - 1) // {list_rows} AS chunk
        FROM ({ARTICLE_IMAGES}) WHERE article_id <> '') GROUP BY {keys}, image_count, chunk"""


MANIFEST = manifest_sql(100_000)


def manifest(t: Inputs, list_rows: int = 100_000):
    contents = t.adapt(ARTICLE_IMAGES).where("article_id <> ''").select("source", "label", "article_id", "content_file").distinct()
    return article_manifest(_inventory_rows(t), contents, list_rows)


@query(MANIFEST)
def article_image_manifest(t):
    return manifest(t).withColumn("images", F.array_join("images", "|"))


@query(manifest_sql(2))
def article_image_manifest_in_chunks(t):
    return manifest(t, 2).withColumn("images", F.array_join("images", "|"))


ENTRIES = f"SELECT source, label, article_id, original_filename AS image_file, content_file FROM ({ARTICLE_IMAGES}) WHERE article_id <> ''"


@query(ENTRIES)
def manifest_entries(t):
    return manifest_images(manifest(t))


@query(ENTRIES)
def manifest_entries_in_chunks(t):
    """The same entries, whatever the number of images to a row of the manifest."""
    return manifest_images(manifest(t, 2))


_EXISTING = f"SELECT * FROM ({ARTICLE_IMAGES}) WHERE article_id <> '' AND original_filename <> 'img_1.jpg'"


@query(f"SELECT source, label, article_id, original_filename AS image_file FROM ({_EXISTING})")
def existing_manifest_entries(t):
    entries = manifest_paths(manifest_images(manifest(t)), "/raw")
    there = entries.where("image_file <> 'img_1.jpg'").select("path")
    return existing_entries(entries, there).select("source", "label", "article_id", "image_file")


@query(
    f"""SELECT source, label, article_id, original_filename, content_file, concat('/out/', source, '/', label, '/', article_id, '_', original_filename) AS processed_path
    FROM ({_EXISTING})"""
)
def article_image_items(t):
    entries = manifest_images(manifest(t))
    there = manifest_paths(entries, "/raw").where("image_file <> 'img_1.jpg'")
    fixed = [F.lit(9).alias("width"), F.lit(6).alias("height"), F.lit(1.5).alias("aspect_ratio"), F.lit("jpg").alias("format")]
    properties = there.select("path", *fixed, F.create_map().cast(EXIF_TYPE).alias("exif"))
    done = build_article_images(entries, properties, "/raw", "/out")
    return done.select("source", "label", "article_id", "original_filename", "content_file", "processed_path")


@query(f"SELECT source, article_id, original_filename FROM ({ARTICLE_IMAGES}) WHERE source <> 'other' AND article_id <> ''")
def linkable_article_images(t):
    return linkable_images(t.adapt(ARTICLE_IMAGES)).select("source", "article_id", "original_filename")


def _bytes(c, size):
    return F.unhex(F.lpad(F.hex(c), 2 * size, "0"))


def _jpegs(t: Inputs):
    """JPEG headers with an EXIF block that names a make and, for even pages, a model."""
    make = F.concat(F.lit("maker of "), F.col("url"), F.lit("\0"))
    model = F.concat(F.lit("model "), "page_id", F.lit("\0"))
    two = F.col("page_id") % 2 == 0
    n = F.when(two, 2).otherwise(1)
    start = F.lit(8) + 2 + n * 12 + 4
    size_make, size_model = F.octet_length(make), F.octet_length(model)

    def entry(tag, size, at):
        return F.concat(_bytes(F.lit(tag), 2), _bytes(F.lit(2), 2), _bytes(size, 4), _bytes(at, 4))

    nothing = F.unhex(F.lit(""))
    tiff = F.concat(
        F.unhex(F.lit("4D4D002A00000008")), _bytes(n, 2), entry(0x010F, size_make, start),
        F.when(two, entry(0x0110, size_model, start + size_make)).otherwise(nothing), F.unhex(F.lit("00000000")),
        F.encode(make, "UTF-8"), F.when(two, F.encode(model, "UTF-8")).otherwise(nothing),
    )
    app = F.concat(F.unhex(F.lit("457869660000")), tiff)
    comment = F.concat(F.unhex(F.lit("FFFE")), _bytes(F.lit(4), 2), F.unhex(F.lit("4142")))
    jpeg = F.concat(
        F.unhex(F.lit("FFD8")), comment, F.unhex(F.lit("FFE1")), _bytes(F.octet_length(app) + 2, 2), app,
        F.unhex(F.lit("FFDA")), F.encode(F.col("html"), "UTF-8"),
    )
    plain = F.encode(F.col("html"), "UTF-8")
    return t("pages").select(
        F.col("page_id").cast("string").alias("path"), F.when(F.col("page_id") % 5 == 4, plain).otherwise(jpeg).alias("content")
    )


@query(
    """SELECT CAST(page_id AS VARCHAR) AS path, CASE WHEN page_id % 5 <> 4 THEN concat('maker of ', url) END AS make,
        CASE WHEN page_id % 5 <> 4 AND page_id % 2 = 0 THEN concat('model ', page_id) END AS model, page_id % 5 <> 4 AS has_exif FROM {pages}"""
)
def jpeg_tags(t):
    tags = F.col("exif")
    return image_tags(_jpegs(t)).select("path", tags["Make"].alias("make"), tags["Model"].alias("model"), has_tags(tags).alias("has_exif"))


def page_images(t: Inputs):
    """Page sources read as BGR images of 40 rows, the last row filled up with black; every 10th is broken."""
    size = F.octet_length("html")
    width = F.ceil(size / F.lit(120)).cast("int")
    pixels = F.rpad(F.encode(F.col("html"), "UTF-8"), width * 120, F.unhex(F.lit("00")))
    image = F.struct(
        F.concat(F.lit("file:///images/"), "page_id", F.lit(".PNG")).alias("origin"), F.lit(40).alias("height"),
        F.when(F.col("page_id") % 10 == 9, -1).otherwise(width).alias("width"), F.lit(3).alias("nChannels"),
        F.lit(16).alias("mode"), pixels.alias("data"),
    )
    return t("pages").select(image.alias("image"))


@query(
    """SELECT concat('file:///images/', page_id, '.PNG') AS path, w AS width, 40 AS height, round(w / 40, 9) AS ratio, 'png' AS format
    FROM (SELECT page_id, CAST(ceil(octet_length(encode(html)) / 120) AS INTEGER) AS w FROM {pages}) WHERE page_id % 10 <> 9"""
)
def image_sizes(t):
    return image_geometry(page_images(t)).select("path", "width", "height", F.round("aspect_ratio", 9).alias("ratio"), "format")


@query()
def resample_page_images(t):
    small = resample_images(page_images(t), ImageOptions())
    return small.select("path", "height", "width", F.octet_length("pixels").alias("bytes"), F.md5("pixels").alias("digest"))

"""Article corpus: content files and tweet counts to one item per article."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veracity_prep.functions.labels import article_label
from veracity_prep.functions.urls import all_image_urls, declared_image_urls, file_name, is_http
from veracity_prep.functions.variants import field_or, parse_once
from veracity_prep.operators.text import preprocess
from veracity_prep.options import Options
from veracity_prep.sources.articles import ArticleFiles, read_article_files

KEYS = ["source", "label", "article_id"]


def _text(v: Column, name: str) -> Column:
    return F.try_variant_get(v, f"$.{name}", "string")


def _list(v: Column, name: str) -> Column:
    return F.try_variant_get(v, f"$.{name}", "array<string>")


def article_text(text: Column, title: Column, description: Column) -> Column:
    """The text, else title and description joined by a blank; NULL when nothing is left."""
    fallback = F.when(title.isNotNull(), F.concat_ws(" ", title, description))
    return F.nullif(F.coalesce(F.nullif(text, F.lit("")), fallback), F.lit(""))


def author_list(v: Column) -> Column:
    """Authors as a list, whether they come as a list or as a single value."""
    single = _text(v, "authors")
    return F.coalesce(
        _list(v, "authors"), F.when(single.isNotNull(), F.array(single)), F.array().cast("array<string>")
    )


def image_text(v: Column) -> Column:
    """The single image field, when it is a string."""
    kind = F.schema_of_variant(F.try_variant_get(v, "$.image", "variant"))
    return F.when(kind == "STRING", _text(v, "image"))


def tweet_counts(names: DataFrame) -> DataFrame:
    """Tweet files of each article."""
    return names.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("tweet_count"))


def parsed_articles(contents: DataFrame) -> DataFrame:
    """Content files with their JSON as ``_content``, NULL for unreadable ones."""
    return parse_once(contents, KEYS, "value", "_content")


def raw_article_text() -> Column:
    """Text of a parsed article, from its fallback where it has none."""
    v = F.col("_content")
    return article_text(_text(v, "text"), _text(v, "title"), _text(v, "meta_description"))


def rejected_articles(files: ArticleFiles) -> DataFrame:
    """Articles that yield no item, with the reason: ``source, label, article_id, reason``."""
    unreadable = F.when(F.col("_content").isNull(), "unreadable content").otherwise("no text")
    return parsed_articles(files.contents).where(raw_article_text().isNull()).select(*KEYS, unreadable.alias("reason"))


def build_articles(files: ArticleFiles, options: Options | None = None, lexicon: DataFrame | None = None) -> DataFrame:
    """Processed articles.

    Their files are dealt out before the texts are cleaned, as few tasks may read them; the join needs that anyway.
    """
    options = options or Options()
    v = F.col("_content")
    articles = parsed_articles(files.contents.repartition(*KEYS)).withColumn("raw_text", raw_article_text()).where("raw_text is not null")
    done = preprocess(articles, "raw_text", "processed_text", options.text, lexicon, KEYS)
    images = declared_image_urls(_list(v, "images"), _text(v, "image"))
    metadata = F.struct(
        "source",
        "label",
        "article_id",
        field_or(v, "$.title", "string", "").alias("title"),
        field_or(v, "$.url", "string", "").alias("url"),
        field_or(v, "$.publish_date", "string", "").alias("date_published"),
        author_list(v).alias("authors"),
        images.alias("image_urls"),
        F.size(images).alias("image_count"),
        F.coalesce(_list(v, "keywords"), F.array().cast("array<string>")).alias("keywords"),
        field_or(v, "$.meta_description", "string", "").alias("description"),
        F.coalesce("tweet_count", F.lit(0).cast("bigint")).alias("tweet_count"),
    )
    return done.join(tweet_counts(files.tweet_names), KEYS, "left").select(
        F.concat_ws("_", "source", "article_id").alias("id"),
        "source",
        "raw_text",
        "processed_text",
        F.col("label").alias("original_label"),
        article_label(F.col("label")).alias("label"),
        metadata.alias("metadata"),
        F.concat_ws("/", *KEYS).alias("position"),
    )


def load_articles(
    spark: SparkSession, path: str, options: Options | None = None, lexicon: DataFrame | None = None
) -> DataFrame:
    """Processed articles of an article tree."""
    return build_articles(read_article_files(spark, path), options, lexicon)


def article_image_urls(contents: DataFrame) -> DataFrame:
    """Distinct image addresses of each article: ``source, label, article_id, urls``; none for unreadable ones."""
    v = F.col("_content")
    urls = all_image_urls(_list(v, "images"), _text(v, "text"), image_text(v))
    return parsed_articles(contents).select(*KEYS, urls.alias("urls"))


def article_image_plan(urls: DataFrame, root: str, inventory: DataFrame) -> DataFrame:
    """Fetches still to do: ``source, label, article_id, url, target``.

    Addresses that no download could fetch and targets already in ``inventory`` (``path``) are left out.
    """
    each = urls.select(*KEYS, F.explode("urls").alias("url")).where(is_http(F.col("url")))
    target = F.concat_ws("/", F.lit(root), "source", "label", "article_id", file_name(F.col("url")))
    plan = each.withColumn("target", target)
    return plan.join(inventory.select(F.col("path").alias("target")), "target", "left_anti")


def article_outcomes(urls: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Fetch results of each article: ``source, label, article_id, total_urls, downloaded, failed``.

    ``outcomes`` holds ``source, label, article_id, url, fetched``; an address that was not fetched failed.
    """
    each = urls.select(*KEYS, F.explode_outer("urls").alias("url"))
    joined = each.join(outcomes.select(*KEYS, "url", "fetched"), [*KEYS, "url"], "left")
    there, ok = F.col("url").isNotNull(), F.coalesce("fetched", F.lit(False))
    return joined.groupBy(*KEYS).agg(
        F.count_if(there).alias("total_urls"),
        F.count_if(there & ok).alias("downloaded"),
        F.count_if(there & ~ok).alias("failed"),
    )



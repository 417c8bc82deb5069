"""Summary statistics as long tables; every count combines map-side, whatever the skew of its key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: ``dataset`` value of rows that cover all corpora.
COMBINED = "combined"


def _n(condition: Column | None = None) -> Column:
    return F.count(F.lit(1)) if condition is None else F.count_if(F.coalesce(condition, F.lit(False)))


def item_counts(metadata: DataFrame) -> DataFrame:
    """Rows of each corpus and of all: ``dataset, n``."""
    counted = metadata.groupingSets([["dataset"], []], "dataset").agg(
        _n().alias("n"), F.grouping("dataset").alias("_all")
    )
    name = F.when(F.col("_all") == 1, COMBINED).otherwise(F.col("dataset"))
    return counted.select(name.alias("dataset"), "n")


def distribution(metadata: DataFrame, column: str) -> DataFrame:
    """Rows of each value of a column in each corpus, NULL left out: ``dataset, <column>, n``."""
    return metadata.where(F.col(column).isNotNull()).groupBy("dataset", column).agg(_n().alias("n"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Values with their row counts, the most frequent first, equal counts by value."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(_n().alias("n"))
    return counts.orderBy(F.desc("n"), column)


def presence_counts(metadata: DataFrame) -> DataFrame:
    """Rows with text, with images and with both, by corpus."""
    return metadata.groupBy("dataset").agg(
        _n(F.col("has_text")).alias("with_text"),
        _n(F.col("has_images")).alias("with_images"),
        _n(F.col("has_text") & F.col("has_images")).alias("with_both"),
    )


def dataset_statistics(metadata: DataFrame) -> DataFrame:
    """All statistics of each corpus and of all corpora: ``dataset, statistic, key, value``, in one pass.

    ``statistic`` is ``total_items``, ``items_with_text``, ``items_with_images``, ``items_with_both`` (``key`` empty),
    ``class_distribution`` or ``sources`` (``key`` is the label or source).
    """
    sets = [["dataset"], ["dataset", "label"], ["dataset", "source"], [], ["label"], ["source"]]
    counted = metadata.groupingSets(sets, "dataset", "label", "source").agg(
        F.grouping_id("dataset", "label", "source").alias("_level"),
        _n().alias("total_items"),
        _n(F.col("has_text")).alias("items_with_text"),
        _n(F.col("has_images")).alias("items_with_images"),
        _n(F.col("has_text") & F.col("has_images")).alias("items_with_both"),
    )
    # Bits of the level, from the left: dataset, label, source; a set bit means "over all values".
    by_corpus = F.col("_level").bitwiseAND(4) == 0
    detail = F.col("_level").bitwiseAND(3)

    def entry(statistic: str, key: Column, value: str, wanted: Column) -> Column:
        return F.when(wanted, F.struct(F.lit(statistic).alias("statistic"), key.alias("key"), F.col(value).alias("value")))

    none = F.lit("")
    entries = F.array_compact(
        F.array(
            *[
                entry(name, none, name, detail == 3)
                for name in ("total_items", "items_with_text", "items_with_images", "items_with_both")
            ],
            entry("class_distribution", F.col("label"), "total_items", (detail == 1) & F.col("label").isNotNull()),
            entry("sources", F.col("source"), "total_items", (detail == 2) & F.col("source").isNotNull()),
        )
    )
    name = F.when(by_corpus, F.col("dataset")).otherwise(COMBINED)
    return counted.select(name.alias("dataset"), F.explode(entries).alias("_e")).select("dataset", "_e.*")


def thread_counts() -> list[Column]:
    """Rumours, non-rumours and the three verdicts."""
    return [
        _n(F.col("is_rumor")).alias("rumors"),
        _n(~F.col("is_rumor")).alias("non_rumors"),
        _n(F.col("label") == "true").alias("true"),
        _n(F.col("label") == "false").alias("false"),
        _n(F.col("label") == "unverified").alias("unverified"),
    ]


def thread_statistics(threads: DataFrame) -> DataFrame:
    """:func:`thread_counts` over all threads, as one row."""
    return threads.agg(*thread_counts())


def part_counts(df: DataFrame, *parts: str) -> DataFrame:
    """Rows of each part of a corpus."""
    return df.groupBy(*parts).agg(_n().alias("n"))


def download_summary(outcomes: DataFrame) -> DataFrame:
    """Totals of image fetches by outcome ``success``, ``exists`` or anything else, which counts as failed."""
    outcome = F.col("outcome")
    return outcomes.agg(
        _n().alias("total"),
        _n(outcome == "success").alias("success"),
        _n(outcome == "exists").alias("already_exists"),
        _n(~F.coalesce(outcome.isin("success", "exists"), F.lit(False))).alias("failed"),
    )


def failed_downloads(outcomes: DataFrame) -> DataFrame:
    """Ids of the images that could not be fetched."""
    return outcomes.where(~F.coalesce(F.col("outcome").isin("success", "exists"), F.lit(False))).select("image_id")


def article_image_summary(articles: DataFrame) -> DataFrame:
    """Totals over per-article fetch results ``total_urls, downloaded, failed``."""
    zero = F.lit(0).cast("bigint")
    return articles.agg(
        _n().alias("total_articles"),
        F.coalesce(F.sum("total_urls"), zero).alias("total_urls"),
        F.coalesce(F.sum("downloaded"), zero).alias("downloaded"),
        F.coalesce(F.sum("failed"), zero).alias("failed"),
        _n(F.col("total_urls") > 0).alias("articles_with_images"),
    )

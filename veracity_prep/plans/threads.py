"""Thread corpus: source tweets, reactions and annotations to one item per thread."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from veracity_prep.functions.labels import annotation_label, known_label, thread_label
from veracity_prep.functions.variants import field_or, has_field, parse_once, strings_of
from veracity_prep.operators.text import preprocess
from veracity_prep.options import Options
from veracity_prep.sources.threads import ThreadFiles, read_thread_files

KEYS = ["event", "kind", "thread_id"]


def tweet_text(v: Column) -> Column:
    """Text of a tweet: NULL without the field, empty for a JSON null."""
    return F.when(has_field(v, "$.text"), F.coalesce(F.try_variant_get(v, "$.text", "string"), F.lit("")))


def tweet_metadata(v: Column) -> dict[str, Column]:
    """User and tweet records, expanded URLs and hashtags."""
    user = F.struct(
        field_or(v, "$.user.id_str", "string", "").alias("id"),
        field_or(v, "$.user.screen_name", "string", "").alias("screen_name"),
        field_or(v, "$.user.verified", "boolean", False).alias("verified"),
        field_or(v, "$.user.followers_count", "bigint", 0).alias("followers_count"),
        field_or(v, "$.user.friends_count", "bigint", 0).alias("friends_count"),
        field_or(v, "$.user.statuses_count", "bigint", 0).alias("statuses_count"),
        field_or(v, "$.user.created_at", "string", None).alias("created_at"),
    )
    tweet = F.struct(
        field_or(v, "$.id_str", "string", "").alias("id"),
        field_or(v, "$.created_at", "string", "").alias("created_at"),
        field_or(v, "$.retweet_count", "bigint", 0).alias("retweet_count"),
        field_or(v, "$.favorite_count", "bigint", 0).alias("favorite_count"),
        field_or(v, "$.lang", "string", "").alias("lang"),
        has_field(v, "$.entities.media").alias("has_media"),
    )
    return {
        "user": F.when(has_field(v, "$.user"), user),
        "tweet": tweet,
        "urls": strings_of(v, "$.entities.urls", "expanded_url"),
        "hashtags": strings_of(v, "$.entities.hashtags", "text"),
    }


def annotation_labels(annotations: DataFrame) -> DataFrame:
    """Label of each annotated thread, ``unknown`` where the annotation says nothing usable."""
    v = F.col("_note")
    label = annotation_label(
        F.try_variant_get(v, "$.misinformation", "string"),
        F.try_variant_get(v, "$.true", "string"),
        has_field(v, "$.misinformation"),
        has_field(v, "$.true"),
    )
    return parse_once(annotations, KEYS, "value", "_note").select(*KEYS, known_label(label).alias("annotated"))


def source_tweets(sources: DataFrame) -> DataFrame:
    """The first source tweet file of each thread, parsed: ``_tweet`` is NULL when it is not JSON."""
    first = sources.groupBy(*KEYS).agg(F.min_by("value", "file").alias("value"))
    return parse_once(first, KEYS, "value", "_tweet")


def first_reactions(
    reactions: DataFrame, cut: int, options: Options, lexicon: DataFrame | None = None
) -> DataFrame:
    """Preprocessed texts of the first ``cut`` reactions by file name; those without text go after the cut.

    The rank limit is also applied before the shuffle, so a thread with a large part of all reactions sends at most
    ``cut`` rows per task.
    """
    order = Window.partitionBy(*KEYS).orderBy("file")
    top = reactions.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= cut)
    tweets = parse_once(top, [*KEYS, "_n"], "value", "_tweet")
    texts = tweets.select(*KEYS, "_n", tweet_text(F.col("_tweet")).alias("_text")).where("_text is not null")
    done = preprocess(texts, "_text", "_done", options.text, lexicon, [*KEYS, "_n"])
    in_order = F.array_sort(F.collect_list(F.struct("_n", "_done")))["_done"]
    return done.groupBy(*KEYS).agg(in_order.alias("reactions"))


def rejected_threads(files: ThreadFiles) -> DataFrame:
    """Threads that yield no item, with the reason: ``event, kind, thread_id, reason``."""
    tweets = source_tweets(files.sources)
    unusable = tweets.where(tweet_text(F.col("_tweet")).isNull()).select(
        *KEYS, F.when(F.col("_tweet").isNull(), "unreadable source tweet").otherwise("no text").alias("reason")
    )
    seen = files.annotations.select(*KEYS).unionByName(files.reaction_names.select(*KEYS)).distinct()
    missing = seen.join(tweets, KEYS, "left_anti").withColumn("reason", F.lit("no source tweet"))
    return unusable.unionByName(missing)


def build_threads(files: ThreadFiles, options: Options | None = None, lexicon: DataFrame | None = None) -> DataFrame:
    """Processed threads, rumours and non-rumours in one plan."""
    options = options or Options()
    tweets = source_tweets(files.sources).withColumn("raw_text", tweet_text(F.col("_tweet")))
    tweets = preprocess(
        tweets.where("raw_text is not null"), "raw_text", "processed_text", options.text, lexicon, KEYS
    )
    counts = files.reaction_names.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("_reactions"))
    joined = (
        tweets.join(annotation_labels(files.annotations), KEYS, "left")
        .join(counts, KEYS, "left")
        .join(first_reactions(files.reactions, options.reaction_cut, options, lexicon), KEYS, "left")
    )
    is_rumor = F.col("kind") == "rumours"
    count = F.coalesce("_reactions", F.lit(0).cast("bigint")).alias("reaction_count")
    details = tweet_metadata(F.col("_tweet"))
    metadata = F.struct(
        *[c.alias(n) for n, c in details.items()],
        "event",
        F.when(is_rumor, F.col("thread_id")).alias("rumor_id"),
        F.when(~is_rumor, F.col("thread_id")).alias("non_rumor_id"),
        count,
        is_rumor.alias("is_rumor"),
    )
    return joined.select(
        F.col("thread_id").alias("id"),
        "event",
        "raw_text",
        "processed_text",
        thread_label(F.col("kind"), F.col("annotated")).alias("label"),
        F.coalesce("reactions", F.array().cast("array<string>")).alias("reactions"),
        count,
        is_rumor.alias("is_rumor"),
        metadata.alias("metadata"),
        # Events in name order, rumours before non-rumours.
        F.concat_ws("/", "event", F.when(is_rumor, "1").otherwise("2"), "thread_id").alias("position"),
    )


def load_threads(
    spark: SparkSession, path: str, options: Options | None = None, lexicon: DataFrame | None = None
) -> DataFrame:
    """Processed threads of a thread tree."""
    return build_threads(read_thread_files(spark, path), options, lexicon)

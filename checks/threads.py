"""Threads, derived from conversations, labels and events."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import sqltext as S
from checks.statements import VERDICT
from checks.tables import ANNOTATIONS, TWEETS, Inputs, query
from veracity_prep.functions.text import ENGLISH_STOPWORDS
from veracity_prep.operators.stats import part_counts, thread_statistics, value_counts
from veracity_prep.options import Options
from veracity_prep.plans.threads import (
    build_threads,
    first_reactions,
    rejected_threads,
    source_tweets,
    tweet_metadata,
    tweet_text,
)
from veracity_prep.sources.threads import ThreadFiles, parse_thread_files

CUT = 3
PROCESSED = S.preprocessed("c", ENGLISH_STOPWORDS)
_CLEANED = f"(SELECT *, {S.clean_plain('text')} AS c FROM ({TWEETS}))"


def thread_files(t: Inputs) -> ThreadFiles:
    """Paths and JSON texts of a thread tree, sorted into roles by path as a scan would."""
    tweets = t.adapt(TWEETS)
    text = F.when(F.col("has_text") == 1, F.col("text"))
    part = F.when(F.col("turn") == 0, "source-tweets").otherwise("reactions/deep")
    files = tweets.select(
        F.concat_ws("/", F.lit("/data"), "event", "kind", "thread_id", part, "file").alias("path"),
        F.to_json(F.struct(F.col("thread_id").alias("id_str"), text.alias("text"), F.col("role").alias("lang"))).alias("value"),
    )
    flags = t.adapt(ANNOTATIONS)
    keys = tweets.select("event", "kind", "thread_id").distinct()
    notes = flags.join(keys, F.col("doc_id").cast("string") == F.col("thread_id")).select(
        F.concat_ws("/", F.lit("/data"), "event", "kind", "thread_id", F.lit("annotation.json")).alias("path"),
        F.to_json(F.struct("misinformation", F.col("verified").cast("string").alias("true"))).alias("value"),
    )
    return parse_thread_files(files.unionByName(notes))


REACTIONS = f"""SELECT thread_id, string_agg({PROCESSED}, '|' ORDER BY turn) AS reactions FROM (
    SELECT *, row_number() OVER (PARTITION BY thread_id ORDER BY file) AS n FROM {_CLEANED} WHERE turn > 0)
    WHERE n <= {CUT} AND has_text = 1 GROUP BY thread_id"""


@query(REACTIONS)
def first_thread_reactions(t):
    top = first_reactions(thread_files(t).reactions, CUT, Options())
    return top.select("thread_id", F.array_join("reactions", "|").alias("reactions"))


@query(f"SELECT thread_id, count(*) AS reaction_count FROM ({TWEETS}) WHERE turn > 0 GROUP BY thread_id")
def thread_reaction_counts(t):
    threads = build_threads(thread_files(t))
    with_reactions = threads.where("reaction_count > 0")
    rejected = rejected_threads(thread_files(t)).select(F.col("thread_id").alias("id"))
    names = thread_files(t).reaction_names
    missing = part_counts(names.join(rejected, F.col("thread_id") == F.col("id"), "left_semi"), "thread_id")
    return with_reactions.select(F.col("id").alias("thread_id"), "reaction_count").unionByName(
        missing.withColumnRenamed("n", "reaction_count")
    )


@query(f"SELECT thread_id, min(file) AS file, min(turn) AS turn FROM ({TWEETS}) GROUP BY thread_id")
def first_source_tweets(t):
    # Every turn as a candidate source tweet, so that there is something to choose from.
    tweets = t.adapt(TWEETS).withColumn("value", F.to_json(F.struct("file", "turn")))
    v = F.col("_tweet")
    return source_tweets(tweets).select(
        "thread_id",
        F.try_variant_get(v, "$.file", "string").alias("file"),
        F.try_variant_get(v, "$.turn", "bigint").alias("turn"),
    )


_ANNOTATED = f"(SELECT CAST(doc_id AS VARCHAR) AS doc_id, coalesce({VERDICT}, 'unknown') AS v FROM ({ANNOTATIONS}))"
THREADS = f"""
    SELECT s.thread_id AS id, s.event, s.text AS raw_text, {PROCESSED} AS processed_text,
        CASE WHEN s.kind = 'non-rumours' THEN 'true' ELSE coalesce(a.v, 'unknown') END AS label,
        coalesce(r.reactions, '') AS reactions, coalesce(n.n, 0) AS reaction_count, s.kind = 'rumours' AS is_rumor,
        s.role AS lang, CASE WHEN s.kind = 'rumours' THEN s.thread_id END AS rumor_id
    FROM {_CLEANED} s
    LEFT JOIN {_ANNOTATED} a ON a.doc_id = s.thread_id
    LEFT JOIN ({REACTIONS}) r ON r.thread_id = s.thread_id
    LEFT JOIN (SELECT thread_id, count(*) AS n FROM ({TWEETS}) WHERE turn > 0 GROUP BY thread_id) n ON n.thread_id = s.thread_id
    WHERE s.turn = 0 AND s.has_text = 1"""


def threads(t: Inputs):
    return build_threads(thread_files(t), Options(reaction_cut=CUT))


@query(THREADS)
def thread_items(t):
    return threads(t).select(
        "id", "event", "raw_text", "processed_text", "label", F.array_join("reactions", "|").alias("reactions"),
        "reaction_count", "is_rumor", F.col("metadata.tweet.lang").alias("lang"),
        F.col("metadata.rumor_id").alias("rumor_id"),
    )


@query(
    f"""SELECT count(*) FILTER (is_rumor) AS rumors, count(*) FILTER (NOT is_rumor) AS non_rumors,
    count(*) FILTER (label = 'true') AS "true", count(*) FILTER (label = 'false') AS "false",
    count(*) FILTER (label = 'unverified') AS unverified FROM ({THREADS})"""
)
def thread_verdict_counts(t):
    return thread_statistics(threads(t))


@query(f"SELECT event, count(*) AS n FROM ({THREADS}) GROUP BY event")
def threads_by_event(t):
    return part_counts(threads(t), "event")


@query(f"SELECT label, count(*) AS n FROM ({THREADS}) GROUP BY label")
def thread_label_counts(t):
    return value_counts(threads(t), "label")


@query(f"SELECT thread_id, event, 'no text' AS reason FROM ({TWEETS}) WHERE turn = 0 AND has_text = 0")
def threads_without_text(t):
    return rejected_threads(thread_files(t)).select("thread_id", "event", "reason")


def _tweets_of_events(t: Inputs):
    """Tweets as JSON, with optional keys left out as they are in real ones."""
    e = t("events")
    i = F.col("event_id")
    url = F.struct(F.when(i % 2 == 0, F.concat(F.lit("https://x.org/"), i)).alias("expanded_url"), F.lit("u").alias("url"))
    other = F.struct(F.lit("https://y.org").alias("expanded_url"), F.lit("v").alias("url"))
    tag = F.struct(F.when(i % 4 != 0, F.concat(F.lit("tag"), i % 10)).alias("text"), F.lit(1).alias("n"))
    entities = F.struct(
        F.array(url, other).alias("urls"), F.array(tag).alias("hashtags"), F.when(i % 5 == 0, F.array(F.lit(1))).alias("media")
    )
    user = F.struct(
        F.concat(F.lit("u"), "user_id").alias("id_str"),
        F.when(i % 6 != 0, i % 1000).alias("followers_count"),
        (i % 2 == 0).alias("verified"),
    )
    record = F.struct(
        i.cast("string").alias("id_str"),
        F.when(i % 9 != 0, F.col("event_type")).alias("text"),
        F.when(i % 7 != 0, user).alias("user"),
        F.when(i % 8 != 0, entities).alias("entities"),
        F.when(i % 3 == 0, i).alias("retweet_count"),
        F.col("event_type").alias("lang"),
    )
    return e.select("event_id", F.to_json(record).alias("value"))


@query(
    """SELECT event_id, CASE WHEN event_id % 9 <> 0 THEN event_type END AS text,
        CASE WHEN event_id % 7 <> 0 THEN concat('u', user_id) END AS user_id,
        CASE WHEN event_id % 7 <> 0 THEN CASE WHEN event_id % 6 <> 0 THEN event_id % 1000 ELSE 0 END END AS followers,
        CASE WHEN event_id % 7 <> 0 THEN event_id % 2 = 0 END AS verified,
        CASE WHEN event_id % 3 = 0 THEN event_id ELSE 0 END AS retweets, CAST(0 AS BIGINT) AS favorites, event_type AS lang,
        event_id % 8 <> 0 AND event_id % 5 = 0 AS has_media,
        CASE WHEN event_id % 8 = 0 THEN '' WHEN event_id % 2 = 0 THEN concat('https://x.org/', event_id, '|https://y.org')
            ELSE 'https://y.org' END AS urls,
        CASE WHEN event_id % 8 = 0 OR event_id % 4 = 0 THEN '' ELSE concat('tag', event_id % 10) END AS hashtags
    FROM {events}"""
)
def tweet_records(t):
    v = F.try_parse_json("value")
    m = tweet_metadata(v)
    user, tweet = m["user"], m["tweet"]
    return _tweets_of_events(t).select(
        "event_id",
        tweet_text(v).alias("text"),
        user["id"].alias("user_id"),
        user["followers_count"].alias("followers"),
        user["verified"].alias("verified"),
        tweet["retweet_count"].alias("retweets"),
        tweet["favorite_count"].alias("favorites"),
        tweet["lang"].alias("lang"),
        tweet["has_media"].alias("has_media"),
        F.array_join(m["urls"], "|").alias("urls"),
        F.array_join(m["hashtags"], "|").alias("hashtags"),
    )


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM {events}")
def json_properties(t):
    return t("events").select("event_id", F.try_variant_get(F.try_parse_json("props"), "$.k", "bigint").alias("k"))

"""Articles, derived from documents, labels, pages and events."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import sqltext as S
from checks.tables import ARTICLES, Inputs, query
from veracity_prep.functions.text import ENGLISH_STOPWORDS
from veracity_prep.functions.urls import all_image_urls, declared_image_urls, html_image_urls
from veracity_prep.operators.stats import article_image_summary, part_counts
from veracity_prep.plans.articles import (
    article_image_plan,
    article_image_urls,
    article_outcomes,
    article_text,
    author_list,
    build_articles,
    tweet_counts,
)
from veracity_prep.sources.articles import ArticleFiles, parse_article_files

TEXT = """CASE WHEN text <> '' THEN text WHEN title IS NOT NULL THEN
    CASE WHEN description IS NULL THEN title ELSE title || ' ' || description END END"""


def article_files(t: Inputs) -> ArticleFiles:
    """Paths and JSON texts of an article tree, sorted into roles by path as a scan would."""
    a = t.adapt(ARTICLES)
    i = F.col("doc_id")
    record = F.struct(
        "text", "title", F.col("description").alias("meta_description"),
        F.concat(F.lit("https://x.org/"), "article_id").alias("url"),
        F.when(i % 3 != 0, F.array(F.lit("https://x.org/1.png"), F.concat(F.lit("https://x.org/"), i, F.lit(".png")))).alias("images"),
        F.when(i % 4 == 0, F.lit("https://x.org/1.png")).alias("image"),
    )
    # A list of authors, a single author, or none.
    authors = (
        F.when(i % 3 == 0, F.concat(F.lit(',"authors":["'), "author", F.lit('","B"]}')))
        .when(i % 3 == 1, F.concat(F.lit(',"authors":"'), "author", F.lit('"}')))
        .otherwise("}")
    )
    body = F.to_json(record)
    root = F.concat_ws("/", F.lit("/data"), "source", "label", "article_id")
    contents = a.select(
        F.concat(root, F.lit("/news content.json")).alias("path"),
        F.concat(F.substring(body, F.lit(1), F.length(body) - 1), authors).alias("value"),
    )
    tweets = a.join(t("events"), F.col("event_id") % 1000 == F.col("doc_id")).select(
        F.concat(root, F.lit("/tweets/"), "event_id", F.lit(".json")).alias("path"), F.lit("{}").alias("value")
    )
    return parse_article_files(contents.unionByName(tweets))


def articles(t: Inputs):
    return build_articles(article_files(t))


TWEETS = f"""SELECT a.source, a.label, a.article_id, count(*) AS tweet_count FROM ({ARTICLES}) a
    JOIN {{events}} e ON e.event_id % 1000 = a.doc_id GROUP BY a.source, a.label, a.article_id"""
AUTHORS = "CASE doc_id % 3 WHEN 0 THEN author || '|B' WHEN 1 THEN author ELSE '' END"
DECLARED = """concat(CASE WHEN doc_id % 3 <> 0 THEN concat('https://x.org/1.png|https://x.org/', doc_id, '.png') ELSE '' END,
    CASE WHEN doc_id % 3 <> 0 AND doc_id % 4 = 0 THEN '|' ELSE '' END, CASE WHEN doc_id % 4 = 0 THEN 'https://x.org/1.png' ELSE '' END)"""
ITEMS = f"""SELECT concat(a.source, '_', a.article_id) AS id, a.source, raw_text,
        {S.preprocessed('c', ENGLISH_STOPWORDS)} AS processed_text, a.label AS original_label,
        CASE WHEN a.label = 'fake' THEN 'false' ELSE 'true' END AS label, coalesce(title, '') AS title, concat('https://x.org/', a.article_id) AS url,
        {AUTHORS} AS authors, {DECLARED} AS image_urls,
        CAST(CASE WHEN doc_id % 3 <> 0 THEN 2 ELSE 0 END + CASE WHEN doc_id % 4 = 0 THEN 1 ELSE 0 END AS INTEGER) AS image_count,
        coalesce(description, '') AS description, coalesce(n.tweet_count, 0) AS tweet_count, a.article_id
    FROM (SELECT *, {S.clean_plain('raw_text')} AS c FROM (SELECT *, {TEXT} AS raw_text FROM ({ARTICLES}))) a
    LEFT JOIN ({TWEETS}) n ON n.source = a.source AND n.label = a.label AND n.article_id = a.article_id
    WHERE raw_text IS NOT NULL"""


@query(f"SELECT id, source, raw_text, processed_text, original_label, label, title, url, authors, image_urls, image_count, description, tweet_count FROM ({ITEMS})")
def article_items(t):
    m = F.col("metadata")
    return articles(t).select(
        "id", "source", "raw_text", "processed_text", "original_label", "label",
        *[m[c].alias(c) for c in ("title", "url", "image_count", "description", "tweet_count")],
        F.array_join(m["authors"], "|").alias("authors"), F.array_join(m["image_urls"], "|").alias("image_urls"),
    )


@query(f"SELECT article_id, {TEXT} AS raw_text FROM ({ARTICLES})")
def article_texts(t):
    raw = article_text(F.col("text"), F.col("title"), F.col("description"))
    return t.adapt(ARTICLES).select("article_id", raw.alias("raw_text"))


@query(TWEETS)
def article_tweet_counts(t):
    return tweet_counts(article_files(t).tweet_names)


@query(f"SELECT article_id, {AUTHORS} AS authors FROM ({ARTICLES})")
def article_authors(t):
    return article_files(t).contents.select(
        "article_id", F.array_join(author_list(F.try_parse_json("value")), "|").alias("authors")
    )


@query(f"SELECT source, original_label, count(*) AS n FROM ({ITEMS}) GROUP BY source, original_label")
def articles_by_source_and_label(t):
    return part_counts(articles(t), "source", "original_label")


# Image addresses of pages: a list, tags added to the HTML, and a single field.
PAGE_IMAGES = """
    SELECT page_id, url, CASE WHEN page_id % 2 = 0 THEN 'gossipcop' ELSE 'politifact' END AS source,
        CASE WHEN page_id % 3 = 0 THEN 'real' ELSE 'fake' END AS label, concat('a', CAST(page_id AS STRING)) AS article_id,
        concat(html, '<img src="', url, '/a.png"><IMG src="skip"><img src="data:x"><img alt="n"><img class="c" src=" ', url, '/b c.gif ">') AS html
    FROM {pages}"""
_LIST = "[concat(url, '/img_', k, '.jpg') for k in range(page_id % 4)]"
_HTML = "[concat(url, '/a.png'), concat(url, '/b c.gif')]"
_ONE = "CASE WHEN page_id % 3 = 0 THEN [concat(url, '/img_0.jpg')] ELSE [] END"
ALL_URLS = f"SELECT *, list_sort(list_distinct(list_concat({_LIST}, {_HTML}, {_ONE}))) AS urls FROM ({PAGE_IMAGES})"


def _page_fields():
    n, url = F.col("page_id") % 4, F.col("url")
    images = F.when(
        n > 0,
        F.transform(F.sequence(F.lit(0).cast("bigint"), n - 1), lambda k: F.concat(url, F.lit("/img_"), k, F.lit(".jpg"))),
    )
    image = F.when(F.col("page_id") % 3 == 0, F.concat(url, F.lit("/img_0.jpg"))).otherwise("")
    return images, image


@query(f"SELECT page_id, array_to_string({_HTML}, '|') AS urls FROM {{pages}}")
def html_image_sources(t):
    return t.adapt(PAGE_IMAGES).select("page_id", F.array_join(html_image_urls(F.col("html")), "|").alias("urls"))


@query(f"SELECT page_id, array_to_string(urls, '|') AS urls, len(urls) AS n FROM ({ALL_URLS})")
def distinct_image_urls(t):
    images, image = _page_fields()
    urls = all_image_urls(images, F.col("html"), image)
    return t.adapt(PAGE_IMAGES).select(
        "page_id", F.array_join(urls, "|").alias("urls"), F.size(urls).cast("bigint").alias("n")
    )


@query(f"SELECT page_id, array_to_string(list_concat({_LIST}, {_ONE}), '|') AS urls FROM ({PAGE_IMAGES})")
def declared_image_lists(t):
    images, image = _page_fields()
    return t.adapt(PAGE_IMAGES).select("page_id", F.array_join(declared_image_urls(images, image), "|").alias("urls"))


def _page_contents(t: Inputs):
    images, image = _page_fields()
    record = F.struct(images.alias("images"), F.col("html").alias("text"), image.alias("image"))
    return t.adapt(PAGE_IMAGES).select("source", "label", "article_id", F.lit("f").alias("file"), F.to_json(record).alias("value"))


_NAME = r"regexp_extract(regexp_replace(regexp_replace(u, '^[a-z]+://[^/?#]*', ''), '[?#].*', ''), '[^/]*$')"
_NAMED = rf"""CASE WHEN n = '' THEN printf('image_%04d.jpg', CAST(concat('0x', substring(md5(u), 1, 8)) AS BIGINT) % 10000)
    ELSE regexp_replace(CASE WHEN contains(n, '.') THEN n ELSE concat(n, '.jpg') END, '[^\p{{L}}\p{{N}}._\-]', '', 'g') END"""
FETCHES = f"""SELECT source, label, article_id, u AS url, concat('/out/', source, '/', label, '/', article_id, '/', {_NAMED}) AS target
    FROM (SELECT *, {_NAME} AS n FROM (SELECT source, label, article_id, unnest(urls) AS u FROM ({ALL_URLS})))"""


@query(f"SELECT * FROM ({FETCHES}) WHERE NOT ends_with(target, 'a1/img_0.jpg') AND NOT ends_with(target, '/a.png')")
def article_image_fetches(t):
    urls = article_image_urls(_page_contents(t))
    everything = article_image_plan(urls, "/out", urls.select(F.lit("x").alias("path")))
    there = everything.where(F.col("target").endswith("a1/img_0.jpg") | F.col("target").endswith("/a.png"))
    plan = article_image_plan(urls, "/out", there.select(F.col("target").alias("path")))
    return plan.select("source", "label", "article_id", "url", "target")


FETCHED = f"SELECT article_id, u, contains(u, 'img') AS ok FROM (SELECT article_id, unnest(urls) AS u FROM ({ALL_URLS}))"


@query(
    f"""SELECT (SELECT count(*) FROM {{pages}}) AS total_articles, count(*) AS total_urls, count(*) FILTER (ok) AS downloaded,
    count(*) FILTER (NOT ok) AS failed, count(DISTINCT article_id) AS articles_with_images FROM ({FETCHED})"""
)
def article_fetch_summary(t):
    urls = article_image_urls(_page_contents(t))
    each = urls.select("source", "label", "article_id", F.explode("urls").alias("url"))
    outcomes = each.withColumn("fetched", F.col("url").contains("img"))
    return article_image_summary(article_outcomes(urls, outcomes))

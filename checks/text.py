"""Text operators over documents, pages and conversations."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import sqltext as S
from checks.tables import LINKED_TEXT, Inputs, query
from veracity_prep.functions import text as T
from veracity_prep.functions import urls as U
from veracity_prep.functions.labels import known_label
from veracity_prep.functions.stem import stem_tokens
from veracity_prep.operators.stats import value_counts
from veracity_prep.operators.text import finished_text, lemmatize_by_join, prepared_tokens, preprocess
from veracity_prep.options import TextOptions

WORDS = T.ENGLISH_STOPWORDS
LINKED = f"({LINKED_TEXT}) t"


def _linked(t: Inputs):
    return t.adapt(LINKED_TEXT)


@query(f"SELECT doc_id, {S.urls('text')} AS masked FROM {LINKED}")
def mask_urls(t):
    return _linked(t).select("doc_id", T.replace_urls(F.col("text")).alias("masked"))


@query(f"SELECT doc_id, {S.emails('text')} AS masked FROM {{documents}}")
def mask_emails(t):
    return t("documents").select("doc_id", T.replace_emails(F.col("text")).alias("masked"))


@query(f"SELECT doc_id, {S.numbers('text')} AS masked FROM {{documents}}")
def mask_numbers(t):
    return t("documents").select("doc_id", T.replace_numbers(F.col("text")).alias("masked"))


@query(f"SELECT doc_id, {S.blanks('text')} AS collapsed FROM {{documents}}")
def collapse_whitespace(t):
    return t("documents").select("doc_id", T.collapse_whitespace(F.col("text")).alias("collapsed"))


@query("SELECT doc_id, CAST(toxic AS VARCHAR) AS toxic, CASE WHEN toxic = 0 THEN '' ELSE 'x' END AS emptied FROM {labels}")
def text_of_any_type(t):
    maybe = F.when(F.col("toxic") != 0, F.lit("x"))
    return t("labels").select("doc_id", T.as_text(F.col("toxic")).alias("toxic"), T.as_text(maybe).alias("emptied"))


@query(f"SELECT page_id, {S.html('html')} AS text FROM {{pages}}")
def strip_page_html(t):
    return t("pages").select("page_id", T.strip_html(F.col("html")).alias("text"))


@query(f"SELECT page_id, {S.clean_plain('t')} AS cleaned FROM (SELECT page_id, {S.html('html')} AS t FROM {{pages}})")
def clean_pages(t):
    return t("pages").select("page_id", T.clean_text(F.col("html")).alias("cleaned"))


@query(f"SELECT doc_id, {S.clean_plain('text')} AS cleaned FROM {LINKED}")
def clean_documents(t):
    return _linked(t).select("doc_id", T.clean_text(F.col("text")).alias("cleaned"))


@query(f"SELECT doc_id, len(tk) AS n_tokens, {S.joined('tk')} AS tokens FROM (SELECT doc_id, {S.tokens('text')} AS tk FROM {{documents}})")
def tokenize_documents(t):
    tokens = T.tokenize(F.col("text"))
    return t("documents").select(
        "doc_id", F.size(tokens).cast("bigint").alias("n_tokens"), T.join_tokens(tokens).alias("tokens")
    )


@query(f"SELECT doc_id, {S.joined(S.stopped(S.tokens('text'), WORDS))} AS kept FROM {{documents}}")
def drop_document_stopwords(t):
    kept = T.drop_stopwords(T.tokenize(F.col("text")), WORDS)
    return t("documents").select("doc_id", T.join_tokens(kept).alias("kept"))


@query("SELECT doc_id, substring(text, 1, 2048) AS head, length(substring(text, 1, 2048)) AS n FROM {documents}")
def truncate_documents(t):
    head = T.truncate(F.col("text"))
    return t("documents").select("doc_id", head.alias("head"), F.length(head).cast("bigint").alias("n"))


@query(f"SELECT doc_id, {S.preprocessed('c', WORDS)} AS processed FROM (SELECT doc_id, {S.clean_plain('text')} AS c FROM {LINKED})")
def preprocess_documents(t):
    return preprocess(_linked(t), "text", "processed").select("doc_id", "processed")


@query(
    f"SELECT page_id, {S.preprocessed('c', WORDS)} AS processed FROM (SELECT page_id, {S.clean_plain('t')} AS c "
    f"FROM (SELECT page_id, {S.html('html')} AS t FROM {{pages}}))"
)
def preprocess_pages(t):
    return preprocess(t("pages"), "html", "processed").select("page_id", "processed")


@query(
    f"SELECT conv_id, turn, {S.preprocessed('c', WORDS)} AS processed "
    f"FROM (SELECT conv_id, turn, {S.clean_plain('text')} AS c FROM {{conversations}})"
)
def preprocess_conversations(t):
    return preprocess(t("conversations"), "text", "processed").select("conv_id", "turn", "processed")


@query(
    f"""SELECT label, count(*) AS n, sum(length(processed)) AS chars FROM (
        SELECT d.doc_id, coalesce(l.label, 'unknown') AS label, {S.preprocessed('c', WORDS)} AS processed
        FROM (SELECT doc_id, {S.clean_plain('text')} AS c FROM {{documents}}) d
        LEFT JOIN (SELECT doc_id, CASE WHEN quality = 1 THEN 'true' ELSE 'false' END AS label FROM {{labels}}) l
        ON d.doc_id = l.doc_id) GROUP BY label""".replace("sum(length(processed))", "CAST(sum(length(processed)) AS BIGINT)")
)
def labelled_text_summary(t):
    labels = t("labels").select("doc_id", F.when(F.col("quality") == 1, "true").otherwise("false").alias("label"))
    texts = preprocess(t("documents"), "text", "processed").select("doc_id", "processed")
    return (
        texts.join(labels, "doc_id", "left")
        .groupBy(known_label(F.col("label")).alias("label"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("processed").cast("bigint")).alias("chars"))
    )


@query()
def stem_documents(t):
    options = TextOptions(stemming=True)
    return preprocess(t("documents"), "text", "processed", options).select("doc_id", "processed")


@query()
def stem_vocabulary(t):
    words = t("documents").select(F.explode(F.array_distinct(T.tokenize(F.lower("text")))).alias("word")).distinct()
    return words.select("word", stem_tokens(F.array("word"))[0].alias("stem"))


# Turns with clitics, in chains, at word ends and on their own.
CLITICS = """SELECT conv_id, turn,
    concat(text, ' Don''t say it''s ', role, '''s, we''LL can''t; n''t ''same ''s''s''d I''m') AS text FROM {conversations}"""


@query(f"SELECT conv_id, turn, {S.joined(S.tokens('text'))} AS tokens FROM ({CLITICS})")
def split_contractions(t):
    return t.adapt(CLITICS).select("conv_id", "turn", T.join_tokens(T.tokenize(F.col("text"))).alias("tokens"))


# Turns inside quotation marks, with dashes, ellipses and words that are two tokens.
RULED = """SELECT conv_id, turn, concat('"', text, '" -- ', role, '... ("I cannot cannot", she said: "Gonna ""go""?" WANNA gotta.... ---',
    ' lemme gimme ''tis ''Twas d''ye scannot cannots more''n rock ''n roll ''''quoted'''' ``so`` "', CASE WHEN turn % 2 = 0 THEN text ELSE '' END, '"') AS text
    FROM {conversations}"""


@query(f"SELECT conv_id, turn, {S.joined(S.tokens('text'))} AS tokens FROM ({RULED})")
def tokenize_with_rules(t):
    return t.adapt(RULED).select("conv_id", "turn", T.join_tokens(T.tokenize(F.col("text"))).alias("tokens"))


# A lexicon of the longer words of the benchmark texts.
LEXICON = f"""SELECT DISTINCT form, substring(form, 1, 4) AS lemma FROM (
    SELECT unnest({S.tokens('text')}) AS form FROM {{benchmark}}) WHERE length(form) > 5"""
LEMMATIZED = f"""SELECT d.doc_id, substring(string_agg(coalesce(x.lemma, d.tok), ' ' ORDER BY d.pos), 1, 2048) AS processed FROM (
    SELECT doc_id, unnest(tk) AS tok, generate_subscripts(tk, 1) AS pos FROM (
        SELECT doc_id, {S.stopped(S.tokens('c'), WORDS)} AS tk FROM (
            SELECT doc_id, {S.clean_plain('text')} AS c FROM {{documents}}))) d
    LEFT JOIN ({LEXICON}) x ON x.form = d.tok GROUP BY d.doc_id"""


def _lexicon(t: Inputs):
    words = t("benchmark").select(F.explode(T.tokenize(F.col("text"))).alias("form")).where(F.length("form") > 5)
    return words.distinct().withColumn("lemma", F.substring("form", 1, 4))


@query(LEMMATIZED)
def lemmatize_documents(t):
    done = preprocess(t("documents"), "text", "processed", TextOptions(), _lexicon(t), ["doc_id"])
    return done.select("doc_id", "processed")


@query(LEMMATIZED)
def lemmatize_documents_by_join(t):
    tokens = t("documents").select("doc_id", prepared_tokens(F.col("text"), TextOptions()).alias("tokens"))
    done = lemmatize_by_join(tokens, "tokens", _lexicon(t), ["doc_id"])
    return done.select("doc_id", finished_text(F.col("tokens"), TextOptions()).alias("processed"))


@query(
    f"""SELECT doc_id, {S.joined(S.stopped('tk', ('die', 'der', 'und')))} AS kept
    FROM (SELECT doc_id, {S.tokens('text')} AS tk FROM {{documents}})"""
)
def drop_own_stopwords(t):
    kept = T.drop_stopwords(T.tokenize(F.col("text")), ("die", "der", "und"))
    return t("documents").select("doc_id", T.join_tokens(kept).alias("kept"))


@query(
    f"SELECT w AS word, count(*) AS n FROM (SELECT unnest({S.tokens('lower(text)')}) AS w FROM {{documents}}) GROUP BY w"
)
def word_counts(t):
    return value_counts(t("documents").select(F.explode(T.tokenize(F.lower("text"))).alias("word")), "word")


# URLs. The path is cut out by hand, decoded, and its last segment filtered.
_BASE = r"""regexp_extract(url_decode(replace(regexp_replace(regexp_replace(url, '^[a-z]+://[^/?#]*', ''), '[?#].*', ''), '+', '%2B')), '[^/]*$')"""
_EXT = r"regexp_extract({0}, '^\.*[^.].*(\.[^.]*)$', 1)"
FILE_NAMES = rf"""
    SELECT page_id, name FROM (
        SELECT page_id, CASE WHEN base = '' THEN printf('image_%04d.jpg', CAST(concat('0x', substring(md5(url), 1, 8)) AS BIGINT) % 10000)
            ELSE regexp_replace(CASE WHEN {_EXT.format('base')} = '' THEN concat(base, '.jpg') ELSE base END, '[^\p{{L}}\p{{N}}._\-]', '', 'g') END AS name
        FROM (SELECT page_id, url, {_BASE} AS base FROM {{pages}}))"""


@query(FILE_NAMES)
def url_file_names(t):
    return t("pages").select("page_id", U.file_name(F.col("url")).alias("name"))


@query("SELECT page_id, printf('image_%04d.jpg', CAST(concat('0x', substring(md5(url), 1, 8)) AS BIGINT) % 10000) AS name FROM {pages}")
def url_fallback_names(t):
    return t("pages").select("page_id", U.fallback_name(F.col("url")).alias("name"))


@query(
    r"""SELECT page_id, CASE WHEN e = '' THEN '.jpg' ELSE e END AS ext, lower(substring(e, 2)) AS format FROM (
        SELECT page_id, regexp_extract(regexp_extract(url, '[^/]*$'), '^\.*[^.].*(\.[^.]*)$', 1) AS e FROM {pages})"""
)
def url_extensions(t):
    url = F.col("url")
    return t("pages").select("page_id", U.extension_or_jpg(url).alias("ext"), U.format_name(url).alias("format"))


@query("SELECT page_id, starts_with(url, 'http://') OR starts_with(url, 'https://') AS ok FROM {pages}")
def fetchable_urls(t):
    return t("pages").select("page_id", U.is_http(F.col("url")).alias("ok"))

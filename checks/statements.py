"""Statements, derived from events."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import sqltext as S
from checks.tables import ANNOTATIONS, STATEMENTS, Inputs, query
from veracity_prep.functions import labels as L
from veracity_prep.functions.text import ENGLISH_STOPWORDS
from veracity_prep.operators.stats import part_counts
from veracity_prep.plans.statements import build_statements

LABEL = """CASE label WHEN 'pants-fire' THEN 'false' WHEN 'false' THEN 'false' WHEN 'barely-true' THEN 'false'
    WHEN 'half-true' THEN 'mixed' WHEN 'mostly-true' THEN 'true' WHEN 'true' THEN 'true' ELSE 'unknown' END"""
_B, _F, _H, _M, _P = (
    f"CAST(coalesce({c}, 0) AS INTEGER)"
    for c in ("barely_true_counts", "false_counts", "half_true_counts", "mostly_true_counts", "pants_on_fire_counts")
)
TOTAL = f"({_B} + {_F} + {_H} + {_M} + {_P})"
SCORE = f"""CASE WHEN {TOTAL} > 0 THEN round(CAST(0.75 * {_M} + 0.5 * {_H} + 0.25 * {_B} - 0.5 * {_P} AS DOUBLE)
    / CAST({TOTAL} AS DOUBLE), 9) END"""


def raw_statements(t: Inputs):
    row = F.struct(F.lit("f").alias("file"), F.lit(0).cast("bigint").alias("block"), F.regexp_extract("id", r"\d+", 0).cast("bigint").alias("row"))
    return t.adapt(STATEMENTS).withColumn("position", row)


def statements(t: Inputs):
    return build_statements(raw_statements(t))


@query(f"SELECT id, {LABEL} AS label FROM ({STATEMENTS})")
def statement_labels(t):
    return t.adapt(STATEMENTS).select("id", L.statement_label(F.col("label")).alias("label"))


@query(
    f"""SELECT id, {_B} AS barely_true, {_F} AS "false", {_H} AS half_true, {_M} AS mostly_true, {_P} AS pants_on_fire,
        {TOTAL} AS total_statements, {SCORE} AS reliability_score FROM ({STATEMENTS})"""
)
def speaker_reliability(t):
    return statements(t).select(
        "id",
        "metadata.speaker_history.*",
        "metadata.total_statements",
        F.round("metadata.reliability_score", 9).alias("reliability_score"),
    )


@query(
    f"""SELECT id, split, statement AS raw_text, {S.preprocessed('c', ENGLISH_STOPWORDS)} AS processed_text, label AS original_label,
        {LABEL} AS standard, subject, speaker, job_title AS speaker_job, state_info AS state, party, context, {SCORE} AS score
        FROM (SELECT *, {S.clean_plain('statement')} AS c FROM ({STATEMENTS}))"""
)
def statement_items(t):
    m = [f"metadata.{c}" for c in ("subject", "speaker", "speaker_job", "state", "party", "context")]
    return statements(t).select(
        "id", "split", "raw_text", "processed_text", "original_label", F.col("label").alias("standard"), *m,
        F.round("metadata.reliability_score", 9).alias("score"),
    )


@query(f"SELECT split, count(*) AS n FROM ({STATEMENTS}) GROUP BY split")
def statements_by_split(t):
    return part_counts(statements(t), "split")


VERDICT = """CASE WHEN misinformation IS NOT NULL AND verified IS NOT NULL THEN
        CASE WHEN misinformation = 0 AND verified = 0 THEN 'unverified' WHEN misinformation = 0 AND verified = 1 THEN 'true'
            WHEN misinformation = 1 AND verified = 0 THEN 'false' END
    WHEN misinformation IS NOT NULL THEN CASE misinformation WHEN 0 THEN 'unverified' WHEN 1 THEN 'false' END END"""


@query(
    f"""SELECT doc_id, v AS label, CASE v WHEN 'false' THEN 0 WHEN 'true' THEN 1 WHEN 'unverified' THEN 2 END AS code,
        coalesce(v, 'unknown') AS known FROM (SELECT doc_id, {VERDICT} AS v FROM ({ANNOTATIONS}))"""
)
def annotation_verdicts(t):
    misinformation, verified = F.col("misinformation"), F.col("verified")
    label = L.annotation_label(misinformation, verified, misinformation.isNotNull(), verified.isNotNull())
    return t.adapt(ANNOTATIONS).select(
        "doc_id", label.alias("label"), L.label_code(label).alias("code"), L.known_label(label).alias("known")
    )


@query(
    """SELECT doc_id, CASE WHEN quality = 1 THEN 'true' ELSE 'false' END AS label FROM {labels}"""
)
def article_labels(t):
    raw = F.when(F.col("quality") == 1, "real").otherwise("fake")
    return t("labels").select("doc_id", L.article_label(raw).alias("label"))

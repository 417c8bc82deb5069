"""The whole job in stages, over corpora and lists that are written first; what the stages wrote is read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.images import PLAN
from checks.metadata import COMBINED, RECORDS, STATISTICS, TEXTS, article_images, corpora
from checks.metadata import record as image_record
from checks.splits import REPORT_BY_LABEL, STRATIFIED, items
from checks.statements import SCORE, TOTAL, statements
from checks.tables import IMAGE_LINES, STATEMENTS, TWEET_LINES, Inputs, query
from veracity_prep.options import Options
from veracity_prep.plans.ledger import read_ledger
from veracity_prep.plans.run import CORPORA, Corpus, Paths, register_corpus, run
from veracity_prep.schemas import EXIF_TYPE
from veracity_prep.sources.processed import write_table


def written_corpora(t: Inputs) -> Paths:
    """The tables of the stages ``text`` and ``images``."""
    paths = Paths(t.shared_folder(), {"statements": "", "threads": "", "articles": ""})
    for name, corpus in corpora(t).items():
        write_table(corpus, paths.table("text", name))
    images = article_images(t).withColumn("exif", F.create_map().cast(EXIF_TYPE))
    write_table(images, paths.table("images", "articles"))
    return paths


@query(STATISTICS)
def run_writes_statistics(t):
    paths = written_corpora(t)
    run(t.spark, paths, Options(), ["metadata"])
    return t.spark.read.parquet(paths.table("metadata", "statistics"))


@query(
    f"""SELECT c.dataset, c.id, c.label, x.raw_text, x.processed_text, CASE WHEN c.dataset = 'articles' THEN coalesce(r.n, 0) ELSE 0 END AS n_images,
        coalesce(r.records, '') AS images
    FROM ({COMBINED}) c JOIN ({TEXTS}) x ON x.dataset = c.dataset AND x.id = c.id
    LEFT JOIN ({RECORDS}) r ON c.dataset = 'articles' AND r.source = c.source AND r.article_id = c.article_id"""
)
def run_writes_simplified_items(t):
    paths = written_corpora(t)
    run(t.spark, paths, Options(buckets=16), ["metadata"])
    simple = t.spark.read.parquet(paths.table("integrated", "simplified"))
    return simple.select(
        F.col("dataset").cast("string"), "id", "label", "text.raw_text", "text.processed_text", F.col("image_count").alias("n_images"),
        F.array_join(F.transform("images", image_record), "|").alias("images"),
    )


@query(REPORT_BY_LABEL)
def run_writes_split_report(t):
    paths = Paths(t.shared_folder(), {})
    write_table(items(t), paths.table("metadata", "combined"), "dataset")
    run(t.spark, paths, Options(), ["splits"])
    report = t.spark.read.parquet(paths.table("reports", "splits", "stratified", "label"))
    return report.withColumn("split", F.col("split").cast("string")).withColumn("share", F.round("share", 9))


def written_lists(t: Inputs) -> Paths:
    """An image corpus that has its lists and no files yet."""
    folder = t.shared_folder()
    t.adapt(IMAGE_LINES).write.text(f"{folder}/in/set_images.txt")
    t.adapt(TWEET_LINES).write.text(f"{folder}/in/tweets_images.txt")
    return Paths(f"{folder}/out", {}, listed_images=f"{folder}/in")


@query(f"SELECT image_id, image_url, bucket, substring(target, 6) AS target FROM ({PLAN})")
def run_writes_fetch_plan(t):
    paths = written_lists(t)
    run(t.spark, paths, Options(), ["fetches"])
    plan = t.spark.read.parquet(paths.table("fetches", "images"))
    target = F.regexp_extract("target", "/in/images/(.*)$", 1)
    return plan.select("image_id", "image_url", F.col("bucket").cast("string"), target.alias("target"))


@query(
    f"""SELECT 'fetches' AS stage, CAST(2 AS BIGINT) AS finished, 2 * count(*) AS n FROM ({PLAN})
    UNION ALL SELECT 'splits', 3, count(*) FROM ({STRATIFIED})"""
)
def run_resumes_where_inputs_changed(t):
    """Two stages, run again as they are, then with another seed, then with a longer list: a stage is repeated when its own inputs changed."""
    paths = written_lists(t)
    write_table(items(t), paths.table("metadata", "combined"), "dataset")
    stages, seed = ["fetches", "splits"], Options(split=Options().split.__class__(seed=5))
    assert run(t.spark, paths, Options(), stages, resume=True) == stages
    assert run(t.spark, paths, Options(), stages, resume=True) == []
    assert run(t.spark, paths, seed, stages, resume=True) == ["splits"]
    t.adapt(IMAGE_LINES).write.mode("append").text(f"{paths.listed_images}/set_images.txt")
    assert run(t.spark, paths, seed, stages, resume=True) == ["fetches"]
    assert run(t.spark, paths, Options(), ["splits"]) == ["splits"]
    finished = read_ledger(t.spark, paths.table("ledger")).groupBy("stage").agg(F.count(F.lit(1)).alias("finished"))
    written = {"fetches": ("fetches", "images"), "splits": ("splits", "stratified")}
    tables = [t.spark.read.parquet(paths.table(*w)).select(F.lit(stage).alias("stage")) for stage, w in written.items()]
    rows = tables[0].unionByName(tables[1]).groupBy("stage").agg(F.count(F.lit(1)).alias("n"))
    return finished.join(rows, "stage").select("stage", "finished", "n")


# Documents as a corpus of their own, whose fields clash in type with those of the statements.
NOTES = """SELECT concat('n', CAST(doc_id AS STRING)) AS id, 'true' AS label, text AS raw_text, lang AS processed_text, doc_id AS position, n_chars AS reliability_score,
    concat('about ', CAST(n_chars AS STRING)) AS total_statements, n_chars > 1000 AS context FROM {documents} WHERE doc_id IS NOT NULL"""


@query(
    f"""SELECT dataset, id, score, total_statements, context FROM (
        SELECT 'statements' AS dataset, id, CAST({SCORE} AS DOUBLE) AS score, CAST({TOTAL} AS VARCHAR) AS total_statements, context FROM ({STATEMENTS})
        UNION ALL SELECT 'notes', id, CAST(reliability_score AS DOUBLE), total_statements, CAST(context AS VARCHAR) FROM ({NOTES}))"""
)
def run_unites_clashing_corpora(t):
    """A registered corpus whose number, text and flag fields have other types than the fields of the same names."""
    fields = F.struct("reliability_score", "total_statements", "context").alias("metadata")
    load = lambda spark, path, options, lexicon: t.adapt(NOTES).select("id", "label", "raw_text", "processed_text", "position", fields)
    register_corpus("notes", Corpus(load))
    try:
        paths = Paths(t.shared_folder(), {"statements": "", "notes": "unread"})
        write_table(statements(t), paths.table("text", "statements"), "split")
        notes = Paths(paths.output, {"notes": "unread"})
        run(t.spark, notes, Options(), ["text"])
        run(t.spark, paths, Options(), ["metadata"])
    finally:
        del CORPORA["notes"]
    combined = t.spark.read.parquet(paths.table("metadata", "combined"))
    return combined.select(F.col("dataset").cast("string"), "id", F.round("reliability_score", 9).alias("score"), "total_statements", "context")

"""Shapes of physical plans that matter at scale."""

import re

from pyspark.sql import functions as F

from veracity_prep.operators.splits import source_aware_split
from veracity_prep.operators.stats import dataset_statistics
from veracity_prep.operators.text import preprocess
from veracity_prep.options import Options, SplitOptions, TextOptions
from veracity_prep.plans.articles import build_articles
from veracity_prep.plans.statements import HISTORY_COLUMNS, build_statements
from veracity_prep.plans.threads import first_reactions
from veracity_prep.sources.articles import parse_article_files

DOCUMENTS = "/root/testdata/sf0.001/documents.parquet"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_preprocessing_is_one_native_stage(spark):
    text = plan(preprocess(spark.read.parquet(DOCUMENTS), "text", "processed").select("doc_id", "processed"))
    assert "Exchange" not in text and "Python" not in text and "Arrow" not in text
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in text


def test_texts_are_dealt_out_before_they_are_cleaned(spark):
    """Rows that come from a single task are cleaned by all, and moved once."""
    texts = [F.lit(c).alias(c) for c in ("split", "label", "statement", "subject", "speaker", "job_title", "state_info", "party", "context")]
    counts = [F.lit("1").alias(c) for c in HISTORY_COLUMNS.values()]
    raw = spark.range(9).coalesce(1).select(F.col("id").cast("string"), F.struct("id").alias("position"), *texts, *counts)
    text = plan(build_statements(raw))
    assert text.count("Exchange") == 1 and "Exchange hashpartitioning(position" in text
    files = spark.createDataFrame([("/d/gossipcop/real/a1/news content.json", '{"text":"one two"}')], "path string, value string").coalesce(1)
    text = plan(build_articles(parse_article_files(files)))
    assert re.search(r"Exchange hashpartitioning\(source#\d+, label#\d+, article_id#\d+, \d+\), REPARTITION_BY_COL", text)


def test_stemming_needs_no_shuffle(spark):
    text = plan(preprocess(spark.read.parquet(DOCUMENTS), "text", "processed", TextOptions(stemming=True)))
    assert "Exchange" not in text and "ArrowEvalPython" in text


def test_python_jobs_are_planned_over_any_input(spark):
    # Nested lambdas that share a variable would make this fail now and then.
    for rows in range(1, 9):
        df = spark.createDataFrame([(i, "<p>a &#66; c</p> runs") for i in range(rows)], "k int, t string")
        done = preprocess(df, "t", "o", TextOptions(stemming=True))
        assert "ArrowEvalPython" in plan(done) and done.where("k = 0").first()["o"] == "b c run"


def test_filters_reach_the_scan(spark):
    text = plan(preprocess(spark.read.parquet(DOCUMENTS), "text", "processed").where("lang = 'de'").select("processed"))
    assert "PushedFilters: [IsNotNull(lang), EqualTo(lang,de)]" in text


def test_reaction_cut_is_applied_before_the_shuffle(spark):
    df = spark.createDataFrame([("e", "rumours", "1", "f", "{}")], "event string, kind string, thread_id string, file string, value string")
    text = plan(first_reactions(df, 10, Options()))
    assert re.search(r"WindowGroupLimit.*Partial", text) and text.count("Exchange hashpartitioning") == 1


def test_statistics_take_one_pass(spark):
    df = spark.range(10).select(F.lit("d").alias("dataset"), F.lit("l").alias("label"), F.lit("s").alias("source"), F.lit(True).alias("has_text"), F.lit(True).alias("has_images"))
    text = plan(dataset_statistics(df))
    assert text.count("Range") == 1 and text.count("Exchange") == 1 and "partial_count" in text


def test_no_cartesian_products(spark):
    import __spark_entry__ as entry

    for name in ("simplified_items", "stratified_split_by_label", "lemmatize_documents_by_join", "listed_image_records"):
        text = plan(entry.queries()[name](spark, "/root/testdata/sf0.001"))
        assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_large_groups_are_ranked_in_slices(spark):
    # Half of all rows in one group: no task may get them all.
    source = F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 500))
    df = spark.range(40_000).select(F.col("id").cast("string").alias("id"), source.alias("source"), F.lit("true").alias("label"), F.lit("d").alias("dataset"))
    split = source_aware_split(df, SplitOptions(rank_rows=1000))
    sizes = {r["split"]: r["n"] for r in split.where("source = 'hot'").groupBy("split").agg(F.sum("copies").alias("n")).collect()}
    assert sizes == {"test": 3000, "validation": 3000, "train": 14000}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = split.where("source = 'hot'").select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(parts) > 4 and max(r["count"] for r in parts) < 10_000

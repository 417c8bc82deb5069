"""Scans and jobs over small file trees."""

import pytest
from pyspark.sql import functions as F
from trees import articles, statements, threads

from veracity_prep.options import Options
from veracity_prep.plans.articles import article_image_plan, article_image_urls, article_outcomes, load_articles
from veracity_prep.plans.statements import load_statements
from veracity_prep.plans.threads import load_threads, rejected_threads
from veracity_prep.sources.articles import read_article_files
from veracity_prep.sources.statements import read_statements
from veracity_prep.sources.threads import read_thread_files


def test_statements(spark, tmp_path):
    items = load_statements(spark, str(statements(tmp_path)))
    rows = {(r["id"], r["split"]): r for r in items.collect()}
    assert set(rows) == {("1.json", "train"), ("2.json", "train"), ("3.json", "valid"), ("4.json", "valid"), ("1.json", "test")}
    first = rows["1.json", "train"]
    assert first["processed_text"] == "said [ NUMBER ] times `` '' [ URL ]"
    assert (first["label"], first["original_label"]) == ("mixed", "half-true")
    m = first["metadata"]
    assert m["speaker_history"].asDict() == {"barely_true": 1, "false": 2, "half_true": 3, "mostly_true": 4, "pants_on_fire": 5}
    assert m["total_statements"] == 15
    assert m["reliability_score"] == pytest.approx((3 + 1.5 + 0.25 - 2.5) / 15)
    second = rows["2.json", "train"]
    assert second["raw_text"] == 'Quoted "text" here'
    assert second["metadata"]["speaker_job"] is None and second["metadata"]["context"] is None
    assert second["metadata"]["reliability_score"] is None
    assert rows["3.json", "valid"]["metadata"]["speaker_job"] is None
    assert rows["3.json", "valid"]["label"] == "false"
    assert rows["4.json", "valid"]["label"] == "unknown"
    assert len({str(r["position"]) for r in rows.values()}) == 5


def test_statement_rows_are_in_file_order(spark, tmp_path):
    tmp_path.joinpath("train.tsv").write_text("".join(f"{i}.json\ttrue\tt" + "\t" * 11 + "\n" for i in range(200)))
    raw = read_statements(spark, str(tmp_path))
    last = raw.agg(F.max_by("id", "position"), F.min_by("id", "position")).first()
    assert tuple(last) == ("199.json", "0.json")


def test_quotes_across_lines(spark, tmp_path):
    assert read_statements(spark, str(statements(tmp_path)), strict_quotes=True).where("split = 'valid'").count() == 1


def test_missing_directories_are_empty(spark, tmp_path):
    none = str(tmp_path / "none")
    assert load_statements(spark, none).count() == 0
    assert load_threads(spark, none).count() == 0
    assert load_articles(spark, none).count() == 0


def test_threads(spark, tmp_path):
    rows = {(r["id"], r["is_rumor"]): r for r in load_threads(spark, str(threads(tmp_path))).collect()}
    assert set(rows) == {("10", True), ("11", True), ("15", True), ("16", True), ("10", False), ("20", False), ("21", True)}
    full = rows["10", True]
    assert (full["event"], full["label"], full["reaction_count"]) == ("ev one", "true", 12)
    assert full["processed_text"] == "Breaking : [ NUMBER ] hurt [ URL ]"
    # Ordered by file path, so the nested ones come first; the cut of ten precedes the drop of the one without text.
    assert full["reactions"] == [f"reply [ NUMBER ]"] * 9
    m = full["metadata"]
    assert m["user"].asDict() == {"id": "u1", "screen_name": "s", "verified": True, "followers_count": 9, "friends_count": 0, "statuses_count": 0, "created_at": None}
    assert m["tweet"].asDict() == {"id": "1", "created_at": "Mon", "retweet_count": 7, "favorite_count": None, "lang": "en", "has_media": True}
    assert (m["urls"], m["hashtags"]) == (["https://e.org"], ["h"])
    assert (m["rumor_id"], m["non_rumor_id"], m["event"], m["reaction_count"]) == ("10", None, "ev one", 12)
    empty = rows["11", True]
    assert (empty["raw_text"], empty["processed_text"], empty["label"], empty["reactions"], empty["reaction_count"]) == ("", "", "false", ["ok"], 2)
    assert empty["metadata"]["user"] is None
    assert rows["15", True]["label"] == rows["16", True]["label"] == "unknown"
    assert rows["10", False]["label"] == rows["20", False]["label"] == "true"
    assert rows["20", False]["metadata"]["non_rumor_id"] == "20"
    assert rows["21", True]["raw_text"] == "first"


def test_reaction_cut_is_by_name(spark, tmp_path):
    root = str(threads(tmp_path))
    rows = load_threads(spark, root, Options(reaction_cut=1)).where("id = '10' and is_rumor").collect()
    assert rows[0]["reactions"] == ["reply [ NUMBER ]"] and rows[0]["reaction_count"] == 12


def test_rejected_threads(spark, tmp_path):
    rows = rejected_threads(read_thread_files(spark, str(threads(tmp_path)))).collect()
    assert {(r["thread_id"], r["reason"]) for r in rows} == {("12", "no text"), ("13", "unreadable source tweet"), ("14", "no source tweet")}


def test_scans_read_only_their_files(spark, tmp_path):
    files = read_thread_files(spark, str(threads(tmp_path)))
    assert files.sources.count() == 10
    plan = files.annotations._jdf.queryExecution().executedPlan().toString()
    assert "file_path" in plan and "RLIKE" in plan.upper()
    # The scan of one role opens that role's files only.
    metrics = files.annotations._jdf.queryExecution().executedPlan()
    files.annotations._jdf.collectAsList()
    scan = metrics.collectLeaves().head()
    assert scan.metrics().apply("numFiles").value() == 5


def test_articles(spark, tmp_path):
    rows = {r["id"]: r for r in load_articles(spark, str(articles(tmp_path))).collect()}
    assert set(rows) == {"gossipcop_g-1", "gossipcop_g-2", "politifact_p-1", "politifact_p-5"}
    full = rows["gossipcop_g-1"]
    assert (full["label"], full["original_label"], full["source"]) == ("false", "fake", "gossipcop")
    assert full["processed_text"] == "Body [ NUMBER ] &"
    m = full["metadata"].asDict()
    assert m["authors"] == ["A", "B"] and m["keywords"] == ["k"] and m["tweet_count"] == 3
    assert m["image_urls"] == ["http://x.org/1.png", "http://x.org/1.png", "http://x.org/2.png"] and m["image_count"] == 3
    assert (m["title"], m["date_published"], m["description"], m["article_id"]) == ("T", "1234", "d", "g-1")
    second = rows["gossipcop_g-2"]
    assert (second["raw_text"], second["label"]) == ("Only desc", "true")
    assert second["metadata"]["authors"] == ["Solo"] and second["metadata"]["image_urls"] == []
    assert rows["politifact_p-1"]["raw_text"] == "Title"
    assert rows["politifact_p-1"]["metadata"]["authors"] == [] and rows["politifact_p-1"]["metadata"]["tweet_count"] == 0
    assert rows["politifact_p-5"]["processed_text"] == "Hi"


def test_article_image_fetches(spark, tmp_path):
    urls = article_image_urls(read_article_files(spark, str(articles(tmp_path))).contents)
    found = {r["article_id"]: r["urls"] for r in urls.collect()}
    assert found["g-1"] == ["http://x.org/1.png", "http://x.org/2.png"]
    assert found["p-5"] == ["http://x.org/in.png"] and found["g-2"] == found["p-3"] == []
    there = spark.createDataFrame([("/o/gossipcop/fake/g-1/1.png",)], "path string")
    plan = article_image_plan(urls, "/o", there)
    assert {r["target"] for r in plan.collect()} == {"/o/gossipcop/fake/g-1/2.png", "/o/politifact/real/p-5/in.png"}
    done = spark.createDataFrame([("gossipcop", "fake", "g-1", "http://x.org/1.png", True), ("gossipcop", "fake", "g-1", "http://x.org/2.png", False)], "source string, label string, article_id string, url string, fetched boolean")
    rows = {r["article_id"]: (r["total_urls"], r["downloaded"], r["failed"]) for r in article_outcomes(urls, done).collect()}
    assert rows["g-1"] == (2, 1, 1) and rows["p-5"] == (1, 0, 1) and rows["g-2"] == (0, 0, 0)

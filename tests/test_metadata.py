"""Metadata, links, lists, statistics, and the whole job."""

import json
import re
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, FloatType, IntegerType, LongType, NullType, StringType
from trees import article_images, articles, images, statements, threads

from veracity_prep.operators.lists import chunked_lists, first_chunks
from veracity_prep.operators.metadata import article_image_links, common_type, flat_metadata, last_by_key, link_images, union_corpora
from veracity_prep.operators.stats import dataset_statistics, download_summary
from veracity_prep.options import ImageOptions, Options, SplitOptions
from veracity_prep.plans.image_corpora import article_manifest
from veracity_prep.plans.integrate import TEXT_KEYS, IntegratedTables, article_image_records, build_metadata, corpus_texts, simplify
from veracity_prep.plans.ledger import read_ledger
from veracity_prep.plans.run import CORPORA, Corpus, Paths, register_corpus, run
from veracity_prep.sources.images import manifest_images
from veracity_prep.sources.processed import read_buckets, write_buckets


@pytest.mark.parametrize("list_rows", [1, 3, 10, 1000])
def test_lists_are_whole(spark, list_rows):
    # Key 0 holds most rows; one item of key 1 is copied many times.
    rows = [(0, f"v{i}") for i in range(60)] + [(1, "same")] * 25 + [(1, "other")] + [(k, "x") for k in range(2, 9)]
    df = spark.createDataFrame(rows, "k int, v string")
    rows += [(None, "n")] * 2 + [(None, None), (3, None)]
    want = {}
    for k, v in sorted(rows, key=lambda r: (r[1] is not None, r[1] or "")):
        want.setdefault(k, []).append(v)
    df = spark.createDataFrame(rows, "k int, v string").repartition(4)
    chunks = chunked_lists(df, ["k"], F.col("v"), list_rows).collect()
    assert {(r["k"], r["chunk"]): r["items"] for r in chunks} == {
        (k, c): v[c * list_rows : (c + 1) * list_rows] for k, v in want.items() for c in range(-(-len(v) // list_rows))
    }
    assert len(chunks) == len({(r["k"], r["chunk"]) for r in chunks})
    assert all(r["item_count"] == len(want[r["k"]]) for r in chunks)
    assert {r["k"]: r["items"] for r in first_chunks(chunked_lists(df, ["k"], F.col("v"), list_rows)).collect()} == {k: v[:list_rows] for k, v in want.items()}


def test_a_large_key_lies_in_several_tasks(spark):
    df = spark.range(40_000).select(F.lit(1).alias("k"), F.col("id").alias("v"))
    chunks = {r["chunk"]: r["items"] for r in chunked_lists(df, ["k"], F.col("v"), 7_000).collect()}
    assert [v for c in sorted(chunks) for v in chunks[c]] == list(range(40_000)) and len(chunks) == 6
    assert chunked_lists(df.limit(0), ["k"], F.col("v"), 5).count() == 0


def test_flat_metadata(spark):
    schema = "id string, raw_text string, processed_text string, label string, metadata struct<id: string, label: string, speaker: string, n: int, deep: struct<a: int>, list: array<int>, m: map<string, int>>"
    df = spark.createDataFrame([("1", "", "x", "true", ("9", "zz", "ann", 3, (1,), [1], {"a": 1})), ("2", None, "", None, None)], schema)
    flat = flat_metadata(df, "d")
    assert flat.columns == ["dataset", "id", "source", "label", "original_label", "has_text", "has_images", "speaker", "n"]
    assert [tuple(r) for r in flat.orderBy("id").collect()] == [("d", "1", "", "true", "true", True, False, "ann", 3), ("d", "2", "", None, None, False, False, None, None)]


def test_link_images(spark):
    meta = spark.createDataFrame([("gossipcop_1", "gossipcop", "1", 7), ("politifact_1", "politifact", "1", 0)], "id string, source string, article_id string, image_count int").withColumn("has_images", F.lit(False))
    pics = spark.createDataFrame([("gossipcop", "1", "/p/b", "/o/b", [1, 2], 0.5), ("gossipcop", "1", "/p/a", "/o/a", [3, 4], 0.75), ("gossipcop", "", "/p/c", "/o/c", [1, 1], 1.0), ("other", "1", "/p/d", "/o/d", [1, 1], 1.0)],
        "source string, article_id string, processed_path string, original_path string, original_size array<int>, aspect_ratio double")
    rows = {r["id"]: r for r in link_images(meta, article_image_links(pics)).collect()}
    assert (rows["gossipcop_1"]["declared_image_count"], rows["gossipcop_1"]["image_count"], rows["gossipcop_1"]["has_images"]) == (7, 2, True)
    assert json.loads(rows["gossipcop_1"]["image_paths"]) == [
        {"path": "/p/a", "original_path": "/o/a", "size": [3, 4], "aspect_ratio": 0.75}, {"path": "/p/b", "original_path": "/o/b", "size": [1, 2], "aspect_ratio": 0.5}]
    assert (rows["politifact_1"]["image_count"], rows["politifact_1"]["has_images"], rows["politifact_1"]["image_paths"]) == (0, False, "[]")


@pytest.mark.parametrize("list_rows", [1, 4, 100])
def test_no_item_is_lost_by_the_size_of_its_list(spark, list_rows):
    rows = [("s", "fake", str(k), f"{i}.jpg") for k, n in ((1, 9), (2, 1), (3, 4)) for i in range(n)]
    inventory = spark.createDataFrame(rows, "source string, label string, article_id string, name string")
    contents = spark.createDataFrame([("s", "fake", str(k), f"c{k}") for k in (1, 2, 3)], "source string, label string, article_id string, content_file string")
    lists = article_manifest(inventory, contents, list_rows)
    assert Counter(map(tuple, manifest_images(lists).collect())) == Counter((*r, f"c{r[2]}") for r in rows)
    assert {(r.article_id, r.image_count) for r in lists.where("chunk = 0").collect()} == {("1", 9), ("2", 1), ("3", 4)}


def test_run_writes_links_of_long_lists(spark, tmp_path):
    paths = Paths(output=f"file://{tmp_path}", corpora={"statements": "unread"})
    pics = spark.createDataFrame([("gossipcop", "1", f"/p/{i}", f"/o/{i}", [i, 2], 0.5) for i in range(9)], "source string, article_id string, processed_path string, original_path string, original_size array<int>, aspect_ratio double")
    pics.write.parquet(paths.table("images", "articles"))
    spark.createDataFrame([("1", "true")], "id string, label string").write.parquet(paths.table("text", "statements"))
    run(spark, paths, Options(list_rows=2), stages=["metadata"])
    links = spark.read.parquet(paths.table("metadata", "article_image_links")).select("source", "article_id", F.inline("items")).collect()
    assert {(r.article_id, r.original_path, r["size"][0]) for r in links} == {("1", f"/o/{i}", i) for i in range(9)} and len(links) == 9


def test_last_by_key(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, None), ("b", 2, "y"), ("", 9, "z"), (None, 9, "z")], "id string, p int, t string")
    assert {tuple(r) for r in last_by_key(df, ["id"], "p", ["t"]).collect()} == {("a", None), ("b", "y")}


def test_statistics(spark):
    df = spark.createDataFrame([("a", "true", "s", True, True), ("a", None, "s", True, False), ("b", "true", None, False, None)], "dataset string, label string, source string, has_text boolean, has_images boolean")
    got = {(r["dataset"], r["statistic"], r["key"]): r["value"] for r in dataset_statistics(df).collect()}
    assert got == {
        ("a", "total_items", ""): 2, ("a", "items_with_text", ""): 2, ("a", "items_with_images", ""): 1, ("a", "items_with_both", ""): 1,
        ("b", "total_items", ""): 1, ("b", "items_with_text", ""): 0, ("b", "items_with_images", ""): 0, ("b", "items_with_both", ""): 0,
        ("combined", "total_items", ""): 3, ("combined", "items_with_text", ""): 2, ("combined", "items_with_images", ""): 1, ("combined", "items_with_both", ""): 1,
        ("a", "class_distribution", "true"): 1, ("b", "class_distribution", "true"): 1, ("combined", "class_distribution", "true"): 2,
        ("a", "sources", "s"): 2, ("combined", "sources", "s"): 2,
    }


def test_nothing_to_combine(spark):
    tables = build_metadata({}, spark=spark)
    assert union_corpora([]) is None
    assert tables.combined.count() == 0 and "label" in tables.combined.columns
    assert tables.statistics.count() == 0


def test_download_summary(spark):
    df = spark.createDataFrame([("a", "success"), ("b", "exists"), ("c", "failed"), ("d", None)], "image_id string, outcome string")
    assert tuple(download_summary(df).first()) == (4, 1, 1, 2)


@pytest.fixture(scope="module")
def finished(spark, tmp_path_factory):
    raw = tmp_path_factory.mktemp("raw")
    out = tmp_path_factory.mktemp("out")
    corpora = {"statements": statements(raw / "s"), "threads": threads(raw / "t"), "articles": articles(raw / "a")}
    listed, linked = images(raw / "i"), article_images(raw / "ai")
    paths = Paths(str(out), {k: str(v) for k, v in corpora.items()}, str(listed), str(linked), str(linked / "metadata" / "list.json"))
    options = Options(image=ImageOptions((8, 8)), split=SplitOptions(n_folds=2))
    run(spark, paths, options, ["text", "fetches", "images", "metadata"])
    return paths, options


def test_run_writes_metadata(spark, finished):
    paths, _ = finished
    combined = spark.read.parquet(paths.table("metadata", "combined"))
    assert {r["dataset"]: r["count"] for r in combined.groupBy("dataset").count().collect()} == {"statements": 5, "threads": 7, "articles": 4}
    linked = combined.where("id = 'gossipcop_g-1'").first()
    assert (linked["declared_image_count"], linked["image_count"], linked["has_images"]) == (3, 1, True)
    assert json.loads(linked["image_paths"])[0]["size"] == [4, 2]
    stats = spark.read.parquet(paths.table("metadata", "statistics"))
    total = stats.where("dataset = 'combined' and statistic = 'total_items'").first()
    assert total["value"] == 16
    assert spark.read.option("header", True).csv(paths.table("metadata", "corpora", "threads")).count() == 7


def test_run_writes_fetches_and_reports(spark, finished):
    paths, options = finished
    read = lambda *names: spark.read.parquet(paths.table(*names))
    assert {(r["image_id"], r["bucket"]) for r in read("fetches", "images").collect()} >= {("i4", "real"), ("i5", "unknown")}
    listed = spark.read.option("header", True).csv(paths.table("fetches", "image_list"))
    assert listed.columns == ["image_id", "image_url", "annotation", "event"] and listed.count() == 6
    fetches = {(r["article_id"], r["url"]) for r in read("fetches", "article_images").collect()}
    assert ("g-1", "http://x.org/1.png") in fetches and ("p-5", "http://x.org/in.png") in fetches
    (entry,) = spark.read.json(paths.table("fetches", "article_manifest")).collect()
    assert (entry["article_id"], entry["image_count"], entry["chunk"], entry["images"]) == ("g-1", 2, 0, ["a.png", "b.png"])
    assert entry["content_file"] == f"{paths.corpora['articles']}/gossipcop/fake/g-1/news content.json"
    counts = {n: read("reports", "items", n).first().asDict() for n in ("statements", "threads", "articles")}
    assert [counts[n]["items"] for n in counts] == [5, 7, 4]
    assert (counts["threads"]["rumors"], counts["threads"]["non_rumors"]) == (5, 2)
    assert {r["split"]: r["n"] for r in read("reports", "parts", "statements").collect()} == {"train": 2, "valid": 2, "test": 1}
    rejected = {(r["article_id"], r["reason"]) for r in read("reports", "rejected", "articles").collect()}
    assert rejected == {("p-2", "no text"), ("p-3", "unreadable content"), ("p-4", "no text")}
    assert read("reports", "rejected", "threads").count() > 0
    # Without a manifest of its own the article corpus takes the written one.
    other = Paths(paths.output, paths.corpora, article_images=paths.article_images)
    before = spark.read.parquet(paths.table("images", "articles")).count()
    run(spark, other, options, ["images"])
    assert spark.read.parquet(paths.table("images", "articles")).count() == before


def test_run_writes_integrated_tables(spark, finished):
    paths, _ = finished
    simple = spark.read.parquet(paths.table("integrated", "simplified"))
    assert simple.count() == 16
    article = simple.where("id = 'gossipcop_g-1'").first()
    assert article["text"]["processed_text"] == "Body [ NUMBER ] &"
    assert [i["original_filename"] for i in article["images"]] == ["a.png"]
    assert article["metadata"]["title"] == "T"
    assert simple.where("dataset = 'statements' and id = '1.json'").select("text.raw_text").distinct().count() == 1
    assert simple.where("size(images) = 0").count() == 15
    texts = spark.read.parquet(paths.table("integrated", "texts"))
    # The repeated statement id keeps the last file's text.
    assert texts.where("id = '1.json'").first()["raw_text"].startswith("He said")
    records, pixels = (spark.read.parquet(paths.table("images", *t)) for t in (("images",), ("pixels", "images")))
    assert sorted(r[0] for r in records.select("processed_path").collect()) == sorted(r[0] for r in pixels.select("processed_path").collect())


def test_run_writes_splits(spark, finished):
    paths, options = finished
    # Too few rows for three labels in each part: the failure is reported, not hidden.
    with pytest.raises(Exception, match="only one row|fewer rows"):
        run(spark, paths, options, ["splits"])
    combined = spark.read.parquet(paths.table("metadata", "combined"))
    many = combined.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(20)))).withColumn("id", F.concat("id", F.lit("#"), "copy")).drop("copy")
    many.write.mode("overwrite").partitionBy("dataset").parquet(paths.table("many", "metadata", "combined"))
    run(spark, Paths(paths.table("many"), {}), options, ["splits"])
    rows = spark.read.parquet(paths.table("many", "splits", "stratified"))
    assert rows.agg(F.sum("copies")).first()[0] == many.where("label in ('true', 'false', 'mixed')").count()
    aware = spark.read.parquet(paths.table("many", "splits", "source_aware"))
    assert {r[0] for r in aware.select("source").distinct().collect()} >= {"statements", "threads", "gossipcop"}
    assert spark.read.parquet(paths.table("many", "splits", "folds")).select("fold").distinct().count() == 2
    for report in (("stratified", "label"), ("source_aware", "source"), ("source_aware", "label"), ("folds",)):
        table = spark.read.parquet(paths.table("many", "reports", "splits", *report))
        assert table.agg(F.sum("n")).first()[0] == aware.agg(F.sum("copies")).first()[0] * (2 if report == ("folds",) else 1)


def test_simplify_matches_each_kind_of_image(spark):
    meta = spark.createDataFrame(
        [("articles", "g_1", "g", "true", "1"), ("articles", "g_2", "g", "true", "2"), ("images", "i1", "", "true", None), ("images", "i2", "", "true", None), ("threads", "t1", "", "true", None)],
        "dataset string, id string, source string, label string, article_id string",
    )
    texts = spark.createDataFrame([("threads", "t1", "raw", "done")], "dataset string, id string, raw_text string, processed_text string")
    fields = "original_size array<int>, aspect_ratio double, format string"
    single = spark.createDataFrame([("i1", "/p", "fake", "e", [1, 2], 0.5, "png")], f"image_id string, path string, annotation string, event string, {fields}")
    linked = spark.createDataFrame([("/q", "f", "g", "fake", "1", [3, 4], 0.75, "jpg")] * 2, f"processed_path string, original_filename string, source string, label string, article_id string, {fields}")
    for list_rows, images in ((10, ["/q", "/q"]), (1, ["/q"])):
        out = simplify(IntegratedTables(meta, texts, single, article_image_records(linked, list_rows)))
        rows = {r["id"]: r for r in out.collect()}
        assert len(rows) == 5
        assert [i["path"] for i in rows["g_1"]["images"]] == images
        assert {k: r["image_count"] for k, r in rows.items()} == {"g_1": 2, "g_2": 0, "i1": 1, "i2": 0, "t1": 0}
        assert rows["g_2"]["images"] == rows["i2"]["images"] == rows["t1"]["images"] == []
        assert [(i["path"], i["annotation"], i["event"]) for i in rows["i1"]["images"]] == [("/p", "fake", "e")]
        assert tuple(rows["t1"]["text"]) == ("raw", "done") and rows["g_1"]["text"] is None


def test_own_corpus(spark, tmp_path):
    def load(spark, path, options, lexicon):
        texts = spark.read.text(path).select(F.col("value").alias("raw_text"))
        return texts.select(F.md5("raw_text").alias("id"), F.lit("true").alias("label"), "raw_text", F.upper("raw_text").alias("processed_text"), F.col("raw_text").alias("position"))

    register_corpus("notes", Corpus(load))
    try:
        (tmp_path / "in.txt").write_text("one\ntwo\n")
        paths = Paths(str(tmp_path / "out"), {"notes": str(tmp_path / "in.txt")})
        run(spark, paths, stages=["text", "metadata"])
        simple = spark.read.parquet(paths.table("integrated", "simplified"))
        assert {r["text"]["processed_text"] for r in simple.collect()} == {"ONE", "TWO"}
    finally:
        del CORPORA["notes"]
    with pytest.raises(ValueError, match="unknown stages"):
        run(spark, paths, stages=["nonsense"])


def test_bucketed_texts_are_joined_where_they_are(spark, tmp_path):
    texts = spark.createDataFrame([("threads", f"t{i}", f"raw {i}", f"done {i}") for i in range(50)], "dataset string, id string, raw_text string, processed_text string")
    path = f"{tmp_path}/it's texts"
    write_buckets(texts, path, TEXT_KEYS, 4)
    back = read_buckets(spark, path, TEXT_KEYS, 4)
    assert {tuple(r) for r in back.collect()} == {tuple(r) for r in texts.collect()}
    assert len(list((tmp_path / "it's texts").glob("*.parquet"))) <= 4 and not spark.catalog.listTables()
    meta = spark.createDataFrame([("threads", f"t{i}", "", "true") for i in range(60)], "dataset string, id string, source string, label string")
    fields = "original_size array<int>, aspect_ratio double, format string"
    single = spark.createDataFrame([], f"image_id string, path string, annotation string, event string, {fields}")
    linked = spark.createDataFrame([], f"processed_path string, original_filename string, source string, label string, article_id string, {fields}")
    simple = simplify(IntegratedTables(meta, back, single, article_image_records(linked), 4))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = simple._jdf.queryExecution().executedPlan().toString()
        # One exchange by the keys, that of the narrow side; the scan of the texts is bucketed.
        assert len(re.findall(r"Exchange hashpartitioning\(dataset#\d+, id#\d+", text)) == 1 and "Bucketed: true" in text
        rows = {r["id"]: r["text"] and r["text"]["processed_text"] for r in simple.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert rows == {f"t{i}": f"done {i}" if i < 50 else None for i in range(60)}


def test_positions_of_different_types_in_one_table(spark):
    a = spark.createDataFrame([("1", "x", "X", (1, 2)), ("1", "y", "Y", (1, 3)), ("", "z", "Z", (9, 9))], "id string, raw_text string, processed_text string, position struct<f: int, r: int>")
    b = spark.createDataFrame([("1", "p", None, "b"), ("1", "q", "Q", "a")], "id string, raw_text string, processed_text string, position string")
    for buckets in (0, 3):
        got = {tuple(r) for r in corpus_texts({"a": a, "b": b}, buckets).collect()}
        assert got == {("a", "1", "y", "Y"), ("b", "1", "p", "")}


def test_ledger_of_stages(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "train.tsv").write_text("1.json\ttrue\tone" + "\t" * 11 + "\n")
    paths = Paths(str(tmp_path / "out"), {"statements": str(tmp_path / "in")})
    lexicon = spark.createDataFrame([("one", "1")], "form string, lemma string")
    go = lambda stages, options=None, words=None: run(spark, paths, options, stages, words, resume=True)
    assert go(["text", "metadata"]) == ["text", "metadata"] and go(["text", "metadata"]) == []
    assert go(["text"], Options(reaction_cut=3)) == ["text"]
    # Its output is new, so the stage after it has new inputs.
    assert go(["metadata"], Options(reaction_cut=3)) == ["metadata"]
    assert go(["text"], Options(reaction_cut=3), lexicon) == ["text"] and go(["text"], Options(reaction_cut=3), lexicon) == []
    (tmp_path / "in" / "test.tsv").write_text("2.json\ttrue\ttwo" + "\t" * 11 + "\n")
    assert go(["text"], Options(reaction_cut=3), lexicon) == ["text"]
    entries = read_ledger(spark, paths.table("ledger")).where("stage = 'text'").orderBy("finished").collect()
    assert [r["files"] for r in entries] == [1, 1, 1, 2] and len({r["fingerprint"] for r in entries}) == 4

    def broken(spark, path, options, lexicon):
        raise RuntimeError("lost")

    register_corpus("broken", Corpus(broken))
    try:
        other = Paths(str(tmp_path / "other"), {"broken": str(tmp_path / "in")})
        for _ in range(2):  # what failed isn't in the ledger, so it is tried again
            with pytest.raises(RuntimeError, match="lost"):
                run(spark, other, stages=["text"], resume=True)
        assert read_ledger(spark, other.table("ledger")).count() == 0
    finally:
        del CORPORA["broken"]


def test_corpora_with_clashing_types(spark):
    a = spark.createDataFrame([(1, 2, 1.5, "x", True, date(2020, 1, 2), [1], None)], "id int, n smallint, s float, t string, f boolean, d date, l array<int>, v void")
    b = spark.createDataFrame([(2**40, 7, 3, 5, "no", datetime(2020, 1, 2, 3), "plain", Decimal("1.25"))], "ID bigint, n int, s bigint, t int, f string, d timestamp, l string, v decimal(5,2)")
    c = spark.createDataFrame([(Decimal("2.5"), 9, {"k": 1})], "v decimal(9,4), id smallint, extra map<string,int>")
    out = union_corpora([a, b, c])
    assert out.schema.simpleString() == (
        "struct<id:bigint,n:int,s:double,t:string,f:string,d:timestamp,l:string,v:decimal(38,4),extra:map<string,int>>"
    )
    rows = {r["id"]: r for r in out.collect()}
    assert tuple(rows[1])[1:5] == (2, 1.5, "x", "true") and (rows[1]["l"], rows[1]["v"], rows[1]["extra"]) == ("[1]", None, None)
    assert tuple(rows[2**40])[1:5] == (7, 3.0, "5", "no") and (rows[2**40]["l"], rows[2**40]["v"]) == ("plain", Decimal("1.25"))
    assert (rows[9]["v"], rows[9]["extra"], rows[9]["t"]) == (Decimal("2.5"), {"k": 1}, None)
    assert [type(common_type(t)).__name__ for t in ([LongType(), FloatType()], [IntegerType(), DecimalType(5, 1)], [NullType()], [DoubleType(), StringType()])] == [
        "DoubleType", "DecimalType", "NullType", "StringType"]

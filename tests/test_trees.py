"""Compaction of file trees."""

import os
import time

from pyspark.sql import functions as F
from trees import articles, threads, write

from veracity_prep.options import Options
from veracity_prep.plans.articles import build_articles, load_articles
from veracity_prep.plans.threads import build_threads, load_threads
from veracity_prep.sources.articles import compact_articles
from veracity_prep.sources.threads import compact_threads
from veracity_prep.sources.trees import compact_tree, compacted_files, tree_files

ROLES = {"a": r"/a/[^/]+\.json$", "b": r"/b/[^/]+\.json$"}


def files_opened(df):
    """Files the scans of a plan got, once it has run."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    if "AdaptiveSparkPlan" in plan.nodeName():
        plan = plan.executedPlan()
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numFiles").value() for i in range(leaves.size()))


def test_a_role_opens_its_own_files(spark, tmp_path):
    for i in range(7):
        write(tmp_path / "a" / f"{i}.json", f"a{i}")
        write(tmp_path / "b" / f"x y+{i}%.json", f"b{i}")
        write(tmp_path / "c" / f"{i}.json", "c")
    files = tree_files(spark, str(tmp_path), ROLES, "*.json")
    assert files_opened(files.where("role = 'a'")) == 7
    assert files_opened(files.where("role = 'b'").select("value")) == 7
    assert {(r.role, r.value) for r in files.collect()} == {(k, f"{k}{i}") for k in "ab" for i in range(7)}
    assert {os.path.basename(r.path) for r in files.where("role = 'b'").select("path").collect()} == {f"x y+{i}%.json" for i in range(7)}
    assert tree_files(spark, str(tmp_path / "none"), ROLES).count() == 0


def test_the_tree_is_listed_once(spark, tmp_path):
    write(tmp_path / "a" / "1.json", "one")
    files = tree_files(spark, str(tmp_path), ROLES)
    write(tmp_path / "a" / "2.json", "late")
    # All that is derived later still sees the first listing.
    assert files.where("role = 'a'").count() == files.select("path").count() == 1


def current(spark, table):
    return {(r.role, os.path.basename(r.path), r.value) for r in compacted_files(spark, table).collect()}


def touch(path, when):
    os.utime(path, (when, when))


def test_compaction_follows_the_tree(spark, tmp_path):
    tree, table, now = tmp_path / "tree", str(tmp_path / "table"), time.time() - 1000
    for i in range(5):
        write(tree / "a" / f"{i}.json", f"a{i}")
        write(tree / "b" / f"{i}.json", f"b{i}")
        touch(tree / "a" / f"{i}.json", now)
        touch(tree / "b" / f"{i}.json", now)
    compact = lambda: tuple(compact_tree(spark, str(tree), table, ROLES, names_only=["b"]))
    assert compact() == (10, 0) and compact() == (0, 0)
    first = {("a", f"{i}.json", f"a{i}") for i in range(5)} | {("b", f"{i}.json", None) for i in range(5)}
    assert current(spark, table) == first
    # A new file, an old one that came late, a changed one and a removed one.
    write(tree / "a" / "new.json", "new")
    write(tree / "a" / "old.json", "old")
    touch(tree / "a" / "old.json", now - 5000)
    write(tree / "a" / "1.json", "changed")
    (tree / "a" / "2.json").unlink()
    assert compact() == (3, 2) and compact() == (0, 0)
    want = first - {("a", "1.json", "a1"), ("a", "2.json", "a2")} | {("a", "new.json", "new"), ("a", "old.json", "old"), ("a", "1.json", "changed")}
    assert current(spark, table) == want
    # A removed file that comes back just as it was.
    write(tree / "a" / "2.json", "a2")
    touch(tree / "a" / "2.json", now)
    assert compact() == (1, 0)
    assert current(spark, table) == want | {("a", "2.json", "a2")}
    assert files_opened(spark.read.parquet(f"{table}/files").where("role = 'a'")) < len(list((tmp_path / "table" / "files").rglob("*.parquet")))


def test_missing_tree_and_pruned_names(spark, tmp_path):
    assert tuple(compact_tree(spark, str(tmp_path / "none"), str(tmp_path / "t"), ROLES)) == (0, 0)
    assert compacted_files(spark, str(tmp_path / "t")).count() == 0


def test_corpora_from_compacted_trees(spark, tmp_path):
    raw = {"threads": threads(tmp_path / "t"), "articles": articles(tmp_path / "a")}
    for name, load, compact, build in (("threads", load_threads, compact_threads, build_threads), ("articles", load_articles, compact_articles, build_articles)):
        direct = load(spark, str(raw[name]))
        built = build(compact(spark, str(raw[name]), str(tmp_path / "tables" / name)), Options(), None)
        rows = lambda df: sorted(str(r) for r in df.select(F.to_json(F.struct("*"))).collect())
        assert rows(direct) == rows(built) and direct.count() > 0
    tweets = spark.read.parquet(str(tmp_path / "tables" / "articles" / "files")).where("role = 'tweet'")
    assert tweets.count() > 0 and tweets.where("value is not null").count() == 0

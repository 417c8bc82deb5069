"""Split properties, exact ranks and skewed groups."""

import math
from collections import Counter, defaultdict
from hashlib import md5

import pytest
from pyspark.sql import functions as F

from veracity_prep.operators.ranks import hashed_ranks
from veracity_prep.operators.splits import (
    cross_validation_folds,
    fold_members,
    make_splits,
    source_aware_split,
    split_rows,
    stratified_quotas,
    stratified_split,
)
from veracity_prep.options import SplitOptions


@pytest.fixture(scope="module")
def items(spark):
    label = F.when(F.col("i") % 10 < 6, "true").when(F.col("i") % 10 < 8, "false").when(F.col("i") % 10 < 9, "mixed").otherwise("unknown")
    # One source holds a third of the rows; some rows have none.
    source = F.when(F.col("i") % 3 == 0, "big").when(F.col("i") % 7 == 0, "").otherwise(F.concat(F.lit("s"), F.col("i") % 40))
    return spark.range(1000).withColumnRenamed("id", "i").select(F.concat(F.lit("d"), "i").alias("id"), source.alias("source"), label.alias("label"), F.lit("docs").alias("dataset"))


def by_hash(ids, seed=-7):
    return sorted(ids, key=lambda i: (md5(f"{seed}|{i}".encode()).hexdigest(), i))


@pytest.mark.parametrize("rank_rows", [1, 7, 100, 10_000])
def test_ranks_equal_sorting(spark, items, rank_rows):
    rows = hashed_ranks(items, ["source"], "id", -7, rank_rows).collect()
    groups = defaultdict(list)
    for r in items.collect():
        groups[r["source"]].append(r["id"])
    want = {(s, i): n for s, ids in groups.items() for n, i in enumerate(by_hash(ids), 1)}
    assert {(r["source"], r["id"]): r["first_rank"] for r in rows} == want
    assert all(r["group_rows"] == len(groups[r["source"]]) and r["copies"] == 1 for r in rows)


def test_ranks_with_copies_and_null_ids(spark):
    df = spark.createDataFrame([("a", "g")] * 50 + [("b", "g")] * 3 + [("c", "g")] + [("a", "h")] * 2, "id string, g string")
    for rank_rows in (2, 1000):
        rows = hashed_ranks(df, ["g"], "id", 1, rank_rows).where("g = 'g'").collect()
        order = by_hash(["a", "b", "c"], 1)
        copies = {"a": 50, "b": 3, "c": 1}
        start = 1
        for i in order:
            row = next(r for r in rows if r["id"] == i)
            assert (row["copies"], row["first_rank"], row["group_rows"]) == (copies[i], start, 54)
            start += copies[i]


def largest_remainder(counts, draws):
    total = sum(counts.values())
    exact = {k: n / total * draws for k, n in counts.items()}
    out = {k: math.floor(x) for k, x in exact.items()}
    for k in sorted(exact, key=lambda k: (-(exact[k] - out[k]), k))[: draws - sum(out.values())]:
        out[k] += 1
    return out


def test_stratified_quotas(items):
    counts = Counter(r["label"] for r in items.collect() if r["label"] != "unknown")
    n = sum(counts.values())
    n_test = math.ceil(n * 0.15)
    n_val = math.ceil((n - n_test) * (0.15 / 0.85))
    rest = largest_remainder(counts, n - n_test)
    train = largest_remainder(rest, n - n_test - n_val)
    rows = Counter((r["label"], r["split"]) for r in stratified_split(items).collect())
    assert rows == {(k, s): v for k in counts for s, v in (("train", train[k]), ("validation", rest[k] - train[k]), ("test", counts[k] - rest[k]))}


def test_rounding_follows_doubles(spark):
    # 85 rows left after the test part: 85 * (0.15 / 0.85) is above 15 in floating point.
    df = spark.range(100).select(F.col("id").cast("string"), F.lit("true").alias("label"), F.lit("s").alias("source"), F.lit("d").alias("dataset"))
    sizes = Counter(r["split"] for r in source_aware_split(df).collect())
    assert sizes == {"test": 15, "validation": math.ceil(85 * (0.15 / 0.85)), "train": 69}


@pytest.mark.parametrize("scheme", ["stratified", "source_aware"])
def test_parts_are_disjoint_and_whole(items, scheme):
    rows = make_splits(items)[scheme].collect()
    ids = [r["id"] for r in rows]
    assert len(ids) == len(set(ids))
    assert set(ids) == {r["id"] for r in items.where("label <> 'unknown'").collect()}


def test_splits_do_not_depend_on_partitioning(items):
    for fn in (stratified_split, source_aware_split, cross_validation_folds):
        assert set(fn(items).collect()) == set(fn(items.repartition(13, "label").orderBy("id")).collect())


def test_seed_changes_members(items):
    a = set(stratified_split(items).collect())
    assert a != set(stratified_split(items, SplitOptions(seed=3)).collect())


def test_small_groups_and_sources(spark):
    rows = [("1", "a", "true"), ("2", "a", "true"), ("3", "b", "true"), ("4", "b", "true"), ("5", "b", "true"), ("6", None, "true"), ("7", "", "true"), ("8", "docs", "true")]
    df = spark.createDataFrame([(*r, "docs") for r in rows], "id string, source string, label string, dataset string")
    out = {r["id"]: (r["source"], r["split"]) for r in source_aware_split(df).collect()}
    assert out["1"] == out["2"] == ("a", "train")
    assert sorted(out[i][1] for i in "345") == ["test", "train", "validation"]
    assert sorted(out[i][1] for i in "678") == ["test", "train", "validation"] and out["6"][0] == "docs"
    literal = source_aware_split(df, SplitOptions(drop_null_source=True)).collect()
    assert {r["id"] for r in literal} == {"1", "2", "3", "4", "5", "8"}


def test_folds(items):
    folds = cross_validation_folds(items)
    rows = folds.collect()
    by_label = defaultdict(Counter)
    for r in rows:
        by_label[r["label"]][r["fold"]] += r["copies"]
    for counts in [*by_label.values(), Counter(r["fold"] for r in rows)]:
        assert len(counts) == 5 and max(counts.values()) - min(counts.values()) <= 1
    members = fold_members(folds).collect()
    assert len(members) == 5 * len(rows)
    assert sum(m["split"] == "validation" for m in members) == len(rows)


def test_copies_over_many_parts(spark):
    df = spark.createDataFrame([("x", "true")] * 90 + [("y", "true")] * 10, "id string, label string")
    folds = cross_validation_folds(df).groupBy("fold").agg(F.sum("copies")).collect()
    assert {r[0]: r[1] for r in folds} == dict.fromkeys(range(5), 20)
    sizes = stratified_split(df).groupBy("split").agg(F.sum("copies")).collect()
    assert {r[0]: r[1] for r in sizes} == {"train": 69, "validation": 16, "test": 15}


def test_errors(spark):
    few = spark.createDataFrame([(str(i), "true") for i in range(20)] + [("z", "false")], "id string, label string")
    with pytest.raises(Exception, match="only one row"):
        stratified_split(few).collect()
    tiny = spark.createDataFrame([("1", "true"), ("2", "true"), ("3", "false"), ("4", "false")], "id string, label string")
    with pytest.raises(Exception, match="fewer rows than there are labels"):
        stratified_quotas(tiny, SplitOptions()).collect()
    with pytest.raises(Exception, match="more folds than rows"):
        cross_validation_folds(tiny).collect()


def test_rows_of_a_part(items):
    split = stratified_split(items)
    got = split_rows(items, split, "test")
    assert got.columns == ["id", "source", "label", "dataset"]
    assert got.count() == split.where("split = 'test'").count()

"""Splits and folds over labelled documents and over the combined metadata."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.tables import SPLIT_ITEMS, Inputs, query
from veracity_prep.functions.labels import splittable
from veracity_prep.operators.splits import (
    approximate_split,
    cross_validation_folds,
    fold_members,
    fold_report,
    make_splits,
    source_aware_split,
    split_report,
    split_rows,
    stratified_quotas,
    stratified_split,
)
from veracity_prep.options import SplitOptions

#: A rank limit small enough that groups are cut into slices at test size.
SLICED = SplitOptions(rank_rows=25)

ROWS = f"SELECT id, source, label FROM ({SPLIT_ITEMS}) WHERE label IN ('true', 'false', 'mixed')"
ORDER = "ORDER BY md5(concat('-7|', id)), id"
SHARE = "CAST(0.15 AS DOUBLE) / (CAST(1 AS DOUBLE) - CAST(0.15 AS DOUBLE))"


def _quota(name: str, table: str, size: str, draws: str) -> str:
    """One round of the largest-remainder method as two CTEs."""
    return f"""{name}_x AS (SELECT *, {size} / CAST(sum({size}) OVER () AS DOUBLE) * {draws} AS x FROM {table}),
    {name} AS (SELECT * EXCLUDE (x), CAST(floor(x) + CASE WHEN row_number() OVER (ORDER BY x - floor(x) DESC, label)
        <= {draws} - sum(floor(x)) OVER () THEN 1 ELSE 0 END AS BIGINT) AS {name}_q FROM {name}_x)"""


QUOTAS = f"""r AS ({ROWS}),
    c AS (SELECT label, count(*) AS n FROM r GROUP BY label),
    a AS (SELECT *, CAST(sum(n) OVER () AS BIGINT) AS total FROM c),
    b AS (SELECT *, CAST(ceil(total * CAST(0.15 AS DOUBLE)) AS BIGINT) AS n_test FROM a),
    d AS (SELECT *, CAST(ceil((total - n_test) * ({SHARE})) AS BIGINT) AS n_val FROM b),
    {_quota('rest', 'd', 'n', '(total - n_test)')}, {_quota('train', 'rest', 'rest_q', '(total - n_test - n_val)')},
    q AS (SELECT label, n, train_q AS train, rest_q - train_q AS validation, n - rest_q AS test FROM train)"""
RANKED = f"k AS (SELECT *, row_number() OVER (PARTITION BY label {ORDER}) AS rank FROM r)"
STRATIFIED = f"""WITH {QUOTAS}, {RANKED}
    SELECT k.id, k.label, CASE WHEN rank <= train THEN 'train' WHEN rank <= train + validation THEN 'validation' ELSE 'test' END AS split,
        CAST(1 AS BIGINT) AS copies FROM k JOIN q ON q.label = k.label"""
SOURCE_AWARE = f"""
    SELECT id, source, label, CASE WHEN n < 3 THEN 'train' WHEN rank <= n_test THEN 'test'
        WHEN rank <= n_test + ceil((n - n_test) * ({SHARE})) THEN 'validation' ELSE 'train' END AS split, CAST(1 AS BIGINT) AS copies
    FROM (SELECT *, ceil(n * CAST(0.15 AS DOUBLE)) AS n_test FROM (
        SELECT *, count(*) OVER (PARTITION BY source, label) AS n, row_number() OVER (PARTITION BY source, label {ORDER}) AS rank FROM ({ROWS})))"""
FOLDS = f"""WITH r AS ({ROWS}), o AS (SELECT label, coalesce(sum(n) OVER (ORDER BY label ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
        FROM (SELECT label, count(*) AS n FROM r GROUP BY label)), {RANKED}
    SELECT k.id, k.label, CAST((before + rank - 1) % 5 AS INTEGER) AS fold, CAST(1 AS BIGINT) AS copies FROM k JOIN o ON o.label = k.label"""


def items(t: Inputs):
    return t.adapt(SPLIT_ITEMS)


@query(ROWS)
def splittable_items(t):
    return items(t).where(splittable(F.col("label"))).select("id", "source", "label")


@query(f"WITH {QUOTAS} SELECT * FROM q")
def stratified_split_quotas(t):
    return stratified_quotas(items(t).where(splittable(F.col("label"))), SplitOptions())


@query(STRATIFIED)
def stratified_split_by_label(t):
    return stratified_split(items(t)).drop("dataset")


@query(STRATIFIED)
def stratified_split_in_slices(t):
    return stratified_split(items(t), SLICED).drop("dataset")


@query(SOURCE_AWARE)
def source_aware_split_by_group(t):
    return source_aware_split(items(t)).drop("dataset")


@query(SOURCE_AWARE)
def source_aware_split_in_slices(t):
    return source_aware_split(items(t), SplitOptions(rank_rows=4)).drop("dataset")


@query(
    f"""SELECT id, source, label, split, copies FROM ({SOURCE_AWARE.replace(f'({ROWS})', f"({ROWS.replace('SELECT id, source', "SELECT id, CASE WHEN source = 'src1' THEN 'documents' ELSE source END AS source")})")})"""
)
def source_aware_split_without_source(t):
    """Rows without a publisher are grouped by their corpus."""
    blank = F.when(F.col("source") != "src1", F.col("source"))
    return source_aware_split(items(t).withColumn("source", blank)).drop("dataset")


@query(FOLDS)
def cross_validation_by_label(t):
    return cross_validation_folds(items(t)).drop("dataset")


@query(FOLDS)
def cross_validation_in_slices(t):
    return cross_validation_folds(items(t), SLICED).drop("dataset")


@query(
    f"""SELECT CAST(g AS INTEGER) AS fold, CASE WHEN fold = g THEN 'validation' ELSE 'train' END AS split, id, label, copies
    FROM ({FOLDS}) f, range(5) x(g)"""
)
def cross_validation_members(t):
    return fold_members(cross_validation_folds(items(t))).drop("dataset")


@query(
    f"""SELECT CAST(g AS INTEGER) AS fold, CASE WHEN fold = g THEN 'validation' ELSE 'train' END AS split, label, count(*) AS n,
        round(count(*) / sum(count(*)) OVER (PARTITION BY g, fold = g), 9) AS share
    FROM ({FOLDS}) f, range(5) x(g) GROUP BY g, fold = g, label"""
)
def cross_validation_report(t):
    return fold_report(cross_validation_folds(items(t))).withColumn("share", F.round("share", 9))


REPORT_BY_LABEL = f"SELECT split, label, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY split), 9) AS share FROM ({STRATIFIED}) GROUP BY split, label"


@query(REPORT_BY_LABEL)
def split_report_by_label(t):
    return split_report(stratified_split(items(t))).withColumn("share", F.round("share", 9))


@query(
    f"SELECT split, source, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY split), 9) AS share FROM ({SOURCE_AWARE}) GROUP BY split, source"
)
def split_report_by_source(t):
    return split_report(source_aware_split(items(t)), "source").withColumn("share", F.round("share", 9))


@query(f"SELECT id, source, label FROM ({SOURCE_AWARE}) WHERE split = 'test'")
def rows_of_test_split(t):
    return split_rows(items(t), source_aware_split(items(t)), "test").select("id", "source", "label")


@query(
    f"""SELECT id, label, CASE WHEN p < floor(0.15 * 4294967296) THEN 'test' WHEN p < floor(0.15 * 4294967296) * 2 THEN 'validation' ELSE 'train' END AS split
    FROM (SELECT *, CAST(concat('0x', substring(md5(concat('-7|', id)), 1, 8)) AS BIGINT) AS p FROM ({ROWS}))"""
)
def approximate_split_by_hash(t):
    return approximate_split(items(t)).drop("dataset")


# Copies: every third id five times, and one id as often as all others together.
COPIED = f"""SELECT id, source, label, dataset FROM ({SPLIT_ITEMS}) s JOIN (SELECT 0 AS r, 0 AS k UNION ALL SELECT 0 AS r, 1 AS k
        UNION ALL SELECT 0 AS r, 2 AS k UNION ALL SELECT 0 AS r, 3 AS k UNION ALL SELECT 0 AS r, 4 AS k
        UNION ALL SELECT 1 AS r, 0 AS k UNION ALL SELECT 2 AS r, 0 AS k) c ON c.r = CAST(s.id AS BIGINT) % 3
    UNION ALL SELECT '0' AS id, 'src0' AS source, 'true' AS label, 'documents' AS dataset FROM {{documents}}"""


def _by_row(sql: str, group: str) -> str:
    """The row-wise form of a split, with the rows of an id counted afterwards."""
    source = sql.replace(ROWS, f"SELECT id, source, label FROM ({COPIED}) WHERE label IN ('true', 'false', 'mixed')")
    return f"SELECT {group}, count(*) AS copies FROM ({source}) GROUP BY ALL"


@query(_by_row(STRATIFIED, "id, label, split"))
def stratified_split_of_copies(t):
    return stratified_split(t.adapt(COPIED), SLICED).drop("dataset")


@query(_by_row(SOURCE_AWARE, "id, source, label, split"))
def source_aware_split_of_copies(t):
    return source_aware_split(t.adapt(COPIED), SplitOptions(rank_rows=4)).drop("dataset")


@query(_by_row(FOLDS, "id, label, fold"))
def cross_validation_of_copies(t):
    return cross_validation_folds(t.adapt(COPIED), SLICED).drop("dataset")


@query(
    f"""SELECT 'stratified' AS scheme, split AS part, count(*) AS n FROM ({STRATIFIED}) GROUP BY split
    UNION ALL SELECT 'source_aware', split, count(*) FROM ({SOURCE_AWARE}) GROUP BY split
    UNION ALL SELECT 'folds', CAST(fold AS VARCHAR), count(*) FROM ({FOLDS}) GROUP BY fold"""
)
def all_split_sizes(t):
    out = None
    for scheme, rows in make_splits(items(t)).items():
        part = F.col("fold" if scheme == "folds" else "split").cast("string").alias("part")
        sizes = rows.groupBy(part).agg(F.sum("copies").alias("n")).select(F.lit(scheme).alias("scheme"), "part", "n")
        out = sizes if out is None else out.unionByName(sizes)
    return out


# The labelled items as two corpora that share their ids.
SHARED = """
    SELECT id, source, label, dataset FROM ({items}) UNION ALL SELECT id, source, label, 'copies' AS dataset FROM ({items}) WHERE label <> 'true'
"""


@query(f"SELECT dataset, label, count(*) AS n, count(*) AS parts FROM ({SHARED.replace('{items}', SPLIT_ITEMS)}) WHERE label <> 'unknown' GROUP BY ALL")
def splits_of_shared_ids(t):
    """Every part row joins back to exactly one item, and every item is in one part."""
    rows = t.adapt(SHARED.replace("{items}", SPLIT_ITEMS))
    parts = [split_rows(rows, stratified_split(rows), name) for name in ("train", "validation", "test")]
    joined = stratified_split(rows).join(rows, ["dataset", "id", "label"]).groupBy("dataset", "label").agg(F.count(F.lit(1)).alias("n"))
    found = parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("dataset", "label").agg(F.count(F.lit(1)).alias("parts"))
    return joined.join(found, ["dataset", "label"])

"""Train/validation/test splits and cross-validation folds.

All of them order rows by ``md5(seed|id)``, so membership depends only on the ids and the seed. Copies of an id are
rows of their own, as in a row-wise split: the result has one row per (id, part) with ``copies``, the number of rows
of that id in that part. ``copies`` is 1 throughout when ids are unique. Where the metadata has a ``dataset``, a row is
identified by ``dataset`` and ``id``, and results have both.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veracity_prep.functions.labels import splittable
from veracity_prep.operators.ranks import hashed_ranks
from veracity_prep.options import SplitOptions

#: Split names.
TRAIN, VALIDATION, TEST = "train", "validation", "test"


def _corpus(metadata: DataFrame) -> list[str]:
    """The column that tells equal ids of two corpora apart, if there is one."""
    return ["dataset"] if "dataset" in metadata.columns else []


def _share_of_rest(options: SplitOptions) -> float:
    return options.val_size / (1 - options.test_size)


def _emit(ranked: DataFrame, bounds: list[tuple[str, Column, Column]], keep: list[str]) -> DataFrame:
    """Rows by part, where a part takes the ranks ``low + 1 .. high``."""
    first, last = F.col("first_rank"), F.col("first_rank") + F.col("copies") - 1
    parts = F.array(
        *[
            F.struct(
                F.lit(name).alias("split"),
                (F.least(last, high) - F.greatest(first, low + 1) + 1).alias("copies"),
            )
            for name, low, high in bounds
        ]
    )
    hit = F.explode(F.filter(parts, lambda p: p["copies"] > 0)).alias("_part")
    return ranked.select(*keep, hit).select(*keep, "_part.split", "_part.copies")


def _label_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("label").agg(F.count(F.lit(1)).alias("n"))


def _largest_remainder(counts: DataFrame, size: str, draws: Column, quota: str) -> DataFrame:
    """Share ``draws`` among the labels in proportion to ``size``, left-over units to the largest fractions.

    Equal fractions go to the smaller label. The table has one row per splittable label, three at most.
    """
    every = Window.partitionBy(F.lit(1))
    exact = F.col(size) / F.sum(size).over(every) * draws
    shared = counts.withColumn("_exact", exact).withColumn("_floor", F.floor("_exact"))
    by_fraction = every.orderBy(F.desc(F.col("_exact") - F.col("_floor")), "label")
    missing = draws - F.sum("_floor").over(every)
    extra = (F.row_number().over(by_fraction) <= missing).cast("bigint")
    return shared.withColumn(quota, F.col("_floor") + extra).drop("_exact", "_floor")


def stratified_quotas(rows: DataFrame, options: SplitOptions) -> DataFrame:
    """Rows of each label in each part: ``label, n, train, validation, test``.

    Fails at run time when a label has a single row or a part is smaller than the number of labels.
    """
    every = Window.partitionBy(F.lit(1))
    counts = (
        _label_counts(rows)
        .withColumn("_all", F.sum("n").over(every))
        .withColumn("_labels", F.count(F.lit(1)).over(every))
        .withColumn("_test", F.ceil(F.col("_all") * F.lit(options.test_size)))
        .withColumn("_val", F.ceil((F.col("_all") - F.col("_test")) * F.lit(_share_of_rest(options))))
    )
    problem = F.when(
        F.min("n").over(every) < 2, F.raise_error(F.lit("the least populated label has only one row"))
    ).when(
        F.least("_test", "_val", F.col("_all") - F.col("_test") - F.col("_val")) < F.col("_labels"),
        F.raise_error(F.lit("a part would have fewer rows than there are labels")),
    )
    counts = counts.withColumn("n", F.coalesce(problem.cast("bigint"), F.col("n")))
    rest = _largest_remainder(counts, "n", F.col("_all") - F.col("_test"), "_rest")
    quotas = _largest_remainder(rest, "_rest", F.col("_all") - F.col("_test") - F.col("_val"), "train")
    return quotas.select(
        "label",
        "n",
        "train",
        (F.col("_rest") - F.col("train")).alias("validation"),
        (F.col("n") - F.col("_rest")).alias("test"),
    )


def stratified_split(metadata: DataFrame, options: SplitOptions | None = None) -> DataFrame:
    """Split by label with exact quotas: ``[dataset,] id, label, split, copies``."""
    options, corpus = options or SplitOptions(), _corpus(metadata)
    rows = metadata.select(*corpus, "id", "label").where(splittable(F.col("label")))
    ranked = hashed_ranks(rows, ["label"], "id", options.seed, options.rank_rows, few_groups=True, also=corpus)
    quotas = F.broadcast(stratified_quotas(rows, options))  # one row per splittable label
    ranked = ranked.join(quotas, "label")
    zero, train, rest = F.lit(0), F.col("train"), F.col("train") + F.col("validation")
    bounds = [(TRAIN, zero, train), (VALIDATION, train, rest), (TEST, rest, F.col("n"))]
    return _emit(ranked, bounds, [*corpus, "id", "label"])


def split_source(options: SplitOptions) -> Column:
    """Source for grouping: the publisher, else the corpus the row comes from."""
    own = F.nullif(F.col("source"), F.lit(""))
    return own if options.drop_null_source else F.coalesce(own, F.col("dataset"))


def source_aware_split(metadata: DataFrame, options: SplitOptions | None = None) -> DataFrame:
    """Split every (source, label) group by itself: ``[dataset,] id, source, label, split, copies``.

    Groups of one or two rows go to train. With ``drop_null_source`` rows without a source are left out;
    otherwise ``metadata`` needs a ``dataset`` column to stand in for it.
    """
    options, corpus = options or SplitOptions(), _corpus(metadata)
    rows = metadata.select(*corpus, "id", split_source(options).alias("source"), "label")
    rows = rows.where(splittable(F.col("label")) & F.col("source").isNotNull())
    ranked = hashed_ranks(rows, ["source", "label"], "id", options.seed, options.rank_rows, also=corpus)
    n, small = F.col("group_rows"), F.col("group_rows") < 3
    test = F.when(small, F.lit(0)).otherwise(F.ceil(n * F.lit(options.test_size)))
    ranked = ranked.withColumn("_test", test)
    val = F.when(small, F.lit(0)).otherwise(F.ceil((n - F.col("_test")) * F.lit(_share_of_rest(options))))
    ranked = ranked.withColumn("_held", F.col("_test") + val)
    bounds = [
        (TEST, F.lit(0), F.col("_test")),
        (VALIDATION, F.col("_test"), F.col("_held")),
        (TRAIN, F.col("_held"), n),
    ]
    return _emit(ranked, bounds, [*corpus, "id", "source", "label"])


def cross_validation_folds(metadata: DataFrame, options: SplitOptions | None = None) -> DataFrame:
    """Stratified folds: ``[dataset,] id, label, fold, copies``. Fold *k* validates on its rows and trains on all others.

    The rows of a label are dealt out one by one over the folds; each label starts where the one before it ended, in
    label order, so that the folds also agree in size.
    """
    options, corpus = options or SplitOptions(), _corpus(metadata)
    k = options.n_folds
    rows = metadata.select(*corpus, "id", "label").where(splittable(F.col("label")))
    ranked = hashed_ranks(rows, ["label"], "id", options.seed, options.rank_rows, few_groups=True, also=corpus)
    every = Window.partitionBy(F.lit(1))
    before = every.orderBy("label").rowsBetween(Window.unboundedPreceding, -1)
    too_many = F.when(F.max("n").over(every) < k, F.raise_error(F.lit("more folds than rows of any label")))
    offset = F.coalesce(too_many.cast("bigint"), F.sum("n").over(before), F.lit(0).cast("bigint"))
    offsets = _label_counts(rows).select("label", offset.alias("_offset"))
    ranked = ranked.join(F.broadcast(offsets), "label")  # one row per splittable label
    start = F.col("_offset") + F.col("first_rank") - 1
    end = start + F.col("copies") - 1
    # Positions start..end that are congruent to f modulo k.
    folds = F.array(
        *[
            F.struct(
                F.lit(f).alias("fold"),
                (F.floor((end - f) / k) - F.floor((start - 1 - f) / k)).alias("copies"),
            )
            for f in range(k)
        ]
    )
    hit = F.explode(F.filter(folds, lambda p: p["copies"] > 0)).alias("_part")
    keep = [*corpus, "id", "label"]
    return ranked.select(*keep, hit).select(*keep, "_part.fold", "_part.copies")


def fold_members(folds: DataFrame, options: SplitOptions | None = None) -> DataFrame:
    """Both sides of every fold: ``fold, split, id, label, copies`` with split ``train`` or ``validation``."""
    options = options or SplitOptions()
    k = options.n_folds
    sides = folds.withColumnRenamed("fold", "_own").withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
    split = F.when(F.col("fold") == F.col("_own"), VALIDATION).otherwise(TRAIN)
    return sides.groupBy("fold", split.alias("split"), *_corpus(folds), "id", "label").agg(F.sum("copies").alias("copies"))


def approximate_split(metadata: DataFrame, options: SplitOptions | None = None) -> DataFrame:
    """The same proportions by a threshold on a hash of the id, without counts and without a shuffle.

    Part sizes are right in expectation only; all copies of an id land in the same part.
    """
    options = options or SplitOptions()
    rows = metadata.select(*_corpus(metadata), "id", "label").where(splittable(F.col("label")))
    digest = F.md5(F.concat_ws("|", F.lit(str(options.seed)), F.col("id").cast("string")))
    point = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    test = int(options.test_size * 2**32)
    val = int(options.val_size * 2**32)
    split = F.when(point < test, TEST).when(point < test + val, VALIDATION).otherwise(TRAIN)
    return rows.withColumn("split", split)


def split_rows(metadata: DataFrame, split: DataFrame, name: str) -> DataFrame:
    """The metadata rows that belong to a part, by id and, where both have it, dataset."""
    keys = ["id", *(c for c in _corpus(metadata) if c in split.columns)]
    return metadata.join(split.where(F.col("split") == name).select(*keys), keys, "left_semi").select(*metadata.columns)


def split_report(split: DataFrame, by: str = "label") -> DataFrame:
    """Rows and share of each value of ``by`` in each part: ``split, <by>, n, share``."""
    counts = split.groupBy("split", by).agg(F.sum("copies").alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("split")))


def fold_report(folds: DataFrame) -> DataFrame:
    """Rows and share of each label on both sides of each fold: ``fold, split, label, n, share``."""
    counts = folds.groupBy("fold", "label").agg(F.sum("copies").alias("n"))
    counts = counts.withColumn("_rest", F.sum("n").over(Window.partitionBy("label")) - F.col("n"))
    pair = F.array(
        F.struct(F.lit(VALIDATION).alias("split"), F.col("n")),
        F.struct(F.lit(TRAIN).alias("split"), F.col("_rest").alias("n")),
    )
    sides = counts.select("fold", "label", F.explode(pair).alias("_side")).select(
        "fold", "_side.split", "label", "_side.n"
    )
    return sides.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("fold", "split")))


def make_splits(metadata: DataFrame, options: SplitOptions | None = None) -> dict[str, DataFrame]:
    """The stratified split, the source-aware split and, if configured, the folds."""
    options = options or SplitOptions()
    out = {
        "stratified": stratified_split(metadata, options),
        "source_aware": source_aware_split(metadata, options),
    }
    if options.cross_validation:
        out["folds"] = cross_validation_folds(metadata, options)
    return out

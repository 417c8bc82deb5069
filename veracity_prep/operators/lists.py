"""Lists of the items of a key as rows of bounded size, the same for keys of any size."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veracity_prep.operators.shared import fixed


def chunked_lists(df: DataFrame, keys: Sequence[str], item: Column, list_rows: int = 100_000) -> DataFrame:
    """Sorted item lists by key, repeats kept: rows ``keys, item_count, chunk, items``.

    A key has ``item_count`` items; chunk c holds those at the places c * ``list_rows`` to (c + 1) * ``list_rows`` - 1 of
    its sorted list (nulls first), so the chunks of a key, one after the other, are its list. Every key has chunk 0. Nothing
    depends on how many items a key has, and no task or row holds a whole large key:

    * copies of an item are counted map-side first;
    * the items are dealt out by range of (key, item), which cuts a large key into slices of several tasks;
    * the place of an item is its place in the slice plus the items in the slices before it, of which there is one
      count for each task and key. The slices are written before they are counted, so a repeated task can't move them;
    * an item whose copies reach over several chunks is cut there.
    """
    keys = list(keys)
    units = df.groupBy(*keys, item.alias("_item")).agg(F.count(F.lit(1)).alias("_copies"))
    units = fixed(units.repartitionByRange(*keys, "_item").withColumn("_slice", F.spark_partition_id()), "lists")

    zero = F.lit(0).cast("bigint")
    sizes = units.groupBy(*keys, "_slice").agg(F.sum("_copies").alias("_rows"))
    of_key = Window.partitionBy(*keys)
    earlier = of_key.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select(
        *[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)],
        F.col("_slice").alias("_of_slice"),
        F.coalesce(F.sum("_rows").over(earlier), zero).alias("_before"),
        F.sum("_rows").over(of_key).alias("item_count"),
    )
    inside = Window.partitionBy(*keys, "_slice").orderBy("_item").rowsBetween(Window.unboundedPreceding, -1)
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_key{i}")) for i, k in enumerate(keys)])
    placed = units.withColumn("_place", F.coalesce(F.sum("_copies").over(inside), zero)).join(
        before, same & (F.col("_slice") == F.col("_of_slice"))
    )
    start = F.col("_before") + F.col("_place")
    end, rows = start + F.col("_copies"), F.lit(list_rows).cast("bigint")
    pieces = placed.select(
        *keys,
        "item_count",
        "_item",
        start.alias("_start"),
        end.alias("_end"),
        F.explode(F.sequence(F.floor(start / rows), F.floor((end - 1) / rows))).alias("chunk"),
    )
    held = F.least("_end", (F.col("chunk") + 1) * rows) - F.greatest("_start", F.col("chunk") * rows)
    repeated = F.flatten(F.collect_list(F.array_repeat("_item", held.cast("int"))))
    return pieces.groupBy(*keys, "item_count", "chunk").agg(F.sort_array(repeated).alias("items"))


def first_chunks(lists: DataFrame) -> DataFrame:
    """One row per key: ``keys, item_count, items``, the items of its chunk 0."""
    return lists.where(F.col("chunk") == 0).drop("chunk")

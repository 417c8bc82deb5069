"""Exact ranks inside groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def hashed_ranks(
    df: DataFrame,
    groups: Sequence[str],
    id_column: str,
    seed: int,
    rank_rows: int = 1_000_000,
    few_groups: bool = False,
    also: Sequence[str] = (),
) -> DataFrame:
    """Rank the rows of each group in the order of a seeded hash of their id.

    The result has one row for each distinct (groups, id) with ``copies`` (its rows), ``first_rank`` (1-based rank
    of the first of them; the others follow) and ``group_rows``. It depends only on the ids and the seed, never
    on partitioning, and no task ranks much more than ``rank_rows`` rows:

    * copies of an id are counted map-side before anything is shuffled;
    * the hash is uniform, so a group above ``rank_rows`` is cut into slices of the hash range of about that
      size. The slices are ordered like the hash, so the rank is the rank in the slice plus the number of
      rows in the slices before it.

    ``also`` names columns that, with the id, identify a row: equal ids that differ in them are ranked one after the
    other. ``few_groups`` says that the number of groups has a fixed bound, so that their sizes may be broadcast.
    """
    groups, also = list(groups), list(also)
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(id_column).cast("string")))
    units = df.groupBy(*groups, *also, id_column).agg(F.count(F.lit(1)).alias("copies"))

    large = (
        df.groupBy(*groups)
        .agg(F.count(F.lit(1)).alias("_group_rows"))
        .where(F.col("_group_rows") > rank_rows)
        .withColumn("_slices", F.ceil(F.col("_group_rows") / F.lit(rank_rows)))
    )
    if few_groups:
        large = F.broadcast(large)
    prefix = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    zero = F.lit(0).cast("bigint")
    tagged = units.join(large, groups, "left").withColumn(
        "_slice", F.coalesce(F.shiftright(prefix * F.col("_slices"), 32), zero)
    )
    slice_rows = tagged.where("_slices is not null").groupBy(*groups, "_slice").agg(F.sum("copies").alias("_rows"))
    before = Window.partitionBy(*groups).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = slice_rows.select(*groups, "_slice", F.sum("_rows").over(before).alias("_offset"))

    part = Window.partitionBy(*groups, "_slice")
    earlier = part.orderBy("_hash", id_column, *also).rowsBetween(Window.unboundedPreceding, -1)
    # The explicit repartition keeps the slices of one group apart: the partitioning of the join by group would
    # otherwise satisfy the window and bring a whole group into one task. The hash is computed again behind it
    # rather than shuffled.
    ranked = (
        tagged.repartition(*groups, "_slice")
        .withColumn("_hash", digest)
        .withColumn("_in_slice", F.coalesce(F.sum("copies").over(earlier), zero))
        .withColumn("group_rows", F.coalesce("_group_rows", F.sum("copies").over(part)))
        .join(offsets, [*groups, "_slice"], "left")
    )
    first = F.coalesce("_offset", zero) + F.col("_in_slice") + 1
    return ranked.select(*groups, *also, id_column, "copies", first.alias("first_rank"), "group_rows")

"""Flat metadata, image links and the union of corpora."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    ByteType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    MapType,
    NullType,
    ShortType,
    StringType,
    StructType,
    TimestampType,
    VariantType,
)

from veracity_prep.operators.lists import chunked_lists, first_chunks

#: Publishers whose images are linked to articles.
ARTICLE_SOURCES = ("gossipcop", "politifact")

_NESTED = (ArrayType, MapType, StructType, VariantType)


def flat_metadata(items: DataFrame, dataset: str) -> DataFrame:
    """One flat row per item: the common fields and every scalar metadata field; nested ones are dropped.

    Fields are resolved from the schema alone. A metadata field never replaces a common field of the same name.
    """
    names = set(items.columns)

    def text(name: str, default: Column) -> Column:
        return F.col(name).cast("string") if name in names else default

    empty = F.lit("")
    label = text("label", empty)
    bodies = [F.coalesce(F.col(n), empty) != "" for n in ("raw_text", "processed_text") if n in names]
    base = {
        "id": text("id", empty),
        "source": text("source", empty),
        "label": label,
        "original_label": text("original_label", label),
        "has_text": reduce(lambda a, b: a | b, bodies, F.lit(False)),
        "has_images": F.lit(False),
    }
    columns = [F.lit(dataset).alias("dataset")] + [c.alias(n) for n, c in base.items()]
    if "metadata" in names:
        for f in items.schema["metadata"].dataType.fields:
            if f.name not in base and f.name != "dataset" and not isinstance(f.dataType, _NESTED):
                columns.append(F.col(f"metadata.`{f.name}`").alias(f.name))
    return items.select(*columns)


def linkable_images(images: DataFrame) -> DataFrame:
    """Article images of a known publisher that name their article."""
    known = F.col("source").isin(*ARTICLE_SOURCES)
    return images.where(known & (F.coalesce(F.col("article_id"), F.lit("")) != ""))


def article_image_links(images: DataFrame, list_rows: int = 100_000) -> DataFrame:
    """Links of each (source, article) in chunks: path, original path, size and aspect ratio."""
    link = F.struct(
        F.coalesce("processed_path", F.lit("")).alias("path"),
        F.coalesce("original_path", F.lit("")).alias("original_path"),
        F.col("original_size").alias("size"),
        F.col("aspect_ratio"),
    )
    return chunked_lists(linkable_images(images), ["source", "article_id"], link, list_rows)


def link_images(metadata: DataFrame, links: DataFrame) -> DataFrame:
    """Add ``image_count``, ``has_images`` and ``image_paths`` (JSON) to article metadata.

    ``links`` are those of :func:`article_image_links`. ``image_count`` counts all of an article's links; ``image_paths``
    holds its chunk 0, and the following chunks, if there are any, stay rows of ``links``. The count an article states
    about itself is kept as ``declared_image_count``.
    """
    links = first_chunks(links)
    if "image_count" in metadata.columns:
        metadata = metadata.withColumnRenamed("image_count", "declared_image_count")
    joined = metadata.join(links, ["source", "article_id"], "left")
    count = F.coalesce("item_count", F.lit(0).cast("bigint"))
    paths = F.when(F.col("item_count").isNull(), "[]").otherwise(F.to_json("items"))
    original = [c for c in metadata.columns if c != "has_images"]
    return joined.select(
        *original, (count > 0).alias("has_images"), count.alias("image_count"), paths.alias("image_paths")
    )


#: Numbers from narrow to wide.
_NUMBERS = (ByteType, ShortType, IntegerType, LongType, FloatType, DoubleType)


def common_type(types: Iterable[DataType]) -> DataType:
    """The narrowest type that holds the values of all: equal types stay, numbers widen (whole and broken numbers meet in
    DOUBLE, decimals and whole numbers in a decimal), dates become timestamps, and all else meets in STRING.
    """
    found = list({t.json(): t for t in types if not isinstance(t, NullType)}.values())
    if len(found) <= 1:
        return found[0] if found else NullType()
    kinds = {type(t) for t in found}
    if kinds <= set(_NUMBERS):
        whole = kinds <= set(_NUMBERS[:4])
        widest = max(found, key=lambda t: _NUMBERS.index(type(t)))
        return widest if whole or kinds <= set(_NUMBERS[4:]) else DoubleType()
    if DecimalType in kinds and kinds <= {DecimalType, *_NUMBERS[:4]}:
        return DecimalType(38, max(t.scale for t in found if isinstance(t, DecimalType)))
    if kinds == {DateType, TimestampType}:
        return TimestampType()
    return StringType()


def merged_columns(frames: Sequence[DataFrame]) -> dict[str, DataType]:
    """Columns of all frames with their common types, in order of first appearance; names differ by more than case."""
    spelling: dict[str, str] = {}
    types: dict[str, list[DataType]] = {}
    for f in (f for frame in frames for f in frame.schema.fields):
        name = spelling.setdefault(f.name.lower(), f.name)
        types.setdefault(name, []).append(f.dataType)
    return {name: common_type(t) for name, t in types.items()}


def union_corpora(frames: Iterable[DataFrame]) -> DataFrame | None:
    """Rows of all corpora, columns a corpus lacks are NULL; None when there is no corpus.

    A column whose type differs between corpora has the :func:`common_type`; nested values that become text are JSON.
    """
    frames = list(frames)
    if not frames:
        return None
    columns = merged_columns(frames)

    def fitted(frame: DataFrame) -> DataFrame:
        own = {f.name.lower(): f for f in frame.schema.fields}

        def value(name: str, kind: DataType) -> Column:
            field = own.get(name.lower())
            if field is None:
                return F.lit(None).cast(kind)
            column = F.col(f"`{field.name}`")
            if field.dataType == kind:
                return column
            nested = isinstance(field.dataType, _NESTED) and isinstance(kind, StringType)
            return F.to_json(column) if nested else column.cast(kind)

        return frame.select(*[value(n, k).alias(n) for n, k in columns.items()])

    return reduce(DataFrame.unionByName, map(fitted, frames))


def last_by_key(df: DataFrame, keys: Sequence[str], position: str, columns: Sequence[str]) -> DataFrame:
    """The row with the highest ``position`` for each key; rows with an empty last key are skipped.

    ``max_by`` combines map-side, so copies of a key are reduced before the shuffle.
    """
    present = df.where(F.coalesce(F.col(keys[-1]).cast("string"), F.lit("")) != "")
    chosen = present.groupBy(*keys).agg(F.max_by(F.struct(*columns), F.col(position)).alias("_last"))
    return chosen.select(*keys, "_last.*")


def csv_ready(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text, since CSV holds scalars only."""
    return df.select(
        *[
            F.to_json(f.name).alias(f.name) if isinstance(f.dataType, _NESTED) else F.col(f.name)
            for f in df.schema.fields
        ]
    )

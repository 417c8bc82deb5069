"""Fields of semi-structured JSON, read from VARIANT columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def has_field(v: Column, path: str) -> Column:
    """True when the path is there, even if it holds a JSON null."""
    return F.try_variant_get(v, path, "variant").isNotNull()


def field_or(v: Column, path: str, kind: str, default) -> Column:
    """A field as ``kind``; ``default`` only when the key is missing, so that a JSON null stays NULL."""
    value = F.try_variant_get(v, path, kind)
    if default is None:
        return value
    return F.when(has_field(v, path), value).otherwise(F.lit(default).cast(kind))


def strings_of(v: Column, path: str, key: str) -> Column:
    """``key`` of each object in an array, objects without it left out."""
    items = F.coalesce(
        F.try_variant_get(v, path, "array<variant>"),
        F.array().cast("array<variant>"),
    )
    kept = F.filter(items, lambda x: has_field(x, f"$.{key}"))
    return F.transform(kept, lambda x: F.try_variant_get(x, f"$.{key}", "string"))


def parse_once(df: DataFrame, keep: Sequence[str], value: str, output: str) -> DataFrame:
    """``keep`` and the JSON of ``value`` as VARIANT ``output``, NULL when it is not JSON.

    A plain projection would be copied into every filter and expression that mentions the result, and the text
    parsed again for each. Behind a generator it is parsed exactly once.
    """
    parsed = F.explode_outer(F.array(F.try_parse_json(value))).alias(output)
    return df.select(*keep, parsed)

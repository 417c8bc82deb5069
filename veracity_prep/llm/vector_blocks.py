"""Vectors in blocks: rows of one length packed side by side, so that tasks work on matrices of bounded size."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sound_rows(vectors: DataFrame, id_: str, vector: str, **more: Column) -> DataFrame:
    """``id, values, dim`` and ``more`` of the rows that have an id and a vector of finite components only."""
    values = F.transform(F.col(f"`{vector}`"), lambda v: v.cast("double"))
    rows = vectors.select(F.col(f"`{id_}`").cast("long").alias("id"), values.alias("values"), *[c.alias(n) for n, c in more.items()])
    finite = F.forall("values", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return rows.where(F.col("id").isNotNull() & F.col("values").isNotNull() & finite).withColumn("dim", F.size("values"))


def blocks_of(rows: DataFrame, size: int) -> DataFrame:
    """``dim, blocks``: how many blocks of about ``size`` rows each length of vector has."""
    return rows.groupBy("dim").agg(F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / size)).cast("int").alias("blocks"))


def in_blocks(rows: DataFrame, blocks: DataFrame, *by: str) -> DataFrame:
    """``rows`` with their ``block``, dealt out evenly by a hash of ``by``."""
    return rows.join(blocks, "dim").withColumn("block", F.pmod(F.xxhash64(*by), F.col("blocks")).cast("int"))


def matrix(column: pa.ChunkedArray, rows: int) -> np.ndarray:
    """A list column as rows by components; lists may be empty."""
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(float).reshape(rows, -1) if rows else np.zeros((0, 0))


def raw(array: np.ndarray, kind: str) -> bytes:
    return np.ascontiguousarray(array, kind).tobytes()


def one_row(**columns: object) -> pa.Table:
    """One row of bytes, integers and text."""
    kinds = {bytes: pa.binary(), int: pa.int64(), str: pa.string()}
    return pa.table({k: pa.array([v], kinds[type(v)]) for k, v in columns.items()})


def integers(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x), exact: as 64-bit integers where all fit well, else as Python integers."""
    if not values.size or np.abs(values).max() < 2**61 / scale:
        return np.floor(values * scale).astype(np.int64)
    # From 2^53 on a double is an integer itself.
    whole = [int(v) * scale if abs(v) >= 2**53 else int(np.floor(v * scale)) for v in values.ravel().tolist()]
    out = np.empty(len(whole), object)
    out[:] = whole
    return out.reshape(values.shape)

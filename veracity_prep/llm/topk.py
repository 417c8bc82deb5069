"""Exact top-k by inner product: branch and bound over dimension blocks in vertical layout.

Queries and candidates are packed into blocks of bounded size, each dimension contiguous. A pair of blocks is worked
on dimension block by dimension block. After each, what the remaining dimensions can add is at most the product of
the remaining lengths of query and candidate; candidates whose sum and that bound stay below the query's k-th best
lower bound so far are dropped, and the survivors are compacted before the next block of dimensions. Dimensions are
taken in the order of their mass, so bounds fall fast. Every query block meets every candidate block: the stated
query set against all rows, in blocks. A block pair gives each query's k best, and these are ranked over all pairs.

All arithmetic is exact. Components are integers; rows whose sums stay below 2^53 are worked on in double precision,
with bounds, and pairs with a larger row in integers of any size, without. A score beyond the range of a long counts
as the nearest long.

Nulls and edge cases: vectors that are null, empty, or hold null or non-finite components take no part; so do rows
without vec_id. Vectors of different lengths never meet. Ties go to the smaller vec_id. Rows that repeat a vec_id
are ranked each; a query's own vec_id is never its candidate. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veracity_prep.llm.shared import cut
from veracity_prep.llm.vector_blocks import blocks_of, in_blocks, integers, matrix, one_row, raw, sound_rows

#: Rows of a block of candidates, and of queries; dimensions of a block.
CANDIDATES, QUERIES, DIMENSIONS = 4_096, 512, 16
LONGEST = 2**63 - 1


def packed(rows: DataFrame, blocks: DataFrame, prefix: str) -> DataFrame:
    """``dim, block, ids, values``: blocks of rows of one length, as they come."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        ids = table.column("id").to_numpy()
        order = np.argsort(ids, kind="stable")
        values = matrix(table.column("values"), len(ids))[order]
        return one_row(**{"dim": key[0].as_py(), f"{prefix}_block": key[1].as_py(), f"{prefix}_ids": raw(ids[order], "<i8"), f"{prefix}_values": raw(values, "<f8")})

    schema = f"dim long, {prefix}_block long, {prefix}_ids binary, {prefix}_values binary"
    return in_blocks(rows, blocks, "id", "values").groupBy("dim", "block").applyInArrow(run, schema)


def small(values: np.ndarray) -> np.ndarray:
    """Which rows are so small that sums with each other stay below 2^53, and so are exact in double precision."""
    limit = int((2**53 // values.shape[1]) ** 0.5)
    return np.array([all(-limit < x < limit for x in row) for row in values.tolist()], bool) if values.dtype == object else (np.abs(values) < limit).all(1)


def best_of_large(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, values: np.ndarray, k: int) -> list[tuple]:
    """The k best candidates of each query, rows by components, for sums of any size: these are not pruned."""
    if not len(query_ids) or not len(ids):
        return []
    bound = values.shape[1] * max(abs(int(queries.min())), abs(int(queries.max()))) * max(abs(int(values.min())), abs(int(values.max())))
    kind = np.int64 if bound <= LONGEST else object
    queries, values, out = queries.astype(kind), values.astype(kind), []
    for query_id, query in zip(query_ids.tolist(), queries, strict=True):
        score = np.clip(values @ query, -LONGEST, LONGEST).astype(np.int64)
        alive = np.flatnonzero(ids != query_id)
        top = alive[np.lexsort((ids[alive], -score[alive]))[:k]]
        out += [(query_id, int(ids[x]), int(score[x])) for x in top]
    return out


def best(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, values: np.ndarray, k: int) -> list[tuple]:
    """The k best candidates of each query in one pair of blocks. ``queries`` and ``values`` are dimension by row."""
    mass = np.square(values).sum(1) * np.square(queries).sum(1)
    order = np.argsort(-mass, kind="stable")
    queries, values = queries[order], values[order]
    left = lambda m: np.sqrt(np.concatenate([np.cumsum(np.square(m)[::-1], 0)[::-1], np.zeros((1, m.shape[1]))]))
    q_left, c_left = left(queries), left(values)
    out = []
    for j, query_id in enumerate(query_ids):
        alive = np.flatnonzero(ids != query_id)
        sums = np.zeros(len(alive))
        for low in range(0, len(values), DIMENSIONS):
            high = min(low + DIMENSIONS, len(values))
            sums += queries[low:high, j] @ (values[low:high] if len(alive) == values.shape[1] else values[low:high, alive])
            if len(alive) > k and high < len(values):
                slack = q_left[high, j] * c_left[high, alive] * (1 + 1e-9) + 1e-6
                floor = np.partition(sums - slack, len(alive) - k)[len(alive) - k]
                keep = sums + slack >= floor
                if keep.mean() < 0.8:  # compacting costs a pass over what is left
                    alive, sums = alive[keep], sums[keep]
        top = alive[np.lexsort((ids[alive], -sums))[:k]]
        score = dict(zip(alive.tolist(), sums.tolist(), strict=True))
        out += [(int(query_id), int(ids[x]), int(score[x])) for x in top.tolist()]
    return out


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, scale: int = 64, id_: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's k highest integer inner products over all other rows."""
    rows = cut(sound_rows(vectors, id_, vector, asks=F.coalesce(is_query, F.lit(False))).where("dim > 0"), "vectors")
    blocks = blocks_of(rows, CANDIDATES)
    candidates = packed(rows.drop("asks"), blocks, "c")
    asked = rows.where("asks").drop("asks")
    queries = packed(asked, blocks_of(asked, QUERIES), "q")
    # A block of queries goes to each block of candidates: the number of the latter is part of the key, as one
    # length of vector would be one key for all.
    each = queries.join(blocks, "dim").withColumn("c_block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks").cast("long") - 1)))
    pairs = candidates.join(each, ["dim", "c_block"])

    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                get = lambda name, kind: np.frombuffer(batch.column(name)[row].as_py(), kind)  # noqa: B023, E731
                q, c = get("q_ids", "<i8"), get("c_ids", "<i8")
                asked, values = (integers(get(f"{x}_values", "<f8").reshape(n, -1), scale) for x, n in (("q", len(q)), ("c", len(c))))
                few, many = small(asked), small(values)
                found = best(q[few], asked[few].T.astype(float), c[many], values[many].T.astype(float), k) if few.any() and many.any() else []
                found += best_of_large(q[~few], asked[~few], c, values, k) + best_of_large(q[few], asked[few], c[~many], values[~many], k)
                yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.int64()) for i in range(3)], names=["query_id", "vec_id", "score"])

    # Pairs of blocks are few and dear: one to a task, as far as there are tasks.
    found = pairs.repartition(F.col("c_block"), F.col("q_block")).mapInArrow(run, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

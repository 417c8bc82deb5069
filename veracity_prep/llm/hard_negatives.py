"""Hard negatives by Four-Russians scoring: tables of subset sums, indexed with the candidates' packed bit-planes.

Components are integers. Candidates lie in blocks as bit-planes: for each bit of the two's complement and each group of eight
dimensions one byte, the bits of the eight components. For a block of anchors a table per group holds, for each of the
256 bytes, the sum of the anchor's components the byte selects. Adding a plane's lookups over all groups gives the
inner product with that plane, and shifting and adding these over the planes (the sign plane counts negative) gives the
whole inner product, exactly. Table width follows from a bound on the sums: 32 bits, 64 bits, or Python integers.

Every anchor meets every candidate, the stated query set against all rows, in pairs of blocks. The first pass finds
each anchor's best rows of its own label, its positives. Their scores give the windows of the second pass, which finds for each
positive the best rows of other labels inside its window. Each pair of blocks returns the few best, and these are
ranked over all pairs.

Nulls and edge cases: rows without id or label, and vectors that are null or hold null or non-finite components, take no
part. Vectors of different lengths never meet; empty vectors score 0 with each other. Ties go to the smaller id. Rows
that repeat an id are ranked each, as anchors too; a row with an anchor's own id is never its candidate. A score beyond
the range of a long counts as the nearest long. Anchors without positives, and positives without negatives, have no
rows. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veracity_prep.llm.shared import cut
from veracity_prep.llm.vector_blocks import blocks_of, in_blocks, integers, matrix, one_row, raw, sound_rows

#: Rows of a block of candidates and of anchors.
CANDIDATES, ANCHORS = 2_048, 128
LONGEST = 2**63 - 1


def bit_planes(values: np.ndarray) -> np.ndarray:
    """Packed planes of integers, rows by components: plane, group of eight components, row. The last plane is the sign."""
    low, high = (int(values.min()), int(values.max())) if values.size else (0, 0)
    bits = max(high.bit_length(), (~low).bit_length() if low < 0 else 0) + 1
    planes = [np.packbits(((values >> b) & 1).astype(np.uint8), axis=1, bitorder="little").T for b in range(bits)]
    return np.stack(planes) if planes else np.zeros((0, 0, len(values)), np.uint8)


def subset_sums(anchors: np.ndarray) -> np.ndarray:
    """Tables of anchors, rows by components: group of eight components, byte, anchor."""
    n, dim = anchors.shape
    padded = np.zeros((n, -(-dim // 8) * 8), anchors.dtype)
    padded[:, :dim] = anchors
    tables = np.zeros((padded.shape[1] // 8, 256, n), anchors.dtype)
    for bit in range(8):
        # The sums of bytes below 2^bit are there; those with this bit add one component to them.
        tables[:, 1 << bit : 2 << bit] = tables[:, : 1 << bit] + padded[:, bit::8].T[:, None, :]
    return tables


def width(anchors: np.ndarray, planes: int) -> np.dtype:
    """The narrowest integers that hold every sum on the way."""
    bound = max((sum(abs(int(x)) for x in row) for row in anchors), default=0) << planes
    return np.dtype(np.int32 if bound < 1 << 31 else np.int64 if bound < 1 << 63 else object)


def inner_products(tables: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """Rows by anchors, as longs."""
    out = np.zeros((planes.shape[2], tables.shape[2]), tables.dtype)
    for b, groups in enumerate(planes):
        part = np.zeros_like(out)
        for table, byte in zip(tables, groups, strict=True):
            part += table[byte]
        out += -(part << b) if b == len(planes) - 1 else part << b
    return np.clip(out, -LONGEST, LONGEST).astype(np.int64)


def candidate_blocks(rows: DataFrame, blocks: DataFrame, scale: int) -> DataFrame:
    def run(key: tuple, table: pa.Table) -> pa.Table:
        ids = table.column("id").to_numpy()
        order = np.argsort(ids, kind="stable")
        planes = bit_planes(integers(matrix(table.column("values"), len(ids))[order], scale))
        labels = table.column("label").to_numpy()[order]
        return one_row(dim=key[0].as_py(), block=key[1].as_py(), ids=raw(ids[order], "<i8"), labels=raw(labels, "<i8"), planes=planes.tobytes(), bits=len(planes))

    return in_blocks(rows, blocks, "id", "values").groupBy("dim", "block").applyInArrow(run, "dim long, block long, ids binary, labels binary, planes binary, bits long")


def anchor_blocks(anchors: DataFrame, blocks: DataFrame, wanted: int) -> DataFrame:
    """Anchors with the ids and scores of their positives, if any are known; once for each block of candidates."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        n = table.num_rows
        known, scores = np.zeros((n, wanted), np.int64), np.zeros((n, wanted), np.int64)
        counts = np.zeros(n, np.int64)
        for k, found in enumerate(table.column("positives").to_pylist()):
            counts[k] = len(found or ())
            for j, p in enumerate(found or ()):
                known[k, j], scores[k, j] = p["vec_id"], p["score"]
        numbers = [table.column(c).to_numpy() for c in ("row", "id", "label")]
        head = raw(np.stack([*numbers, counts]), "<i8")
        return one_row(dim=key[0].as_py(), anchors=n, heads=head, positives=raw(np.stack([known, scores]), "<i8"), values=raw(matrix(table.column("values"), n), "<f8"))

    own = blocks_of(anchors, ANCHORS)
    packed = in_blocks(anchors, own, "row").groupBy("dim", "block").applyInArrow(run, "dim long, anchors long, heads binary, positives binary, values binary")
    return packed.join(blocks, "dim").withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks").cast("long") - 1))).drop("blocks")


def pairs(candidates: DataFrame, anchors: DataFrame, scale: int, wanted: int, choose, schema: str) -> DataFrame:
    """``choose(ids, labels, scores, anchor)`` over every pair of blocks; ``scores`` holds one column for each anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                get = lambda name, kind: np.frombuffer(batch.column(name)[row].as_py(), kind)  # noqa: B023, E731
                n, bits = batch.column("anchors")[row].as_py(), batch.column("bits")[row].as_py()
                ids, labels = get("ids", "<i8"), get("labels", "<i8")
                values = integers(get("values", "<f8").reshape(n, -1), scale)
                kind = width(values, bits)
                scores = inner_products(subset_sums(values.astype(kind)), get("planes", np.uint8).reshape(bits, -(-values.shape[1] // 8), len(ids)))
                found = choose(ids, labels, scores, get("heads", "<i8").reshape(4, n), get("positives", "<i8").reshape(2, n, wanted))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in found], names=[c.split()[0] for c in schema.split(", ")])

    return candidates.join(anchors, ["dim", "block"]).mapInArrow(run, schema)


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 3,
    scale: int = 256,
    low: int = 50,
    high: int = 95,
    id_: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``: for each anchor and each of its best
    ``positives`` of the same label the best ``negatives`` of other labels that score ``low`` to ``high`` percent of
    the positive."""
    rows = sound_rows(vectors, id_, vector, label=F.col(f"`{label}`").cast("long"), asks=F.coalesce(is_anchor, F.lit(False)))
    # Rows get a number of their own, frozen by the write, so that repeated ids stay apart.
    rows = cut(rows.where("label is not null").withColumn("row", F.monotonically_increasing_id()), "vectors")
    blocks = blocks_of(rows, CANDIDATES)
    candidates = cut(candidate_blocks(rows, blocks, scale), "planes")
    anchors = rows.where("asks").select("row", "id", "label", "values", "dim")

    def same_label(ids, labels, scores, heads, _):
        of_label = {x: np.flatnonzero(labels == x) for x in np.unique(labels)}
        out = []
        for k, (row, own, wanted, _) in enumerate(heads.T.tolist()):
            at = of_label.get(wanted, np.zeros(0, int))
            at = at[ids[at] != own]
            at = at[np.argsort(-scores[at, k], kind="stable")[:positives]]
            out.append(np.stack([np.full(len(at), row), ids[at], scores[at, k]]))
        return np.concatenate(out, 1)

    none = F.lit(None).cast("array<struct<rank:int,vec_id:long,score:long>>")
    close = pairs(candidates, anchor_blocks(anchors.withColumn("positives", none), blocks, positives), scale, positives, same_label, "row long, vec_id long, score long")
    best = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    close = close.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= positives)
    lists = close.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("positives"))
    anchors = cut(anchors.join(lists, "row"), "positives")

    def other_label(ids, labels, scores, heads, known):
        out = []
        for k, (row, own, wanted, count) in enumerate(heads.T.tolist()):
            found = known[1, k, :count].tolist()
            # 100 * negative lies between low * positive and high * positive, in integers of any size.
            windows = [(-(-low * p // 100), high * p // 100) for p in found]
            least, most = min(w[0] for w in windows), max(w[1] for w in windows)
            column = scores[:, k]
            at = np.flatnonzero((labels != wanted) & (ids != own) & (column >= max(least, -LONGEST)) & (column <= min(most, LONGEST)))
            at = at[np.argsort(-column[at], kind="stable")]
            falling = -column[at]
            for n, (bottom, top) in enumerate(windows):
                start = np.searchsorted(falling, -top)
                mine = at[start : start + negatives]
                mine = mine[column[mine] >= bottom]
                m = len(mine)
                out.append(np.stack([np.full(m, row), np.full(m, own), np.full(m, n), np.full(m, known[0, k, n]), np.full(m, known[1, k, n]), ids[mine], column[mine]]))
        return np.concatenate(out, 1)

    schema = "row long, anchor_id long, place long, positive_id long, positive_score long, negative_id long, negative_score long"
    found = pairs(candidates, anchor_blocks(anchors, blocks, positives), scale, positives, other_label, schema)
    order = Window.partitionBy("row", "place").orderBy(F.desc("negative_score"), "negative_id")
    found = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")

"""Repeated passages by content-defined chunks under a gear rolling hash.

The hash of a byte position depends on the 32 bytes up to it, so cuts move with the content and resist shifts from
insertions. A cut is where the hash has its low bits clear, at least ``LEAST`` bytes after the cut before it, or after
``MOST`` bytes; cuts inside a character move to its end. Chunks are compared by 128-bit digest. The first occurrence
of a digest, by doc_id and place, is its keeper; a later chunk is a repeat. Runs of neighbouring repeats that hold at
least ``RUN`` characters are reported and can be removed; shorter ones are chance.

The digests of a chunk are counted before anything is joined, so a chunk that a third of all documents hold is one
row for each task. Only chunks that occur twice or more are joined back, and Spark can split that join.

Nulls and edge cases: null and empty texts have no chunks; rows without a doc_id are left out; repeated rows of one
doc_id count as one text (the texts of a doc_id are taken to be equal); extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from veracity_prep.llm.shared import cut

LEAST, MOST, MASK = 20, 256, 31
#: Characters of a run of repeats from which on it is reported.
RUN = 80
GEAR = np.random.default_rng(11).integers(0, 1 << 32, 256, dtype=np.uint32)
#: Bytes hashed at once.
BLOCK = 1 << 20
CHUNKS = "doc_id long, start long, end long, hi long, lo long"


def candidate_cuts(data: np.ndarray) -> np.ndarray:
    """Ends of bytes where the gear hash of the 32 bytes up to there has its low bits clear."""
    found = []
    for low in range(0, len(data), BLOCK):
        begin = max(0, low - 31)
        h = GEAR[data[begin : low + BLOCK]]
        # Doubling: the sum over 32 bytes, each shifted by its distance, in five steps.
        for width in (1, 2, 4, 8, 16):
            grown = h.copy()
            grown[width:] += h[:-width] << np.uint32(width)
            h = grown
        # The top bits have seen the most bytes.
        hits = np.flatnonzero((h >> np.uint32(27)) & np.uint32(MASK) == 0) + begin + 1
        found.append(hits[hits > low])
    return np.concatenate(found) if found else np.zeros(0, int)


def chunk_ends(data: bytes) -> np.ndarray:
    """Byte ends of the chunks of a text in UTF-8."""
    flat, size = np.frombuffer(data, np.uint8), len(data)
    ends, last = [], 0
    for end in [*candidate_cuts(flat).tolist(), size]:
        while end - last > MOST:
            last = whole(flat, last + MOST)
            ends.append(last)
        if end - last >= LEAST or end == size and end > last:
            last = whole(flat, end)
            ends.append(last)
    return np.array(ends, int)


def whole(flat: np.ndarray, end: int) -> int:
    """The end of the character that ``end`` is in."""
    while end < len(flat) and flat[end] & 0xC0 == 0x80:
        end += 1
    return end


def chunks(docs: DataFrame) -> DataFrame:
    """doc_id, start and end (code points) and digest of every chunk of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, starts, ends, digests = [], [], [], []
            held = 0

            def table() -> pa.RecordBatch:
                both = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
                return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (ids, starts, ends)] + [pa.array(both[:, 0]), pa.array(both[:, 1])], names=["doc_id", "start", "end", "hi", "lo"])  # noqa: B023

            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                data = (text.as_py() or "").encode()
                if not data:
                    continue
                cuts = chunk_ends(data)
                begins = np.concatenate([[0], cuts[:-1]])
                # Bytes that begin a character, counted up to each cut.
                heads = (np.frombuffer(data, np.uint8) & 0xC0) != 0x80
                points = np.cumsum(np.add.reduceat(heads, begins, dtype=np.int64))
                digests += [xxhash.xxh3_128_digest(data[a:b]) for a, b in zip(begins.tolist(), cuts.tolist(), strict=True)]
                ids.append(np.full(len(cuts), doc_id.as_py()))
                starts.append(np.concatenate([[0], points[:-1]]))
                ends.append(points)
                held += len(cuts)
                if held > 50_000:
                    yield table()
                    ids, starts, ends, digests, held = [], [], [], [], 0
            if ids:
                yield table()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null").mapInArrow(run, CHUNKS)


def repeats(docs: DataFrame) -> DataFrame:
    """Passages that occur in an earlier document or earlier in the same one.

    Returns doc_id, start and end (code points, end exclusive), n_chunks, keeper_ids (sorted doc_ids that hold the
    first occurrences of the run's chunks, the first and last of them if they are many: the smallest and largest).
    """
    found = cut(chunks(docs), "chunks")
    # A repeated row gives the same chunks; they are one. The keeper is the first by doc_id, then place.
    first = found.groupBy("hi", "lo").agg(F.min(F.struct("doc_id", "start")).alias("keeper"), F.max(F.struct("doc_id", "start")).alias("last")).where("keeper < last")
    first = first.select("hi", "lo", F.col("keeper.doc_id").alias("keeper"), F.col("keeper.start").alias("keeper_start"))
    again = found.join(first, ["hi", "lo"]).where("doc_id <> keeper or start <> keeper_start").select("doc_id", "start", "end", "keeper").distinct()
    # Neighbours: the chunk before ends where this one begins.
    order = Window.partitionBy("doc_id").orderBy("start")
    run = F.sum(F.when(F.lag("end").over(order) == F.col("start"), 0).otherwise(1)).over(order.rowsBetween(Window.unboundedPreceding, 0))
    spans = again.withColumn("run", run).groupBy("doc_id", "run")
    spans = spans.agg(F.min("start").alias("start"), F.max("end").alias("end"), F.count("*").alias("n_chunks"), F.min("keeper").alias("keeper_id"), F.max("keeper").alias("last_keeper_id"))
    return spans.where(F.col("end") - F.col("start") >= RUN).drop("run")


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with the passages that ``repeats`` reports taken out of ``text``; rows and columns stay."""
    spans = repeats(docs).groupBy(F.col("doc_id").alias("id")).agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))
    joined = docs.join(spans, docs["doc_id"].cast("long") == spans["id"], "left")
    ends = F.concat(F.array(F.lit(0).cast("long")), F.transform("spans", lambda s: s["end"]))
    starts = F.concat(F.transform("spans", lambda s: s["start"]), F.array(F.length("text").cast("long")))
    kept = F.zip_with(ends, starts, lambda a, b: F.substring(docs["text"], (a + 1).cast("int"), (b - a).cast("int")))
    text = F.when(F.col("spans").isNull(), docs["text"]).otherwise(F.array_join(kept, ""))
    return joined.select(*(text.alias("text") if c == "text" else docs[c] for c in docs.columns))

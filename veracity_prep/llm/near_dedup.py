"""Near-duplicate documents by SetSketch registers, banded search, joint likelihood and confirmation on full sets.

Each document's set of word shingles gives ``REGISTERS`` registers. A register holds the minimum of exponential
hash values over the set, truncated to exponentially spaced steps (base ``BASE``), so registers of a union are the
elementwise maximum (``merge``). Documents with one set are one node from the start. Nodes that agree on a whole
band of registers meet in a bucket.

No bucket is expanded into all its pairs. Round one pairs each member of a bucket with the bucket's most popular
member, the one that shares most buckets with others. The joint likelihood of the registers (with the known set
sizes) drops pairs for which the threshold is out of reach; the margin corresponds to about one true link in ten
million. The pairs that are left are confirmed on the full sets of 64-bit shingle hashes. Round two takes the buckets that still hold different components: members outside the largest
component of what such buckets connect are compared with all its other members, in cells of bounded size, and only
confirmed links leave a cell. Components come from alternating large-star and small-star steps.

Nulls and edge cases: a null or blank text has an empty set and is linked with nothing; a text with fewer words than
a shingle is one shingle; rows without a doc_id take part in no link and keep a null component; repeated rows of a
doc_id all come back, with one component: rows of one doc_id are linked with each other, whatever their texts, and a
class reaches through all of them. Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from veracity_prep.llm.shared import cut, fresh, released

#: Base of the register steps, and rate of the exponential hash values: small sets stay clear of the lowest step.
BASE, RATE, TOP = 1.02, 20.0, 65_534
BANDS, ROWS = 40, 5
REGISTERS = BANDS * ROWS
#: Natural-log likelihood that the threshold may lie below the maximum.
MARGIN = 14.0
#: Elements hashed together; the buffers stay in the processor's cache.
BLOCK = 150_000

_RANDOM = np.random.default_rng(20_240_229)
FACTORS = _RANDOM.integers(0, 1 << 32, REGISTERS, dtype=np.uint32) | np.uint32(1)
SHIFTS = _RANDOM.integers(0, 1 << 32, REGISTERS, dtype=np.uint32)
MIX = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))

SIGNATURE = "doc_id long, n_shingles long, set_key binary, registers binary"


class WordHashes(dict):
    """64-bit hashes of words; starts anew when it is full."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(word) < 40:
            if len(self) > 300_000:
                self.clear()
            self[word] = value
        return value


HASHES = WordHashes()


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct hashes of a text's word shingles; words are cut at ASCII white space, A-Z in lower case."""
    words = (text or "").encode().lower().split()
    values = np.fromiter(map(HASHES.__getitem__, words), np.uint64, len(words))
    if not len(values):
        return values
    size = min(size, len(values))
    count = len(values) - size + 1
    found = np.full(count, size, np.uint64)
    for k in range(size):
        found = (found ^ (found >> np.uint64(31))) * MIX[0] + values[k : k + count] * MIX[1]
    found ^= found >> np.uint64(32)
    found *= MIX[2]
    found ^= found >> np.uint64(29)
    return np.unique(found)


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """Registers of non-empty sets, a row for each."""
    starts = np.cumsum([0, *map(len, sets[:-1])])
    values = np.concatenate(sets).astype(np.uint32)
    buffer, least = np.empty_like(values), np.empty((REGISTERS, len(sets)), np.uint32)
    for k in range(REGISTERS):
        np.multiply(values, FACTORS[k], out=buffer)
        np.add(buffer, SHIFTS[k], out=buffer)
        np.minimum.reduceat(buffer, starts, out=least[k])
    exponential = -np.log1p(-(least.T + 0.5) / 2.0**32) / RATE
    return np.clip(np.floor(1 - np.log(exponential) / np.log(BASE)), 0, TOP).astype("<u2")


def merge(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Registers of the union of two sets."""
    return np.maximum(left, right)


def signatures(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, set size, 128-bit key of the set and registers (null for empty sets) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(ids: list, sets: list[np.ndarray]) -> pa.RecordBatch:
            full = [s for s in sets if len(s)]
            rows = iter(registers(full)) if full else iter(())
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                    pa.array([next(rows).tobytes() if len(s) else None for s in sets], pa.binary()),
                ],
                names=["doc_id", "n_shingles", "set_key", "registers"],
            )

        ids, sets, held = [], [], 0
        for batch in released(batches):
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                ids.append(doc_id.as_py())
                sets.append(shingle_set(text.as_py(), size))
                held += len(sets[-1])
                if held > BLOCK or len(sets) > 5_000:
                    yield done(ids, sets)
                    ids, sets, held = [], [], 0
        if ids:
            yield done(ids, sets)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, SIGNATURE)


def full_sets(docs: DataFrame, size: int) -> DataFrame:
    """id and the sorted 64-bit hashes of the whole set, of the rows (``id, set_key, text``) whose text has that key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in released(batches):
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                hashes = pa.array((shingle_set(t.as_py(), size).tobytes() for t in part.column(2)), pa.binary(), size=part.num_rows)
                # A doc_id with several texts comes with each of them.
                own = pa.array([xxhash.xxh3_128_digest(h.as_buffer()) == k.as_py() for h, k in zip(hashes, part.column(1), strict=True)], pa.bool_())
                yield pa.RecordBatch.from_arrays([part.column(0).filter(own), hashes.filter(own)], names=["id", "hashes"])

    return docs.select("id", "set_key", "text").mapInArrow(run, "id long, hashes binary")


def within_reach(pairs: pa.RecordBatch, percent: int) -> np.ndarray:
    """For pairs with ``ka, kb, na, nb``: whether the threshold is likely enough."""
    ka, kb = (np.frombuffer(b"".join(pairs.column(c).to_pylist()), "<u2").reshape(-1, REGISTERS) for c in ("ka", "kb"))
    na, nb = (pairs.column(c).to_numpy().astype(float)[:, None] for c in ("na", "nb"))
    more, less = (ka > kb).sum(1)[:, None], (ka < kb).sum(1)[:, None]
    same = REGISTERS - more - less
    most = np.minimum(na, nb) / np.maximum(na, nb)
    u, v = na / (na + nb), nb / (na + nb)

    def likelihood(jaccard: np.ndarray) -> np.ndarray:
        step = lambda x: -np.log1p(-np.maximum(x, 0) * (BASE - 1) / BASE) / np.log(BASE)
        p, q = step(u - v * jaccard), step(v - u * jaccard)
        log = lambda x: np.log(np.maximum(x, 1e-12))
        return more * log(p) + less * log(q) + same * log(1 - p - q)

    grid = np.linspace(0, 1, 41)[None, :]
    best = likelihood(most * grid).max(1)
    low = np.minimum(percent / 100, most)
    good = likelihood(low + (most - low) * grid).max(1)
    return good >= best - MARGIN


def likely(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """``pairs`` (a, b) that the registers don't rule out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield batch.select(["a", "b"]).filter(pa.array(within_reach(batch, percent)))

    def side(name: str) -> DataFrame:
        return nodes.select(F.col("id").alias(name), F.col("n").alias(f"n{name}"), F.col("registers").alias(f"k{name}"))

    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(run, "a long, b long")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``pairs`` whose full sets are as similar as asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("ha"), batch.column("hb"), strict=True):
                left, right = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                common = len(left) + len(right) - len(np.union1d(left, right))
                keep.append(100 * common >= percent * (len(left) + len(right) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left, right = sets.select(F.col("id").alias("a"), F.col("hashes").alias("ha")), sets.select(F.col("id").alias("b"), F.col("hashes").alias("hb"))
    return pairs.select("a", "b").join(left, "a").join(right, "b").mapInArrow(run, "a long, b long").distinct()


def across(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between different components (column ``c``) of a neighbourhood (column ``hood``), confirmed on full sets.

    Members outside the neighbourhood's largest component meet all others, in cells of a bounded number of shingles
    on either side. Only confirmed links leave a cell.
    """
    sizes = members.groupBy("hood", "c").agg(F.sum("n").alias("n"))
    sizes = sizes.groupBy("hood").agg(F.max(F.struct("n", "c")).alias("most"), F.sum("n").alias("all"))
    cells = F.greatest(F.lit(1), F.ceil(F.col("all") / 1_000_000)).cast("int"), F.greatest(F.lit(1), F.ceil((F.col("all") - F.col("most.n")) / 100_000)).cast("int")
    placed = members.join(sizes, "hood").withColumns({"wide": cells[0], "tall": cells[1], "open": F.col("c") != F.col("most.c")})
    at = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    columns = ("hood", "column", "row", "open", "id", "n", "c")
    rows = placed.withColumns({"open": F.lit(False), "column": at("wide")}).select("*", every("tall").alias("row")).select(*columns)
    rows = rows.unionByName(placed.where("open").withColumn("row", at("tall")).select("*", every("wide").alias("column")).select(*columns))

    def run(key: tuple, table: pa.Table) -> pa.Table:
        sizes, of, ids = table.column("n").to_numpy(), table.column("c").to_numpy(), table.column("id").to_numpy()
        opened = table.column("open").to_numpy()
        hashes = [np.frombuffer(x.as_py(), np.uint64) for x in table.column("hashes")]
        closed = np.flatnonzero(~opened)
        found: list[tuple[int, int]] = []
        if len(closed):
            flat = np.concatenate([hashes[k] for k in closed])
            starts = np.cumsum([0, *(len(hashes[k]) for k in closed[:-1])])
            for k in np.flatnonzero(opened):
                own = hashes[k]
                place = np.searchsorted(own, flat)
                common = np.add.reduceat(own[np.minimum(place, len(own) - 1)] == flat, starts, dtype=np.int64)
                fits = (100 * common >= percent * (sizes[closed] + sizes[k] - common)) & (of[closed] != of[k])
                found += [(min(ids[k], ids[x]), max(ids[k], ids[x])) for x in closed[fits]]
        return pa.table({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([y for _, y in found], pa.int64())})

    return rows.join(sets, "id").groupBy("hood", "column", "row").applyInArrow(run, "a long, b long").distinct()


def components(links: DataFrame) -> DataFrame:
    """``id, component`` (smallest id reachable) of every id in ``links`` (a, b), by alternating star steps."""

    def written(edges: DataFrame) -> tuple[DataFrame, tuple]:
        # Number and fingerprint of the edges come with the write.
        seen = Observation()
        out = cut(edges.where("u > v").distinct().observe(seen, F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")), "edges")
        return out, (seen.get["n"], seen.get["x"])

    edges, before = written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")))
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # Large star: each larger neighbour is hung below the least of the neighbourhood.
        hung = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # Small star: so is the node itself with its smaller neighbours.
        least = hung.groupBy("u").agg(F.min("v").alias("m"))
        down = hung.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        edges, now = written(down)
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """Classes of documents linked by a Jaccard similarity of at least ``percent`` / 100 of ``words``-word shingles.

    Returns, for each row of ``docs``: doc_id, n_shingles (size of the set), component_id (smallest doc_id that links
    reach from it, itself included) and kept (whether it is that document).
    """
    signed = cut(signatures(docs, words), "signatures")
    nodes = cut(
        signed.where("n_shingles > 0 and doc_id is not null")
        .groupBy("set_key")
        .agg(F.min("doc_id").alias("doc"), F.first("n_shingles").alias("n"), F.first("registers").alias("registers"))
        .withColumn("id", F.monotonically_increasing_id()),
        "set-nodes",
    )
    hashes = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda k: F.xxhash64(k, F.substring(F.col("registers"), k * (2 * ROWS) + 1, F.lit(2 * ROWS))))
    members = nodes.select("id", "n", F.explode(hashes).alias("bucket"))
    held = cut(members.join(members.groupBy("bucket").agg(F.count("*").alias("members")).where("members > 1"), "bucket"), "buckets")
    popular = held.groupBy("id").agg((-F.sum("members")).alias("pop"))
    picks = held.join(popular, "id").groupBy("bucket").agg(F.min(F.struct("pop", "id", "n")).alias("pick"))
    near = lambda x, y: f"100 * least({x}, {y}) >= {percent} * greatest({x}, {y})"
    stars = held.join(picks, "bucket").where("id <> pick.id").where(near("n", "pick.n")).select(F.least("id", "pick.id").alias("a"), F.greatest("id", "pick.id").alias("b")).distinct()
    stars = cut(likely(stars, nodes, percent), "star-pairs")
    wanted = stars.select(F.explode(F.array("a", "b")).alias("id")).unionByName(held.where("members > 2").select("id")).distinct()
    texts = docs.select(F.col("doc_id").cast("long").alias("doc"), "text")
    sets = cut(full_sets(texts.join(nodes.select("id", "doc", "set_key").join(wanted, "id"), "doc"), words), "shingle-sets")
    found = components(confirmed(stars, sets, percent))
    # Buckets that still hold different components: what they connect is a neighbourhood.
    mixed = held.where("members > 2").join(found, "id", "left").select("bucket", "id", "n", F.coalesce("component", "id").alias("c"))
    parts = mixed.groupBy("bucket").agg(F.min("c").alias("first"), F.max("c").alias("last")).where("first <> last")
    mixed = cut(mixed.join(parts, "bucket"), "mixed-buckets")
    if not mixed.isEmpty():
        hoods = components(mixed.select(F.col("c").alias("a"), F.col("first").alias("b"))).select(F.col("id").alias("c"), F.col("component").alias("hood"))
        crossing = across(mixed.select("id", "n", "c").distinct().join(hoods, "c"), sets, percent)
        found = components(found.select(F.col("id").alias("a"), F.col("component").alias("b")).unionByName(crossing))
    # Rows of one doc_id with different sets: usually there are none.
    keys = signed.where("doc_id is not null").groupBy("doc_id").agg(F.min("set_key").alias("low"), F.max("set_key").alias("high"), F.max(F.col("set_key").isNull()).alias("blank"))
    split = cut(keys.where("low <> high or low is not null and blank").select("doc_id"), "split-ids")
    several = not split.isEmpty()
    if several:
        held_by = signed.select("doc_id", "set_key").join(split, "doc_id", "left_semi").distinct().join(nodes.select("set_key", "id"), "set_key")
        least = held_by.groupBy("doc_id").agg(F.min("id").alias("a"))
        shared = held_by.join(least, "doc_id").where("id <> a").select("a", F.col("id").alias("b"))
        found = components(found.select(F.col("id").alias("a"), F.col("component").alias("b")).unionByName(shared))
    linked = nodes.select("id", "doc").join(found, "id")
    smallest = linked.groupBy("component").agg(F.min("doc").alias("least"))
    linked = linked.join(smallest, "component").select("id", "least")
    classes = nodes.select("set_key", "id", "doc").join(linked, "id", "left").select("set_key", F.coalesce("least", "doc").alias("component"))
    out = signed.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("set_key")).alias("set_key")).join(classes, "set_key", "left")
    if several:
        # Blank rows of such a doc_id have its class too.
        of_split = out.join(split, "doc_id", "left_semi").groupBy("doc_id").agg(F.min("component").alias("whole"))
        out = out.join(of_split, "doc_id", "left").withColumn("component", F.coalesce("whole", "component"))
    component = F.coalesce("component", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), component.eqNullSafe(F.col("doc_id")).alias("kept"))


def one_of_each(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The document with the smallest doc_id of each class, with the columns of ``docs``; one row for each doc_id, of
    several the one with the smallest text (null last).

    Rows without a doc_id belong to no class and all stay.
    """
    kept = near_duplicates(docs, words, percent).where("kept and doc_id is not null").select("doc_id").distinct()
    place = fresh(docs, "place")
    order = Window.partitionBy("doc_id").orderBy(F.col("text").asc_nulls_last())
    chosen = docs.join(kept, docs["doc_id"].cast("long") == kept["doc_id"], "left_semi").withColumn(place, F.row_number().over(order))
    return chosen.where(F.col(place) == 1).drop(place).unionByName(docs.where("doc_id is null"))

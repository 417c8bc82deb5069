"""Benchmark passages in documents: latent semantic retrieval, then longest common subsequence and answer checks.

Words are lower-case runs of letters and digits, hashed to ``TERMS`` terms. Document frequencies of the terms over all
passages of all documents give the TF-IDF weights. A randomised SVD over all those passages gives the latent space: two
distributed products with A^T A, and a small eigenproblem on the driver. The terms of each text are written once, two
bytes each, for the frequencies and both products. A few random directions are
added for what that space leaves out. Every window of every document
is put into that space, whitened, and compared by cosine with the benchmark passages of its length class. Windows
that share enough weighted terms with such a passage go on to the exact checks: the longest common subsequence of
words, weighted by IDF, between the whole item and the surroundings of the window. A share of ``STRONG`` is a leak; so is
``WEAK`` if the item's answer (column ``answer``, else its last ``ANSWER`` words) is there as well.

The benchmark goes to the tasks in blocks of about ``ITEMS`` rows, one after the other; that, the terms and the latent
space are what tasks get, and none grows with the corpus. Documents are never shuffled.

Nulls and edge cases: null and empty texts match nothing; items that are null or shorter than ``LEAST`` words are
left out; repeated items are found each; repeated rows of documents are searched each. With an empty benchmark or no
words in the corpus nothing matches. Extra columns are kept or ignored by name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veracity_prep.llm.shared import cut, released

TERMS, RANK, EXTRA = 1 << 14, 24, 8
#: Random directions that stand for what the latent space leaves out: terms too rare for it still tell passages apart.
RANDOM = 16
WIDTH = RANK + RANDOM
#: Words of a block; windows are runs of so many blocks.
STEP, RUNS = 8, (2, 4, 8)
#: Words of a passage.
PASSAGE = STEP * RUNS[1]
ITEMS, LEAST, ANSWER = 4_000, 6, 6
COSINE, SHARED, STRONG, WEAK = 0.5, 0.45, 0.6, 0.4
#: Words that are worked on at once.
BLOCK = 150_000
FOUND = "array<struct<item_id:bigint,share:double,at:int>>"


#: Odd base of the rolling sums, and its inverse modulo 2^64.
FACTOR = 0x9E3779B97F4A7C15
INVERSE = pow(FACTOR, -1, 1 << 64)
#: Bytes of words: ASCII letters and digits, and all of what isn't ASCII.
IN_WORD = np.array([c >= 0x80 or chr(c).isalnum() for c in range(256)])
_POWERS: list[np.ndarray] = []


def powers(size: int) -> list[np.ndarray]:
    """FACTOR and INVERSE to the powers 0 to ``size``, modulo 2^64."""
    if not _POWERS or len(_POWERS[0]) <= size:
        _POWERS[:] = [np.concatenate([[np.uint64(1)], np.cumprod(np.full(max(size, 4 * BLOCK), x, np.uint64))]) for x in (FACTOR, INVERSE)]
    return _POWERS


def parts_of(text: str) -> Iterator[str]:
    """A text in parts of bounded size, cut at blanks where there are any."""
    while len(text) > 8 * BLOCK:
        at = text.rfind(" ", 0, 8 * BLOCK) + 1 or 8 * BLOCK
        yield text[:at]
        text = text[at:]
    yield text


def all_hashes(texts: list[str]) -> list[np.ndarray]:
    """63-bit hashes of the words of each text.

    A word's hash comes from sums of its bytes times powers of an odd factor: differences of one running sum over all
    texts, brought to the word's beginning by the inverse power.
    """
    data = [t.lower().encode("utf-8", "surrogatepass") for t in texts]
    flat = np.frombuffer(b"\n" + b"\n".join(data) + b"\n", np.uint8)
    inside = IN_WORD[flat]
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    starts, ends = edges[::2], edges[1::2]
    up, down = powers(len(flat))
    sums = np.concatenate([[np.uint64(0)], np.cumsum((flat.astype(np.uint64) + np.uint64(1)) * up[: len(flat)])])
    found = (sums[ends] - sums[starts]) * down[starts]
    found ^= found >> np.uint64(32)
    found *= np.uint64(0xD6E8FEB86659FD93)
    found = ((found ^ (found >> np.uint64(29))) >> np.uint64(1)).astype(np.int64)
    begins = np.cumsum([1, *(len(d) + 1 for d in data)])
    return np.split(found, np.searchsorted(starts, begins[1:-1]))


def in_batches(texts: list[str]) -> list[np.ndarray]:
    """``all_hashes``, so many texts at once that the arrays stay in the processor's cache."""
    out, held, size = [], [], 0
    for text in texts:
        held.append(text)
        size += len(text)
        if size > 60_000:
            out += all_hashes(held)
            held, size = [], 0
    return out + (all_hashes(held) if held else [])


def word_hashes(text: str | None) -> np.ndarray:
    return np.concatenate([all_hashes([p])[0] for p in parts_of(text or "")])


def terms(hashes: np.ndarray) -> np.ndarray:
    return (hashes & (TERMS - 1)).astype(np.int32)


def grouped(values: Iterator[str | None]) -> Iterator[list[np.ndarray]]:
    """Hashes of texts, so many texts at once that they have about ``BLOCK`` words."""
    held, size = [], 0
    for value in values:
        text = value or ""
        if len(text) > 8 * BLOCK:
            if held:
                yield in_batches(held)
            yield [word_hashes(text)]
            held, size = [], 0
            continue
        held.append(text)
        size += len(text)
        if size > 6 * BLOCK or len(held) > 2_000:
            yield in_batches(held)
            held, size = [], 0
    if held:
        yield in_batches(held)


def term_lists(docs: DataFrame) -> DataFrame:
    """``terms``: the terms of each whole text in their order, as little-endian 16-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in grouped(v.as_py() for v in batch.column(0)):
                yield pa.RecordBatch.from_arrays([pa.array([terms(t).astype("<u2").tobytes() for t in texts if len(t)], pa.binary())], names=["terms"])

    return cut(docs.select("text").mapInArrow(run, "terms binary"), "terms")


def passages(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """Passages of ``term_lists``, a row each, filled up with ``TERMS``; about a quarter of ``BLOCK`` words at once."""

    def rows(held: list[np.ndarray]) -> np.ndarray:
        sizes = np.array([-(-len(x) // PASSAGE) for x in held])
        out = np.full(sizes.sum() * PASSAGE, TERMS, np.uint16)
        first = (np.cumsum(sizes) - sizes) * PASSAGE
        for at, x in zip(first, held, strict=True):
            out[at : at + len(x)] = x
        return out.reshape(-1, PASSAGE)

    held, size, step = [], 0, BLOCK // 4 // PASSAGE * PASSAGE
    for batch in batches:
        for value in batch.column("terms"):
            whole = np.frombuffer(value.as_py(), "<u2")
            for k in range(0, len(whole), step):
                held.append(whole[k : k + step])
                size += len(held[-1])
                if size >= step:
                    yield rows(held)
                    held, size = [], 0
    if held:
        yield rows(held)


def document_frequencies(lists: DataFrame) -> tuple[np.ndarray, int]:
    """Passages that hold each term, over all of ``term_lists``, and the number of passages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, n = np.zeros(TERMS + 1, np.int64), 0
        for part in passages(batches):
            part = np.sort(part, 1)
            fresh = np.ones(part.shape, bool)
            fresh[:, 1:] = part[:, 1:] != part[:, :-1]
            counts += np.bincount(part[fresh], minlength=TERMS + 1)
            n += len(part)
        seen = np.flatnonzero(counts[:TERMS])
        yield pa.RecordBatch.from_arrays([pa.array(np.append(seen, -1)), pa.array(np.append(counts[seen], n))], names=["term", "n"])

    rows = lists.mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(TERMS, np.int64)
    for row in rows:  # one row for each term, and one for the number of passages
        if row.term >= 0:
            counts[row.term] = row.n
    return counts, next((row.n for row in rows if row.term < 0), 0)


def row_sums(table: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For each row of ``at``, the sum of the rows of ``table`` that it names, added from left to right."""
    columns = np.ascontiguousarray(at.T).astype(np.intp)
    out = table.take(columns[0], 0, mode="clip")
    part = np.empty_like(out)
    for column in columns[1:]:
        out += table.take(column, 0, out=part, mode="clip")
    return out


def term_sums(part: np.ndarray, y: np.ndarray) -> np.ndarray:
    """For each column of ``y`` and each term, the sum of the passages' values over the term's occurrences in ``part``.

    One count with weights a column: sums by runs of sorted terms cost a call for each distinct term of a block.
    """
    flat = part.ravel().astype(np.intp)
    return np.stack([np.bincount(flat, np.repeat(column, part.shape[1]), TERMS + 1) for column in y.T.astype(float, order="C")])


def gram(lists: DataFrame, idf: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """A^T A ``vectors`` for the unit TF-IDF rows A of all passages: sums by task, then by slice of terms."""
    slices = 32
    height, width = TERMS // slices, vectors.shape[1]
    # Each occurrence counts once, so a term that occurs n times in a passage has weight n; TERMS has none.
    weighted = np.concatenate([idf[:, None] * vectors, np.zeros((1, width))]).astype(np.float32)
    squared = np.append(np.square(idf), 0).astype(np.float32)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, TERMS + 1))
        for part in passages(batches):
            y = row_sums(weighted, part) / np.maximum(row_sums(squared, part), 1e-9)[:, None]
            total += term_sums(part, y)
        total = idf[:, None] * total.T[:TERMS]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(slices), pa.int32()), pa.array([total[k * height : (k + 1) * height].tobytes() for k in range(slices)], pa.binary())], names=["slice", "sums"])

    def added(key: tuple, table: pa.Table) -> pa.Table:
        sums = np.zeros(height * width)
        for x in table.column("sums"):
            sums += np.frombuffer(x.as_py())
        return pa.table({"slice": pa.array([key[0].as_py()], pa.int32()), "sums": pa.array([sums.astype(np.float32).tobytes()], pa.binary())})

    rows = lists.mapInArrow(partial, "slice int, sums binary").groupBy("slice").applyInArrow(added, "slice int, sums binary").collect()
    out = np.zeros(vectors.shape, np.float32)
    for row in rows:
        out[row["slice"] * height : (row["slice"] + 1) * height] = np.frombuffer(row.sums, np.float32).reshape(height, -1)
    return out


class Space:
    """IDF weights and the whitened latent vector of each term."""

    def __init__(self, docs: DataFrame):
        lists = term_lists(docs)
        counts, n = document_frequencies(lists)
        self.idf = np.log((n + 1) / (counts + 1)).astype(np.float32) + 0.05
        #: Terms with the rarer half of all occurrences.
        order = np.argsort(-self.idf)
        self.rare = np.zeros(TERMS, bool)
        self.rare[order[np.cumsum(counts[order]) <= counts.sum() / 2]] = True
        basis = np.random.default_rng(4).standard_normal((TERMS, RANK + EXTRA)).astype(np.float32)
        for _ in range(2):
            basis = np.linalg.qr(basis)[0].astype(np.float32)
            product = gram(lists, self.idf, basis)
            small = basis.T @ product
            basis, last = product, basis
        values, inner = np.linalg.eigh((small + small.T) / 2)
        values, inner = np.maximum(values[::-1][:RANK], 1e-6), inner[:, ::-1][:, :RANK]
        latent = last @ inner
        rest = np.random.default_rng(5).standard_normal((TERMS, RANDOM))
        rest -= latent @ (latent.T @ rest)
        # Each direction has the same mass over the passages, whose rows have unit length.
        left = max(n - values.sum(), 1.0)
        vectors = self.idf[:, None] * np.concatenate([latent / np.sqrt(values), rest / np.sqrt(left)], 1)
        self.vectors = np.concatenate([vectors, np.zeros((1, WIDTH))]).astype(np.float32)


class Items:
    """A block of benchmark items with the latent vectors of their passages, by length class."""

    def __init__(self, rows: list, space: Space):
        self.items = []
        ids: list[list[int]] = [[] for _ in RUNS]
        vectors: list[list[np.ndarray]] = [[] for _ in RUNS]
        for item_id, text, answer in rows:
            words = word_hashes(text)
            if len(words) < LEAST:
                continue
            size, most = len(words), STEP * RUNS[-1]
            parts = [words[k : k + most] for k in range(0, max(1, size - most // 2), most)]
            for part in parts:
                group = int(np.argmin([abs(len(part) - STEP * r) for r in RUNS]))
                ids[group].append(len(self.items))
                vectors[group].append(space.vectors[terms(part)].sum(0))
            own = word_hashes(answer) if answer else words[-ANSWER:]
            self.items.append((item_id, words, space.idf[terms(words)], own, set(own.tolist())))
        self.ids = [np.array(x, int) for x in ids]
        self.vectors = [unit(np.array(x, np.float32).reshape(-1, WIDTH)) for x in vectors]
        self.sizes = np.array([len(x[1]) for x in self.items])
        self.marks = np.concatenate([np.zeros((0, 4), np.uint64), *(marks(terms(x[1]), np.zeros(1, int), space) for x in self.items)])
        self.bits = np.bitwise_count(self.marks).sum(1)
        self.weights = np.zeros((len(self.items), TERMS), np.float32)
        for k, (_, words, weight, _, _) in enumerate(self.items):
            self.weights[k, terms(words)] = weight
        self.totals = self.weights.sum(1)


def marks(own: np.ndarray, at: np.ndarray, space: Space) -> np.ndarray:
    """256 bits for each block of words that begins at ``at``: those of its terms that have at least the median weight."""
    bit = np.where(space.rare[own], np.uint64(1) << (own & 63).astype(np.uint64), np.uint64(0))
    word = (own >> 6) & 3
    return np.stack([np.bitwise_or.reduceat(np.where(word == k, bit, np.uint64(0)), at) for k in range(4)], 1)


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.sqrt(np.square(x).sum(-1, keepdims=True)), 1e-9)


def common_share(words: np.ndarray, weight: np.ndarray, text: np.ndarray) -> float:
    """Weight of the heaviest common subsequence of ``words`` and ``text``, of the weight of ``words``."""
    best = np.zeros(len(text) + 1, np.float32)
    for word, w in zip(words, weight, strict=True):
        grown = best.copy()
        np.maximum(best[1:], best[:-1] + w * (text == word), out=grown[1:])
        best = np.maximum.accumulate(grown)
    return float(best[-1] / max(weight.sum(), 1e-9))


def search(texts: list[np.ndarray], space: Space, items: Items) -> list[list[dict]]:
    """For each text, the items found in it."""
    sizes = np.array([-(-len(t) // STEP) for t in texts])
    first = np.cumsum(sizes) - sizes
    out: list[list[dict]] = [[] for _ in texts]
    if not sizes.sum() or not items.items:
        return out
    flat = np.concatenate(texts)
    begins = np.cumsum([0, *map(len, texts[:-1])])
    own = terms(flat)
    of = np.repeat(np.arange(len(texts)), sizes)
    at = begins[of] + (np.arange(len(of)) - first[of]) * STEP  # first word of each block
    # Blocks side by side, the last of each text filled up with a term that has no weight.
    filled = np.full(len(of) * STEP, TERMS, np.int32)
    filled[np.arange(len(flat)) + np.repeat(first * STEP - begins, [len(t) for t in texts])] = own
    filled = filled.reshape(-1, STEP)
    blocks = row_sums(space.vectors, filled)
    sums = np.concatenate([np.zeros((1, WIDTH)), np.cumsum(blocks, 0, dtype=float)])
    ends, stops = (first + sizes)[of], (begins + [len(t) for t in texts])[of]
    signs = {1: marks(own, at, space)}
    for run in RUNS + (2 * RUNS[-1],):  # of so many blocks from each on; those at the end of a text reach into the next
        half = signs[run // 2]
        signs[run] = half.copy()
        signs[run][: -run // 2] |= half[run // 2 :]
    for run, ids, vectors in zip(RUNS, items.ids, items.vectors, strict=True):
        if not len(ids):
            continue
        windows = unit((sums[np.minimum(np.arange(len(of)) + run, ends)] - sums[:-1]).astype(np.float32))
        around = signs[2 * run][np.maximum(np.arange(len(of)) - run // 2, 0)]
        for low in range(0, len(ids), 512):
            block, column = np.nonzero(windows @ vectors[low : low + 512].T >= COSINE)
            item = ids[low : low + 512][column]
            # An item longer than the surroundings can share a part of its terms only.
            least = SHARED * np.minimum(1, STEP * run * 2 / items.sizes[item])
            likely = np.bitwise_count(around[block] & items.marks[item]).sum(1) >= least * items.bits[item] - 1
            block, item, least = block[likely], item[likely], least[likely]
            # Weight of the item's terms in the window and half a window on either side.
            for k in np.flatnonzero(shares(own, at[block] - STEP * run // 2, 2 * STEP * run, begins[of[block]], stops[block], item, items) >= least):
                out_of, (item_id, words, weight, answer, answer_words) = of[block[k]], items.items[item[k]]
                low_word = max(at[block[k]] - len(words), begins[out_of])
                text = flat[low_word : min(at[block[k]] + STEP * run + len(words), stops[block[k]])]
                share = common_share(words, weight, text)
                answered = len(answer) and len(answer_words & set(text.tolist())) >= 0.8 * len(answer_words)
                if share >= STRONG or share >= WEAK and answered and common_share(answer, np.ones(len(answer)), text) >= 0.8:
                    out[out_of].append({"item_id": item_id, "share": share, "at": int(at[block[k]] - begins[out_of])})
    return [best_of(found) for found in out]


def shares(own: np.ndarray, at: np.ndarray, size: int, low: np.ndarray, high: np.ndarray, item: np.ndarray, items: Items) -> np.ndarray:
    """Weight of the distinct terms in the ``size`` words from ``at`` on, within ``low`` and ``high``, that the item has, of the item's weight."""
    found = np.zeros(len(at), np.float32)
    for k in range(0, len(at), 5_000):  # candidates of frequent passages are many
        part = slice(k, k + 5_000)
        near = at[part][:, None] + np.arange(size)[None, :]
        inside = (near >= low[part][:, None]) & (near < high[part][:, None])
        held = np.sort(np.where(inside, own[np.clip(near, 0, len(own) - 1)], -1), 1)
        fresh = np.ones(held.shape, bool)
        fresh[:, 1:] = held[:, 1:] != held[:, :-1]
        weight = items.weights[item[part][:, None], held] * (fresh & (held >= 0))
        found[part] = weight.sum(1) / np.maximum(items.totals[item[part]], 1e-9)
    return found


def best_of(found: list[dict]) -> list[dict]:
    best: dict[int, dict] = {}
    for x in found:
        if x["item_id"] not in best or x["share"] > best[x["item_id"]]["share"]:
            best[x["item_id"]] = x
    return list(best.values())


def leaks(text: Column, space: Space, rows: list) -> Column:
    """Benchmark items found in a text column, each once with its best share and the word it is near."""
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("share", pa.float64()), ("at", pa.int32())]))
    items = Items(rows, space)

    @F.arrow_udf(FOUND)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in released(batches):
            found = [x for texts in grouped(v.as_py() for v in batch) for x in search(texts, space, items)]
            yield pa.array(found, kind)

    return run(text)


def found_items(docs: DataFrame, benchmark: DataFrame) -> Column:
    """Items found in column ``text`` of ``docs``, as ``leaks`` gives them."""
    answer = F.col("answer").cast("string") if "answer" in benchmark.columns else F.lit(None).cast("string")
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"), answer.alias("answer")).where("text is not null")
    blocks = -(-items.count() // ITEMS)
    if not blocks:
        return F.array().cast(T._parse_datatype_string(FOUND))
    space = Space(docs)
    parts = []
    for k in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).orderBy("item_id", "text").collect()
        parts.append(leaks(F.col("text"), space, [tuple(r) for r in rows]))
    return parts[0] if len(parts) == 1 else F.concat(*parts)


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, item_id, share, at`` for each document and benchmark item found in it."""
    found = docs.select("doc_id", F.explode(found_items(docs, benchmark)).alias("leak"))
    return found.select("doc_id", "leak.item_id", "leak.share", "leak.at")


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows of ``docs`` in which no benchmark item is found."""
    return docs.where(F.size(found_items(docs, benchmark)) == 0)

"""Document quality from a linear-chain conditional random field over lines.

Each line is labelled good or bad by a two-state chain. Its potentials are linear in features of the line (character
classes, word shape, repetition inside the line and inside the document) and in the same features of the lines before
and after it. Forward-backward gives each line's marginal of being good; the mean of these over the lines, weighted by
their lengths, is put through a logistic calibration and is the document's score.

Training: up to ``SAMPLE`` labelled documents, taken in the order of a hash of doc_id from the rows whose
crc32(doc_id as text) mod 5 is not 0, each with its whole text, as long as they have ``CHARACTERS`` characters
together; one that would pass that is left out of the sample. That sample alone reaches the driver; its bound doesn't
depend on the corpus. A line starts with its document's label; then lines of bad documents that the
model finds good are relabelled, and the model is fitted again. Scores use nothing but the text.

Nulls and edge cases: null and empty texts are one empty line and get a score as any other; labels that are null or
belong to no document are left out, and so are documents with labels of both kinds; without labels of both kinds every score is 0.5. Repeated rows are scored each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veracity_prep.llm.shared import released

#: Bounds of the training sample: documents, and characters of all of them.
SAMPLE, CHARACTERS = 2_500, 8_000_000
#: Rounds of relabelling lines, gradient steps in each, weight decay.
ROUNDS, STEPS, DECAY = 1, 120, 1e-3
THRESHOLD = 0.3
#: Characters that are worked on at once.
BLOCK = 1 << 19

OWN = ("length", "upper", "lower", "digit", "mark", "symbol", "other", "word_length", "few_words", "distinct", "again", "marked", "seen", "end", "repeating")
#: Features of the neighbours: these of the line before and of the line after.
NEAR = ("upper", "symbol", "distinct", "again", "marked", "seen", "repeating")
FEATURES = 1 + len(OWN) + 2 * (1 + len(NEAR))


def character_classes() -> np.ndarray:
    """Class of each code point of the basic plane: 1 upper, 2 lower, 3 digit, 4 sentence mark, 5 symbol, 6 white space, 0 other."""
    classes = np.zeros(1 << 16, np.uint8)
    for c in range(1 << 16):
        x = chr(c)
        classes[c] = 1 if x.isupper() else 2 if x.islower() else 3 if x.isdigit() else 4 if x in ".,;:?'\"-()" else 6 if x.isspace() else 5 if c < 0x250 or 0x2000 <= c < 0x2E00 else 0
    return classes


_CLASSES: list[np.ndarray] = []


def line_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For the lines of all ``texts``: own features, lengths, and the number of lines of each text."""
    if not _CLASSES:
        _CLASSES.append(character_classes())
    lines, counts, extra = [], [], []
    for text in texts:
        own = text.split("\n")
        seen: set[str] = set()
        counts.append(len(own))
        for line in own:
            words = line.split()
            n = len(words) or 1
            again = sum(map(str.__eq__, words, words[1:]))
            marked = sum(not w[-1].isalnum() and not w[-2:-1].isalnum() for w in words)
            extra.append((len(line) / n / 10, 1 / n, len(set(words)) / n, again / n, marked / n, line in seen and len(line) > 20, line[-1:] in ".!?", again > 0.2 * n))
            seen.add(line)
        lines += own
    lengths = np.fromiter(map(len, lines), np.int64, len(lines))
    codes = np.frombuffer("\n".join([*lines, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    classes = _CLASSES[0][np.minimum(codes, 0xFFFF)]
    starts = np.cumsum(lengths + 1) - lengths - 1
    shares = np.stack([np.add.reduceat((classes == k).view(np.uint8), starts, dtype=np.int64) for k in (1, 2, 3, 4, 5, 0)], 1) / np.maximum(lengths, 1)[:, None]
    own = np.concatenate([np.log1p(lengths)[:, None] / 5, shares, np.array(extra, float)], 1)
    return own, lengths, np.array(counts)


def with_neighbours(own: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Bias, own features, and features of the lines before and after within the text."""
    columns = [OWN.index(n) for n in NEAR]
    near = np.concatenate([np.ones((len(own), 1)), own[:, columns]], 1)
    first = np.cumsum(counts) - counts
    before, after = np.roll(near, 1, 0), np.roll(near, -1, 0)
    before[first] = 0
    after[first + counts - 1] = 0
    return np.concatenate([np.ones((len(own), 1)), own, before, after], 1)


def marginals(score: np.ndarray, counts: np.ndarray, stay: np.ndarray) -> np.ndarray:
    """P(good) of each line; ``score`` is the log-odds of good, ``stay`` the transition potentials (2 by 2), of a chain for each text.

    Chains advance side by side: step k works on the k-th line of all texts that have one.
    """
    pull = np.exp(np.clip(stay, -8, 8))
    good = 1 / (1 + np.exp(-np.clip(score, -30, 30)))
    local = np.stack([1 - good, good], 1)
    first = np.cumsum(counts) - counts
    order = np.argsort(-counts, kind="stable")
    first, counts = first[order], counts[order]
    alive = np.searchsorted(-counts, -np.arange(1, counts[0] + 1), side="right")
    forward, backward = local.copy(), np.ones_like(local)
    # While many texts have a k-th line, all of them take step k together; the tails of the few longest go on alone.
    for k in range(1, counts[0]):
        at = first[: alive[k]] + k
        step = (forward[at - 1] @ pull) * local[at]
        forward[at] = step / step.sum(1, keepdims=True)
    for k in range(counts[0] - 2, -1, -1):
        at = first[: alive[k + 1]] + k
        step = (backward[at + 1] * local[at + 1]) @ pull.T
        backward[at] = step / step.sum(1, keepdims=True)
    both = forward * backward
    return both[:, 1] / both.sum(1)


class Model:
    """Weights of the chain and of the calibration."""

    def __init__(self, weights: np.ndarray, stay: np.ndarray, calibration: tuple[float, float]):
        self.weights, self.stay, self.calibration = weights, stay, calibration

    def means(self, texts: list[str]) -> np.ndarray:
        """Length-weighted mean of the marginals of each text's lines."""
        own, lengths, counts = line_features(texts)
        p = marginals(with_neighbours(own, counts) @ self.weights, counts, self.stay)
        first = np.cumsum(counts) - counts
        weight = lengths + 1.0
        return np.add.reduceat(p * weight, first) / np.add.reduceat(weight, first)

    def scores(self, texts: list[str]) -> np.ndarray:
        if self.weights is None:
            return np.full(len(texts), 0.5)
        a, b = self.calibration
        return 1 / (1 + np.exp(-(a * log_odds(self.means(texts)) + b)))


def log_odds(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def chain_gradient(x: np.ndarray, y: np.ndarray, counts: np.ndarray, weights: np.ndarray, stay: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradient of the conditional log-likelihood for line labels ``y``: observed less expected features and transitions."""
    score = x @ weights
    pull = np.exp(stay)
    good = 1 / (1 + np.exp(-np.clip(score, -30, 30)))
    local = np.stack([1 - good, good], 1)
    first = np.cumsum(counts) - counts
    forward, backward = local.copy(), np.ones_like(local)
    for k in range(1, counts.max()):
        at = first[counts > k] + k
        step = (forward[at - 1] @ pull) * local[at]
        forward[at] = step / step.sum(1, keepdims=True)
    for k in range(counts.max() - 2, -1, -1):
        at = first[counts > k + 1] + k
        step = (backward[at + 1] * local[at + 1]) @ pull.T
        backward[at] = step / step.sum(1, keepdims=True)
    both = forward * backward
    p = both[:, 1] / both.sum(1)
    inner = np.ones(len(x), bool)
    inner[first] = False
    right = np.flatnonzero(inner)
    joint = forward[right - 1][:, :, None] * pull[None] * (local[right] * backward[right])[:, None, :]
    joint /= joint.sum((1, 2), keepdims=True)
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[right - 1].astype(int), y[right].astype(int)), 1)
    return x.T @ (y - p), seen - joint.sum(0)


def ascend(gradient, parameters: list[np.ndarray], size: int, steps: int, rate: float = 0.1) -> list[np.ndarray]:
    """Adam on a concave objective with weight decay."""
    m, v = [np.zeros_like(p) for p in parameters], [np.zeros_like(p) for p in parameters]
    for t in range(1, steps + 1):
        for k, g in enumerate(gradient(*parameters)):
            g = g / size - DECAY * parameters[k]
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.99 * v[k] + 0.01 * g * g
            parameters[k] = parameters[k] + rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.99**t)) + 1e-8)
    return parameters


def fit(texts: list[str], labels: np.ndarray) -> Model:
    """The model of a bounded list of texts (0 bad, 1 good)."""
    if len(set(labels.tolist())) < 2:
        return Model(None, None, (1.0, 0.0))
    own, lengths, counts = line_features(texts)
    x, of_text = with_neighbours(own, counts), np.repeat(np.arange(len(texts)), counts)
    y = labels[of_text].astype(float)
    weights, stay = np.zeros(x.shape[1]), np.zeros((2, 2))
    first, weight = np.cumsum(counts) - counts, lengths + 1.0
    for _ in range(1 + ROUNDS):
        weights, stay = ascend(lambda w, s: chain_gradient(x, y, counts, w, s), [weights, stay], len(x), STEPS)
        p = marginals(x @ weights, counts, stay)
        # A bad document keeps at least its worst line as bad.
        worst = np.minimum.reduceat(p, first)[of_text]
        y = np.where(labels[of_text] == 1, 1.0, (p > 0.8) & (p > worst + 1e-9)).astype(float)
    z = log_odds(np.add.reduceat(p * weight, first) / np.add.reduceat(weight, first))
    design = np.stack([z, np.ones_like(z)], 1)
    (calibration,) = ascend(lambda c: [design.T @ (labels - 1 / (1 + np.exp(-design @ c)))], [np.array([1.0, 0.0])], len(z), 600, 0.05)
    return Model(weights, stay, (float(max(calibration[0], 0.05)), float(calibration[1])))


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % 5 == 0


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Fits on the bounded sample; a broadcast of at most ``SAMPLE`` labels picks its documents, by their lengths first."""
    usable = labels.select(F.col("doc_id").cast("long"), "quality").where("doc_id is not null and quality in (0, 1)").where(~held_out(F.col("doc_id")))
    agreed = usable.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("other")).where("quality = other").drop("other")
    picked = agreed.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(picked), "doc_id")
    # Repeated rows of a document count with all their characters.
    lengths = texts.groupBy("doc_id").agg(F.sum(F.length("text") + 1).alias("size")).orderBy(F.xxhash64("doc_id"), "doc_id").collect()
    chosen, held = [], 0
    for row in lengths:
        if held + row["size"] <= CHARACTERS:
            held += row["size"]
            chosen.append((row["doc_id"],))
    wanted = docs.sparkSession.createDataFrame(chosen, "doc_id long")
    rows = texts.join(F.broadcast(wanted), "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", "text").select("text", "quality").collect()
    return fit([r.text for r in rows], np.array([r.quality for r in rows], float))


def score(text: Column, model: Model) -> Column:
    """Quality of a text column between 0 and 1."""

    @F.arrow_udf("double")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in released(batches):
            found, held, size = [np.zeros(0)], [], 0
            for value in batch:
                held.append(value.as_py() or "")
                size += len(held[-1])
                if size > BLOCK:
                    found.append(model.scores(held))
                    held, size = [], 0
            if held:
                found.append(model.scores(held))
            yield pa.array(np.concatenate(found), pa.float64())

    return run(text)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """For each row of ``docs``: doc_id, held_out, score, predicted (1 from ``THRESHOLD`` on)."""
    model = train(docs, labels)
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score(F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0))


def keep_good(docs: DataFrame, labels: DataFrame, name: str) -> DataFrame:
    """Rows of ``docs`` that aren't rejected, with the columns of ``docs``; ``name`` is a column name that ``docs`` hasn't."""
    model = train(docs, labels)
    return docs.withColumn(name, score(F.col("text"), model)).where(F.col(name) >= THRESHOLD).drop(name)

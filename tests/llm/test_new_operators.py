"""Manifest trees, hard negatives and the inverted multi-index against brute force."""

import math
import random
import zlib
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from veracity_prep.llm import hard_negatives, merkle, multi_index, queries

DOCUMENT = "doc_id long, source string, lang string, n_chars long, text string"


def h(text):
    return sha256(text.encode()).hexdigest()


def plain_leaf(row):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def plain_tree(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([h("".join(last[k : k + 3])) for k in range(0, len(last), 3)])
    return levels


def plain_path(levels, at):
    out = []
    for nodes in levels[:-1]:
        low = at // 3 * 3
        out.append((nodes[low:at], nodes[at + 1 : low + 3]))
        at //= 3
    return out


def plain_manifest(rows):
    trees = {}
    for row in rows:
        trees.setdefault(row[1], []).append((row[0] is not None, row[0] or 0, plain_leaf(row), row))
    names = sorted(trees, key=lambda n: (n is not None, (n or "").encode()))
    levels = {n: plain_tree([x[2] for x in sorted(trees[n], key=lambda x: x[:3])]) for n in names}
    top = plain_tree([levels[n][-1][0] for n in names])
    out = []
    for place, name in enumerate(names):
        for at, (_, _, leaf, row) in enumerate(sorted(trees[name], key=lambda x: x[:3])):
            path = plain_path(levels[name], at) + plain_path(top, place)
            folded = leaf
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0 and row[4] is not None:
                folded = plain_leaf((*row[:4], row[4].replace("\n", "")))
            for left, right in path:
                folded = h("".join([*left, folded, *right]))
            proof = h("".join("".join(a + b) for a, b in path))
            out.append((row[0], leaf, levels[name][-1][0], top[-1][0], proof, folded, folded == top[-1][0]))
    return sorted(map(repr, out))


def merkle_digests(docs):
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    return merkle.digests(docs, tampered, ("text", F.replace("text", F.lit("\n"), F.lit(""))))


def test_manifest_equals_brute_force(spark):
    rng = random.Random(2)
    # One tree above a block of leaves and three above a run; names whose order is that of their bytes.
    rows = [(k, "big", "en", k % 7, f"t{k}\nx" if k % 3 else f"t{k}") for k in range(-10, 5000)]
    rows += [(k, rng.choice(["a", "b", "é", "Z", "", None, "\U0001f600", "￿"]), None, None, "ü\n" * (k % 5)) for k in range(6000, 6060)]
    rows += [(7000, "one", "x", 1, "only\n"), (7001, "nulls", None, None, None), (None, None, None, None, None), (None, "big", None, 3, "\n"), (5, "big", "other", 1, "second\n"), (6000, "a", "en", 1, "long\n" * 200_000)]
    rows += [(7000, "one", "x", 1, "only\n")] * 2
    docs = spark.createDataFrame(rows, DOCUMENT).withColumn("leaf", F.lit("clash")).withColumn("tree", F.lit(1)).repartition(5)
    assert sorted(repr(tuple(r)) for r in merkle_digests(docs).collect()) == plain_manifest(rows)


def test_versions_share_all_untouched_nodes(spark):
    docs = spark.createDataFrame([(k, "ab"[k % 2], "en", 1, f"{k}\n") for k in range(4600)], DOCUMENT)
    made = merkle.manifest(docs, tampered=F.col("doc_id") % 1000 == 3, tampered_field=("text", F.lit("new")))
    base = {(r.top, r.tree, r.level, r.position): r.digest for r in made.nodes.collect()}
    leaves = {(r.source if "source" in r else r.tree, r.position): r for r in made.leaves.collect()}
    assert len([k for k in base if k[0]]) == 1
    for (tree, position), leaf in leaves.items():
        assert (leaf.copied is None) == (leaf.doc_id % 1000 != 3) and leaf.verified == (leaf.copied is None)
        if leaf.copied is None:
            continue
        # Each copy is made of the copy below and of nodes of the first version.
        own, at = plain_leaf((leaf.doc_id, tree, "en", 1, "new")), position
        for level, copy in enumerate(leaf.copied[:-1]):
            low = at // 3 * 3
            run = [leaves[tree, k].leaf if level == 0 else base[False, tree, level, k] for k in range(low, low + 3) if ((tree, k) in leaves if level == 0 else (False, tree, level, k) in base)]
            run[at - low] = own
            own, at = h("".join(run)), at // 3
            assert own == copy and base[False, tree, level + 1, at] != own
        assert h("".join([own, leaves["b", 0].subroot] if tree == "a" else [leaves["a", 0].subroot, own])) == leaf.copied[-1] == leaf.folded_root


def test_manifest_of_nothing_and_of_one(spark):
    none = spark.createDataFrame([], DOCUMENT)
    assert merkle_digests(none).count() == 0
    (one,) = merkle_digests(spark.createDataFrame([(1, "s", None, None, None)], DOCUMENT)).collect()
    assert one.leaf == one.subroot == one.root == one.folded_root and one.proof_sha256 == h("") and one.verified


def usable_vectors(rows):
    return [(k, v, label) for k, v, label in rows if k is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]


def plain_negatives(rows):
    rows = [(k, [int(np.floor(x * 256)) if abs(x) < 2**45 else int(x) * 256 for x in v], label) for k, v, label in usable_vectors(rows) if label is not None]
    limit = 2**63 - 1
    out = []
    for a, anchor, mine in rows:
        if a % 50:
            continue
        scored = sorted((-max(-limit, min(limit, sum(x * y for x, y in zip(anchor, v, strict=True)))), k, label) for k, v, label in rows if k != a and len(v) == len(anchor))
        for s, p, _ in [x for x in scored if x[2] == mine][:5]:
            found = [(n, score) for score, n, label in scored if label != mine and 50 * -s <= 100 * -score <= 95 * -s]
            out += [(a, p, r + 1, n, -s, -score) for r, (n, score) in enumerate(found[:3])]
    return sorted(out)


@pytest.mark.parametrize("dim", [1, 8, 21])
def test_hard_negatives_equal_brute_force(spark, dim):
    rng = np.random.default_rng(dim)
    rows = [(k, [float(x) for x in rng.normal(size=dim).round(1)], int(rng.integers(0, 4))) for k in range(400)]
    rows += [(400, None, 1), (450, [float("nan")] * dim, 1), (500, [None] * dim, 1), (None, rows[0][1], 1), (550, rows[3][1], None), (600, [float("inf")] * dim, 2)]
    rows += [(650, [], 1), (651, [], 1), (652, [], 2), (700, [1.0] * 30, 1), (701, [2.0] * 30, 1), (702, [1.5] * 30, 2)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("score", F.lit(0)).withColumn("row", F.lit(0)).repartition(3)
    got = hard_negatives.hard_negatives(vectors, F.col("vec_id") % 50 == 0)
    assert sorted(map(tuple, got.collect())) == plain_negatives(rows)
    assert {650} <= {r.anchor_id for r in got.collect()}


@pytest.mark.parametrize("size", [1e3, 1e9, 1e12, 1e300])
def test_scores_of_large_components_are_exact(spark, size):
    rng = np.random.default_rng(4)
    rows = [(k, [float(x) for x in rng.normal(size=9) * size], k % 2) for k in range(120)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label long")
    got = hard_negatives.hard_negatives(vectors, F.col("vec_id") % 50 == 0).collect()
    assert sorted(map(tuple, got)) == plain_negatives(rows)


def test_repeated_anchors_and_no_vectors(spark):
    rows = [(0, [1.0, 1.0], 1), (0, [1.0, 1.0], 1), (1, [1.0, 1.0], 1), (2, [0.5, 1.0], 2)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = hard_negatives.hard_negatives(vectors, F.col("vec_id") % 50 == 0)
    assert [tuple(r) for r in got.collect()] == [(0, 1, 1, 2, 131072, 98304)] * 2
    assert hard_negatives.hard_negatives(vectors.limit(0), F.lit(True)).count() == 0
    assert hard_negatives.hard_negatives(vectors, F.lit(False)).count() == 0


def plain_nearest(rows, every, k=10):
    rows = [(i, np.array(v, float)) for i, v, _ in usable_vectors(rows) if any(v)]
    out = {}
    for q, x in rows:
        if q % every == 0:
            with np.errstate(over="ignore"):
                plain = [(float(np.sqrt(np.square(x - y).sum())), i, y) for i, y in rows if i != q and len(y) == len(x)]
            found = sorted((d if np.isfinite(d) else math.dist(x, y), i) for d, i, y in plain)
            out[q] = [(i, d) for d, i in found[:k]]
    return out


def test_few_vectors_are_ranked_whole(spark):
    rng = np.random.default_rng(8)
    rows = [(k, [float(x) for x in rng.normal(size=5).round(1)], 0) for k in range(350)]
    rows += [(400, None, 1), (500, [float("nan")] * 5, 1), (600, [None] * 5, 1), (None, rows[0][1], 1), (700, [0.0, -0.0, 0.0, 0.0, 0.0], 1), (800, [], 1), (900, [float("inf")] * 5, 1)]
    rows += [(1000, [3.0], 1), (1001, [4.0], 1), (1002, [1e200], 1), (1100, [1e200] * 5, 1), (1101, [-1e200] * 5, 1), (1200, rows[7][1], 1), (1201, rows[7][1], 1)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("row", F.lit(0)).withColumn("cell", F.lit(0)).repartition(3)
    got = {}
    for r in sorted(multi_index.nearest(vectors, F.col("vec_id") % 100 == 0).collect(), key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(got[r.query_id])
    want = plain_nearest(rows, 100)
    assert got.keys() == want.keys() == {0, 100, 200, 300, 1000, 1100, 1200}
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]]
        assert np.allclose([d for _, d in got[q]], [d for _, d in want[q]], rtol=1e-15, atol=0)
    # The squares of these pass the range of a double, the distances do not.
    assert got[1100][-1][0] == 9 and np.allclose([d for _, d in got[1100]], 5**0.5 * 1e200)
    assert multi_index.nearest(vectors.limit(0), F.lit(True)).count() == 0


def test_every_row_is_indexed_and_walks_go_outwards():
    rng = np.random.default_rng(5)
    first, second = rng.random(40), rng.random(30)
    counts = rng.integers(0, 3, multi_index.CODES**2).tolist()
    cells = multi_index.walk(first, second, counts, 1 << 40)
    i, j = np.array(cells) // multi_index.CODES, np.array(cells) % multi_index.CODES
    assert (np.diff(first[i] + second[j]) >= 0).all()
    assert sorted(cells) == [c for a in range(40) for b in range(30) if counts[c := a * multi_index.CODES + b]]
    short = multi_index.walk(first, second, counts, 50)
    assert short == cells[: len(short)] and sum(counts[c] for c in short) >= 50 > sum(counts[c] for c in short[:-1])


def test_recall_and_a_cell_with_a_third_of_all_rows(spark):
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(10, 24))
    values = (centres[rng.integers(0, 10, 9000)] + rng.normal(size=(9000, 24))).round(3)
    values[rng.permutation(9000)[:3000]] = values[1]
    rows = [(k, v.tolist(), 0) for k, v in enumerate(values)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(4)
    got = {}
    for r in multi_index.nearest(vectors, F.col("vec_id") % 100 == 0).collect():
        got.setdefault(r.query_id, {})[r.vec_id] = r.score
    want = plain_nearest(rows, 100)
    assert got.keys() == want.keys() and all(len(g) == 10 for g in got.values())
    # Equal distances to the copies: what counts is how near the found ones are.
    near = [d <= want[q][-1][1] * (1 + 1e-12) for q, g in got.items() for d in g.values()]
    assert np.mean(near) >= 0.9
    for q, g in got.items():
        assert all(abs(d - np.sqrt(np.square(values[q] - values[i]).sum())) < 1e-12 for i, d in g.items())


def test_recall_on_the_test_table(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, r.embedding, 0) for r in vectors.collect()]
    got = {}
    for r in queries.op13_multi_index(spark, "/root/testdata/sf0.1").collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    want = plain_nearest(rows, 100)
    assert got.keys() == want.keys()
    assert np.mean([len(got[q] & {i for i, _ in want[q]}) / 10 for q in want]) >= 0.9

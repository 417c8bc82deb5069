"""Operators that compare documents with each other, and the pipeline."""

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from veracity_prep.llm import decontaminate, licences, near_dedup, substring_dedup, topk

SMALL = "/root/testdata/sf0.001"
WORDS = [a + b for a in "ba ce di fo gu ha je ki lo mu".split() for b in "ra se ti vo nu pa le mi no ku".split()]


def prose(rng, n):
    return [rng.choice(WORDS) + rng.choice(WORDS) for _ in range(n)]


def noisy(rng, words, share):
    return [rng.choice(WORDS) if rng.random() < share else w for w in words]


def plain_sets(rows, size):
    out = {}
    for doc_id, text in rows:
        words = (text or "").encode().lower().split()
        out[doc_id] = {tuple(words[k : k + size]) for k in range(max(1, len(words) - size + 1))} if words else set()
    return out


def plain_components(sets, percent):
    ids, parent = sorted(sets), {k: k for k in sets}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            common = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                x, y = top(a), top(b)
                parent[max(x, y)] = min(x, y)
    return {k: top(k) for k in ids}


def test_near_duplicates_equal_brute_force(spark):
    rng = random.Random(4)
    base, other = prose(rng, 150), prose(rng, 60)
    texts = [" ".join(noisy(rng, base, rng.choice((0.01, 0.04, 0.06, 0.1)))) for _ in range(90)]
    texts += [" ".join(noisy(rng, other, 0.03)) for _ in range(25)] + [" ".join(prose(rng, rng.randint(1, 40))) for _ in range(40)]
    texts += ["", None, " \n", "one", "ONE", "one two", "one two", "one two three", "É x", "é x"] + [" ".join(base)] * 6
    rows = list(enumerate(texts))
    docs = spark.createDataFrame([(k, t, 1) for k, t in rows], "doc_id long, text string, component_id int")
    for size in (2, 5):
        sets = plain_sets(rows, size)
        want = plain_components(sets, 80)
        got = near_dedup.near_duplicates(docs, size).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == {k: (len(sets[k]), want[k], want[k] == k) for k in want}


def test_near_duplicate_edge_rows(spark):
    docs = spark.createDataFrame([(None, "a b c"), (4, "a b c"), (4, "a b c"), (2, "A B C"), (None, None)], "doc_id long, text string")
    got = sorted((str(r.doc_id), str(r.component_id), r.kept) for r in near_dedup.near_duplicates(docs, 2).collect())
    assert got == [("2", "2", True), ("4", "2", False), ("4", "2", False), ("None", "None", True), ("None", "None", True)]
    assert near_dedup.near_duplicates(docs.limit(0), 2).count() == 0
    assert sorted(str(r.doc_id) for r in near_dedup.one_of_each(docs).collect()) == ["2", "None", "None"]


def test_one_id_with_several_texts(spark):
    rng = random.Random(12)
    one, seven, far = (" ".join(prose(rng, 60)) for _ in range(3))
    near = " ".join(noisy(rng, seven.split(), 0.02))
    rows = [(1, one), (5, one.upper()), (5, seven), (7, near), (9, far), (9, ""), (10, "alone here"), (11, None), (11, " "), (9, far), (12, far), (20, "p q"), (20, "r s"), (21, "p q"), (22, "r s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("place", F.lit(3)).repartition(4)
    got = near_dedup.near_duplicates(docs, 2).collect()
    assert len(got) == len(rows)
    want = {1: 1, 5: 1, 7: 1, 9: 9, 10: 10, 11: 11, 12: 9, 20: 20, 21: 20, 22: 20}
    assert {(r.doc_id, r.component_id, r.kept) for r in got} == {(k, c, k == c) for k, c in want.items()}
    assert sorted(map(tuple, near_dedup.one_of_each(docs, 2).collect()), key=str) == sorted([(1, one, 3), (9, "", 3), (10, "alone here", 3), (11, " ", 3), (20, "p q", 3)], key=str)


def test_registers_merge_and_estimate():
    rng = np.random.default_rng(1)
    a, b = (np.unique(rng.integers(0, 1 << 63, 900, dtype=np.uint64)) for _ in range(2))
    left, right = np.union1d(a, b[:450]), np.union1d(a[450:], b)
    ra, rb, both = near_dedup.registers([left, right, np.union1d(left, right)])
    assert (near_dedup.merge(ra, rb) == both).all()
    import pyarrow as pa

    batch = lambda x, y, nx, ny: pa.RecordBatch.from_arrays([pa.array([x.tobytes()]), pa.array([y.tobytes()]), pa.array([nx]), pa.array([ny])], names=["ka", "kb", "na", "nb"])
    assert not near_dedup.within_reach(batch(ra, rb, len(left), len(right)), 80)[0]
    more = np.union1d(left, b[450:550])
    assert near_dedup.within_reach(batch(ra, near_dedup.registers([more])[0], len(left), len(more)), 80)[0]


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 90), (100, 95)], "a long, b long")
    got = {r.id: r.component for r in near_dedup.components(links).collect()}
    assert got == {**dict.fromkeys(range(41), 0), 100: 90, 95: 90, 90: 90}


def test_planted_benchmark_passages(spark):
    rng = random.Random(6)
    items = [(k, " ".join(prose(rng, rng.randint(12, 70)))) for k in range(30)] + [(98, None), (99, "too short")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    rows, want = [], set()
    for k in range(300):
        words = prose(rng, rng.randint(1, 400))
        if k % 3 == 0:
            item = items[rng.randrange(30)]
            planted = item[1].split()
            if k % 2:
                planted = noisy(rng, planted, 0.1)
            at = rng.randrange(len(words) + 1)
            words[at:at] = [w.upper() + "," for w in planted]
            want.add((k, item[0]))
        rows.append((k, " ".join(words), 0))
    docs = spark.createDataFrame([*rows, (None, items[0][1], 0), (900, "", 0), (901, None, 0)], "doc_id long, text string, item_id int")
    got = decontaminate.contaminated(docs, benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want | {(None, 0)}
    clean = decontaminate.clean(docs, benchmark)
    assert clean.columns == docs.columns and {r.doc_id for r in clean.collect()} == ({k for k in range(300)} | {900, 901}) - {k for k, _ in want}
    assert decontaminate.contaminated(docs, benchmark.limit(0)).count() == 0
    assert decontaminate.contaminated(docs.limit(0), benchmark).count() == 0


def test_latent_space_has_every_passage(spark):
    rng = random.Random(12)
    texts = [" ".join(prose(rng, n)) for n in (1, 32, 33, 900, 5_000)]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate([*texts, "", None])], "doc_id long, text string")
    rows = []
    for text in texts:
        own = decontaminate.terms(decontaminate.word_hashes(text))
        rows += [np.bincount(own[k : k + 32], minlength=decontaminate.TERMS) for k in range(0, len(own), 32)]
    counts = np.array(rows)
    lists = decontaminate.term_lists(docs)
    frequencies, n = decontaminate.document_frequencies(lists)
    assert n == len(rows) and (frequencies == (counts > 0).sum(0)).all()
    idf = (np.log((n + 1) / (frequencies + 1)) + 0.05).astype(np.float32)
    unit = counts * idf / np.sqrt((counts * np.square(idf)).sum(1))[:, None]
    vectors = np.random.default_rng(3).standard_normal((decontaminate.TERMS, 5))
    assert np.allclose(decontaminate.gram(lists, idf, vectors), unit.T @ (unit @ vectors), atol=1e-3)


def test_sums_over_rare_terms_cost_less_than_a_call_a_term():
    draw = np.random.default_rng(5)
    part = draw.integers(0, decontaminate.TERMS + 1, (1_000, decontaminate.PASSAGE)).astype(np.uint16)
    y = draw.standard_normal((1_000, 32)).astype(np.float32)

    def by_runs():
        flat, total = part.ravel(), np.zeros((decontaminate.TERMS + 1, 32))
        order = np.argsort(flat, kind="stable")
        cuts = np.flatnonzero(np.diff(flat[order], prepend=np.uint16(decontaminate.TERMS + 1)))
        total[flat[order][cuts]] += np.add.reduceat(y.astype(float)[order // decontaminate.PASSAGE], cuts, 0)
        return total

    def seconds(run):
        start = time.process_time()
        run()
        return time.process_time() - start

    assert np.allclose(decontaminate.term_sums(part, y), by_runs().T)
    assert min(seconds(lambda: decontaminate.term_sums(part, y)) for _ in range(5)) < 0.7 * min(seconds(by_runs) for _ in range(5))


def test_repeated_passages(spark):
    rng = random.Random(9)
    passages = [" ".join(prose(rng, 70)) for _ in range(5)]
    rows = []
    for k in range(120):
        parts = [" ".join(prose(rng, rng.randint(5, 120)))]
        if k % 4 == 0:
            parts += ["É" * rng.randint(1, 9) + passages[k % 5], " ".join(prose(rng, rng.randint(1, 60)))]
        rows.append((k, " ".join(parts)))
    docs = spark.createDataFrame([*rows, (500, None), (501, ""), (None, passages[0]), rows[0]], "doc_id long, text string").withColumn("start", F.lit(1))
    got = substring_dedup.repeats(docs).collect()
    texts = dict(rows)
    first = {p: min(k for k in range(0, 120, 4) if k % 5 == p) for p in range(5)}
    assert {r.doc_id for r in got} == {k for k in range(0, 120, 4) if k != first[k % 5]}
    for r in got:
        assert texts[r.doc_id][r.start : r.end] in texts[r.keeper_id] and r.end - r.start >= substring_dedup.RUN
    cut = {r.doc_id: r.text for r in substring_dedup.without_repeats(docs).where("doc_id < 120").collect()}
    assert all(cut[k] == texts[k] for k in texts if k not in {r.doc_id for r in got})
    for r in got:
        assert len(cut[r.doc_id]) == len(texts[r.doc_id]) - sum(x.end - x.start for x in got if x.doc_id == r.doc_id)
    assert substring_dedup.repeats(docs.limit(0)).count() == 0


def test_cuts_move_with_the_content():
    rng = random.Random(3)
    data = " ".join(prose(rng, 4000)).encode()
    shifted = b"inserted words " + data
    ends, moved = set(substring_dedup.chunk_ends(data).tolist()), {e - 15 for e in substring_dedup.chunk_ends(shifted).tolist()}
    assert len(ends & moved) > 0.97 * len(ends)
    whole = substring_dedup.chunk_ends(("ü" * 3000).encode())
    assert (whole % 2 == 0).all() and whole[-1] == 6000


@pytest.mark.parametrize("dim", [8, 40])
def test_top_k_equals_brute_force(spark, dim):
    rng = np.random.default_rng(dim)
    rows = [(k, [float(x) for x in rng.normal(size=dim).round(1)]) for k in range(300)]
    rows += [(300, None), (301, [float("nan")] * dim), (302, [None] * dim), (303, []), (None, rows[0][1]), (304, rows[20][1]), (320, [1.0] * 3), (340, [2.0] * 3)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit(0))
    want = set()
    usable = {k: np.floor(64 * np.float32(v).astype(float)).astype(int) for k, v in rows if k is not None and v and None not in v and not np.isnan(v).any()}
    for q in usable:
        if q % 20 == 0:
            scored = sorted((-int(usable[q] @ v), k) for k, v in usable.items() if k != q and len(v) == len(usable[q]))[:20]
            want |= {(q, n + 1, k, -s) for n, (s, k) in enumerate(scored)}
    got = topk.top_k(vectors, F.col("vec_id") % 20 == 0).collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want)
    assert topk.top_k(vectors.limit(0), F.lit(True)).count() == 0


@pytest.mark.parametrize("size", [1e3, 1e6, 1e9, 1e300])
def test_top_k_of_large_components(spark, size):
    rng = np.random.default_rng(3)
    rows = [(k, [float(x) for x in rng.normal(size=6) * (size if k % 3 else 1)]) for k in range(90)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    whole = {k: [int(x) * 64 if abs(x) > 2**53 else int(np.floor(x * 64)) for x in v] for k, v in rows}
    limit, want = 2**63 - 1, set()
    for q in range(0, 90, 20):
        scored = sorted((-max(-limit, min(limit, sum(x * y for x, y in zip(whole[q], v, strict=True)))), k) for k, v in whole.items() if k != q)[:20]
        want |= {(q, n + 1, k, -s) for n, (s, k) in enumerate(scored)}
    assert {tuple(r) for r in topk.top_k(vectors, F.col("vec_id") % 20 == 0).collect()} == want


def test_licences_and_inheritance(spark):
    notice = "Licensed under the Apache License, Version 2.0."
    rows = [
        (1, "a/LICENSE", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction"),
        (2, "a/b/c/x.txt", "plain words"), (3, "a/b/y.txt", "plain words\n" * 9 + notice), (4, "d/z.txt", None), (5, None, notice), (6, "a/b/COPYING", "This work is licensed under the GNU General Public License, version 3."),
        (7, "a/q.txt", ""), (8, "d/w.txt", "my driving licence was lost"), (8, "d/w.txt", "my driving licence was lost"),
    ]
    files = spark.createDataFrame(rows, "id long, path string, text string").withColumn("licence", F.lit("clash"))
    got = {r.id: (r.licence, r.basis) for r in licences.licences(files).collect()}
    assert got == {1: ("MIT", "own"), 2: ("GPL-3.0", "inherited"), 3: ("Apache-2.0", "own"), 4: (None, None), 5: ("Apache-2.0", "own"), 6: ("GPL-3.0", "own"), 7: ("MIT", "inherited"), 8: (None, None)}
    assert licences.licences(files).count() == len(rows) and licences.licences(files.limit(0)).count() == 0


def test_whole_licence_files_and_inheritance_over_two_levels(spark):
    texts = {r.licence: r.notice for r in licences.templates(spark).where("length(notice) > 900").collect()}
    assert {"Apache-2.0", "MIT", "BSD-3-Clause", "GPL-2.0", "GPL-3.0", "LGPL-3.0", "MPL-2.0", "CC0-1.0"} <= set(texts)
    rows = []
    for name, text in texts.items():
        rows += [(name, f"{name}/LICENSE", "Copyright (c) 2021 Some One Else\n\n" + " ".join(text.split())), (name, f"{name}/a/b/x.txt", "plain words")]
    got = licences.licences(spark.createDataFrame(rows, "id string, path string, text string")).collect()
    assert {(r.id, r.licence, r.basis) for r in got} == {(k, k, basis) for k in texts for basis in ("own", "inherited")} and len(got) == len(rows)


def test_notice_terms_outside_templates_have_their_frequency(spark):
    # The same foreign words beside each notice say little, so they don't hide the licence.
    rows = [(k, f"f{k}/x.txt", "Released under the MIT License. qaa qbb qcc qdd qee\n" + "plain words\n" * 20) for k in range(200)]
    got = licences.licences(spark.createDataFrame(rows, "id long, path string, text string")).collect()
    assert {r.licence for r in got} == {"MIT"}


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    odd = spark.createDataFrame([(9001, None, None, None, None), (None, "", "en", "s", 0)], docs.schema)
    docs = docs.unionByName(odd).unionByName(docs.limit(3)).withColumn("score", F.lit(1))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SMALL)
        assert out.columns == docs.columns, name
        path = f"file://{tmp_path}/{name}"
        out.write.parquet(path)
        docs = spark.read.parquet(path)
    ids = [r.doc_id for r in docs.collect()]
    assert len(ids) == len(set(ids)) and 100 < len(ids) < 200
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL)
    assert last.count() == len(ids) and {"doc_id", "n_tokens", "token_ids"} <= set(last.columns)

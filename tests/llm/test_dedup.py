"""Operators 6, 7 and 8 against brute force."""

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from opslake.llm import op6_repeats, op7_jaccard, op8_embeddings
from opslake.llm.common import labelled, merged

SCHEMA = "doc_id long, text string"


def brute_removed(texts: dict[int, str | None]) -> dict[int, tuple]:
    out, earlier = {}, set()
    for i in sorted(texts):
        raw = (texts[i] or "").encode()
        windows = [raw[p : p + 50] for p in range(len(raw) - 49)]
        gone = np.zeros(len(raw), bool)
        for p, w in enumerate(windows):
            if w in earlier:
                gone[p : p + 50] = True
        earlier.update(windows)
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        out[i] = (len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return out


def sets(text):
    w = [x.decode() for x in re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())]
    if not w:
        return set()
    return {tuple(w)} if len(w) < 5 else {tuple(w[k : k + 5]) for k in range(len(w) - 4)}


def brute_components(texts):
    s = {i: sets(t) for i, t in texts.items()}
    label = {i: i for i in texts}
    ids = sorted(texts)
    links = [(i, j) for k, i in enumerate(ids) for j in ids[k + 1 :] if s[i] and s[j] and 100 * len(s[i] & s[j]) >= 80 * len(s[i] | s[j])]
    changed = True
    while changed:
        changed = False
        for i, j in links:
            low = min(label[i], label[j])
            changed |= label[i] != low or label[j] != low
            label[i] = label[j] = low
    return {i: (len(s[i]), label[i]) for i in texts}


@pytest.mark.parametrize("rows", [50_000, 3])
def test_repeats(spark, docs, corpus, monkeypatch, rows):
    monkeypatch.setattr(op6_repeats, "ORDERED", rows)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in op6_repeats.digest(op6_repeats.removed(docs)).collect()}
    want = brute_removed(corpus)
    assert sum(x[1] for x in want.values()) > 5000
    assert got == want


def test_repeats_of_single_letters_and_across_documents(spark):
    texts = {1: "a" * 49, 2: "a" * 49, 3: "a" * 50, 4: "a" * 500, 5: "b" + "a" * 51 + "c", 6: "x" * 30 + "a" * 20, 7: "0123456789" * 40, 8: "123456789" + "0123456789" * 5 + "q"}
    df = spark.createDataFrame(list(texts.items()), SCHEMA)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in op6_repeats.digest(op6_repeats.removed(df)).collect()}
    assert got == brute_removed(texts)


def test_repeats_of_nothing(spark):
    assert op6_repeats.removed(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = op6_repeats.removed(spark.createDataFrame([(None, "a" * 60), (1, "a" * 60), (1, "a" * 60)], SCHEMA)).collect()
    assert sorted((r.doc_id or 0, r.n_removed) for r in rows) == [(0, 0), (1, 0), (1, 0)]


@pytest.mark.parametrize("pivots", [16, 1])
def test_components(spark, docs, corpus, monkeypatch, pivots):
    monkeypatch.setattr(op7_jaccard, "PIVOTS", pivots)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in op7_jaccard.components(docs).collect()}
    assert got == brute_components(corpus)


@pytest.mark.parametrize("pivots", [16, 1])
def test_components_of_clusters_with_common_passages(spark, rng, monkeypatch, pivots):
    """Chains of copies of copies around passages that all share: regions stay open after the pivot document, and are divided."""
    monkeypatch.setattr(op7_jaccard, "PIVOTS", pivots)
    texts, common = {}, [f"c{k}" for k in range(40)]
    for g in range(6):
        base = common + [f"g{g}w{k}" for k in range(20)]
        for i in range(12):
            w = list(base)
            for _ in range(rng.randrange(1, 4)):
                w[rng.randrange(60)] = rng.choice(["u", "v", "x"])
            texts[100 * g + i + 1] = " ".join(w[rng.randrange(4) :])
            base = w if i % 3 == 0 else base
    df = spark.createDataFrame(list(texts.items()), SCHEMA)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in op7_jaccard.components(df).collect()} == brute_components(texts)


def test_components_of_star_shaped_group(spark, rng):
    """Copies that link with their original but hardly with each other, so that regions have to be divided."""
    base = [f"w{k}" for k in range(60)]
    texts = {}
    for i in range(90):
        w = list(base)
        w[rng.randrange(60)] = f"m{i}"
        if i % 3:
            w[rng.randrange(60)] = f"n{i}"
        texts[i + 5] = " ".join(w)
    texts[400] = " ".join(base)
    df = spark.createDataFrame(list(texts.items()), SCHEMA)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in op7_jaccard.components(df).collect()} == brute_components(texts)


def test_components_of_texts_and_their_beginnings_and_ends(spark):
    """Linked texts of different sizes, alone in the corpus but for each other, for all sizes at which rounding matters."""
    texts = {}
    for k in range(240):
        n = 5 + k % 40
        w = [f"t{k}w{j}" for j in range(n + 4)]
        cut = max(1, n // 5)
        texts[10 * k] = " ".join(w)
        texts[10 * k + 1] = " ".join(w[cut:] if k % 80 >= 40 else w[:-cut])
    df = spark.createDataFrame(list(texts.items()), SCHEMA)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in op7_jaccard.components(df).collect()}
    assert got == brute_components(texts) and all(got[10 * k + 1][1] == 10 * k for k in range(240))


def test_components_of_nothing(spark):
    assert op7_jaccard.components(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = op7_jaccard.components(spark.createDataFrame([(None, "a b"), (2, None), (3, "A b"), (3, "A b"), (4, "a\tB")], SCHEMA)).collect()
    assert sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0) for r in rows) == [(0, 1, 0), (2, 0, 2), (3, 1, 3), (3, 1, 3), (4, 1, 3)]


def brute_links(rows):
    ok = {i: (v, y) for i, v, y in rows if y is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    n, label = {i: 0 for i, _, _ in rows}, {i: i for i, _, _ in rows}
    pairs = []
    for i in ok:
        for j in ok:
            if i < j and ok[i][1] == ok[j][1] and len(ok[i][0]) == len(ok[j][0]):
                a, b = np.array(ok[i][0]), np.array(ok[j][0])
                if a @ b / (np.sqrt(a @ a) * np.sqrt(b @ b)) >= 0.93:
                    n[i] += 1
                    n[j] += 1
                    pairs.append((i, j))
    for _ in range(len(rows)):
        for i, j in pairs:
            label[i] = label[j] = min(label[i], label[j])
    return n, label, pairs


@pytest.mark.parametrize("large", [12, 2])
def test_embeddings(spark, monkeypatch, large):
    monkeypatch.setattr(op8_embeddings, "BLOCK", 7)
    monkeypatch.setattr(op8_embeddings, "LARGE", large)
    r = np.random.default_rng(1)
    rows = []
    for i in range(60):
        v = r.standard_normal(16)
        rows.append((len(rows), v.tolist(), i % 3))
        for _ in range(r.integers(0, 6)):
            rows.append((len(rows), (v + r.standard_normal(16) * r.choice([0, 0.1, 0.3])).tolist(), int(r.choice([i % 3, i % 3, 4]))))
    for v, y in ((None, 1), ([], 1), ([0.0] * 16, 1), ([1.0, None], 1), ([float("nan")] * 16, 1), ([float("inf")] * 16, 1), ([1.0] * 16, None), ([1.0] * 16, None)):
        rows.append((len(rows), v, y))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {x.vec_id: x for x in op8_embeddings.near_duplicates(df).collect()}
    n, label, pairs = brute_links(rows)
    assert len(got) == len(rows) and len(pairs) > 50
    found = sum(x.n_links for x in got.values())
    assert 0.97 * 2 * len(pairs) <= found <= 2 * len(pairs)
    assert all(got[i].n_links <= n[i] and got[i].component_id >= label[i] and got[i].kept == (got[i].component_id == i) for i in n)


def test_embeddings_of_extreme_size_and_unequal_length(spark):
    big, small = 1e200, 1e-200
    rows = [(1, [big, big], 1), (2, [big, 0.99 * big], 1), (3, [small, small], 1), (4, [small, 0.99 * small], 1), (5, [1.0, 1.0, 1.0], 1), (6, [1.0, 1.0, 0.9], 1), (7, [-big, big], 1)]
    got = {x.vec_id: (x.n_links, x.component_id) for x in op8_embeddings.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    assert got == {1: (3, 1), 2: (3, 1), 3: (3, 1), 4: (3, 1), 5: (1, 5), 6: (1, 5), 7: (0, 7)}


def test_embeddings_of_a_bucket_of_near_copies(spark, monkeypatch):
    """Two large groups around centres, tight and wide: balls count as exact pairs do. A column named like an inner one is not read."""
    monkeypatch.setattr(op8_embeddings, "BLOCK", 40)
    r = np.random.default_rng(4)
    rows = []
    for wide in (0.02, 0.06):
        v = r.standard_normal(32)
        v /= np.linalg.norm(v)
        rows += [(len(rows) + k, (v + r.standard_normal(32) * wide * r.uniform(0, 1)).tolist(), 1) for k in range(150)]
    df = spark.createDataFrame([(*x, "q") for x in rows], "vec_id long, embedding array<double>, label int, ball string")
    got = {x.vec_id: x for x in op8_embeddings.near_duplicates(df).collect()}
    n, label, pairs = brute_links(rows)
    assert 0.98 * 2 * len(pairs) <= sum(x.n_links for x in got.values()) <= 2 * len(pairs)
    assert all(got[i].n_links <= n[i] and got[i].component_id == label[i] for i in n)


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_embedding_recall_on_given_vectors(spark, sf):
    df = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet")
    rows = [(r.vec_id, [float(x) for x in r.embedding], r.label) for r in df.collect()]
    n, label, pairs = brute_links(rows)
    got = {x.vec_id: x for x in op8_embeddings.near_duplicates(df).collect()}
    assert sum(x.n_links for x in got.values()) >= 0.95 * 2 * len(pairs)
    assert np.mean([got[i].component_id == label[i] for i in label]) >= 0.98


def test_embeddings_of_nothing(spark):
    assert op8_embeddings.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0
    rows = op8_embeddings.near_duplicates(spark.createDataFrame([(1, [1.0, 2.0], 1), (1, [1.0, 2.0], 1), (2, [1.0, 2.0], 1)], "vec_id long, embedding array<float>, label int")).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in rows) == [(1, 1, 1), (1, 1, 1), (2, 1, 1)]


def test_labels_of_a_chain(spark):
    nodes = spark.range(200).select(F.col("id"))
    edges = spark.range(149).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    got = {r.id: r.component_id for r in labelled(nodes, edges).collect()}
    assert got == {i: 0 if i < 150 else i for i in range(200)}


def test_merged_labels_equal_labels_of_all_edges(spark):
    nodes = spark.range(40)
    first = spark.createDataFrame([(1, 2), (2, 3), (10, 11), (20, 21), (21, 30)], "a long, b long")
    more = spark.createDataFrame([(11, 3), (30, 10), (1, 3), (35, 36)], "a long, b long")
    want = {(r.id, r.component_id) for r in labelled(nodes, first.union(more)).collect()}
    assert {(r.id, r.component_id) for r in merged(labelled(nodes, first), more, "merged").collect()} == want
    same = merged(labelled(nodes, first), spark.createDataFrame([(1, 3)], "a long, b long"), "same")
    assert sorted(map(tuple, same.collect())) == sorted(map(tuple, labelled(nodes, first).collect()))

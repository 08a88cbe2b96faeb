"""The n-gram join against all pairs, on the given tables and on sets near the threshold."""

import random

import numpy as np
import pytest
from conftest import DATA
from odd import DOCS, no_docs, odd_docs
from pyspark.sql import functions as F

from wattline.llm.components import connected
from wattline.llm.hashing import WordHasher, words_of
from wattline.llm.ngram_join import one_of_each_group, shingles, signatures, similar_documents


def shingle_set(text):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def by_force(texts):
    """Component of every document by comparing all pairs of distinct sets."""
    sets = {i: shingle_set(t) for i, t in texts.items()}
    parent = {i: i for i in texts}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    ids = sorted(texts)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return {i: find(i) for i in ids}, {i: len(s) for i, s in sets.items()}


def check(spark, texts, **options):
    rows = [(i, t, "en", "s", 0) for i, t in texts.items()]
    got = similar_documents(spark.createDataFrame(rows, DOCS), **options).collect()
    components, sizes = by_force(texts)
    assert {r.doc_id: r.component_id for r in got} == components
    assert {r.doc_id: r.n_shingles for r in got} == sizes
    return components


def test_given_documents(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    check(spark, {r.doc_id: r.text for r in docs.collect()})


@pytest.mark.parametrize("frequent", [2, 4, 64])
def test_sets_around_the_threshold(spark, frequent):
    """Groups of edited copies, chains, shared passages: with few tokens counting as rare."""
    rng = random.Random(frequent)
    passage = [f"p{i}" for i in range(40)]
    texts = {}
    for group in range(8):
        base = [f"g{group}x{i}" for i in range(rng.choice([6, 8, 20, 60, 150]))]
        for _ in range(12):
            words = list(base)
            for _ in range(rng.randrange(0, max(2, len(base) // 12))):
                words[rng.randrange(len(words))] = f"n{rng.randrange(10**6)}"
            if rng.random() < 0.3:
                words = words[: rng.randrange(len(words) * 3 // 4, len(words) + 1)]
            if rng.random() < 0.4:
                words += passage
            texts[len(texts)] = " ".join(words)
    components = check(spark, texts, frequent=frequent)
    assert len(set(components.values())) < len(texts)


def test_a_large_group_of_near_copies_is_one_component(spark):
    rng = random.Random(3)
    base = [f"b{i}" for i in range(120)]
    texts = {}
    for i in range(150):
        words = list(base)
        for _ in range(rng.randrange(0, 4)):
            words[rng.randrange(120)] = f"e{rng.randrange(10**6)}"
        texts[i] = " ".join(words)
    check(spark, texts)


def test_linked_sets_share_a_signature():
    rng = np.random.default_rng(5)
    for n in (3, 4, 5, 8, 17, 60, 400):
        for _ in range(40):
            base = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
            n = len(base)
            keep = base[rng.permutation(n)[: n - int(0.25 * n)]]
            extra = rng.integers(0, 2**63, max(0, (4 * len(keep) // 3 - n) // 2), dtype=np.uint64)
            other = np.unique(np.concatenate((keep, extra)))
            both = len(np.intersect1d(base, other))
            if 100 * both < 75 * (n + len(other) - both):
                continue
            totals = {int(t): int(rng.choice([2, 3, 70, 500])) for t in np.union1d(base, other)}
            signed = [
                signatures(x, np.array([totals[int(t)] for t in x]), 64).tolist() for x in (base, other)
            ]
            assert set(signed[0]) & set(signed[1]), n


def test_hashes_tell_words_and_places_apart():
    hasher = WordHasher()
    assert len(shingles(hasher, "a b c d e f")) == 2
    assert len(shingles(hasher, "A b c d e a B c D e")) == 5
    assert len(shingles(hasher, "ab c")) == 1 and len(shingles(hasher, " \t")) == 0
    assert shingles(hasher, "ab c")[0] != shingles(hasher, "a bc")[0]
    assert words_of("É a b\x0bc\x1cd", lower=True) == ["É a b".encode(), "c\x1cd".encode()]


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, 100 + i) for i in range(1, 60)]
    edges = spark.createDataFrame(chain + star + [(7, 7)], "a long, b long")
    got = {r.node: r.component for r in connected(edges).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(60)}}
    assert connected(edges.where("a < 0")).count() == 0


def test_odd_documents(spark):
    got = similar_documents(odd_docs(spark)).collect()
    rows = sorted(((r.doc_id, r.component_id, r.n_shingles) for r in got), key=repr)
    assert len(rows) == odd_docs(spark).count()
    by_id = {r[0]: r[1:] for r in rows if r[0] is not None}
    assert by_id[1] == (1, 36) and by_id[2] == (1, 36) and by_id[3] == (1, 36)
    assert by_id[8][0] == 7 and by_id[4] == (4, 0) and by_id[5] == (5, 0) and by_id[6] == (6, 0)
    assert by_id[11] == (11, 1)
    assert [r for r in rows if r[0] is None] == [(None, 1, 36), (None, None, 0)]
    assert similar_documents(no_docs(spark)).count() == 0
    kept = one_of_each_group(odd_docs(spark))
    assert kept.columns == odd_docs(spark).columns
    assert {r.doc_id for r in kept.collect()} == {1, 4, 5, 6, 7, 9, 10, 11, 12, None}
    assert kept.where(F.col("doc_id") == 1).count() == 1


def test_a_row_repeated_past_two_bytes_keeps_its_links(spark):
    words = [f"w{i}" for i in range(60)]
    rows = spark.range(65_536).select(F.lit(1).cast("long").alias("doc_id"), F.lit(" ".join(words)).alias("text"))
    other = spark.createDataFrame([(2, " ".join([*words, "more"]))], "doc_id long, text string")
    got = similar_documents(rows.unionByName(other)).groupBy("doc_id", "component_id").count().collect()
    assert {tuple(r) for r in got} == {(1, 1, 65_536), (2, 1, 1)}


def test_words_of_regular_structure_are_told_apart(spark):
    s, t = "a", "b"
    for _ in range(10):
        s, t = s + t, t + s
    docs = spark.createDataFrame([(i, x, "en", "s", len(x)) for i, x in enumerate((s, t, s.upper()))], DOCS)
    assert {r.doc_id: r.component_id for r in similar_documents(docs).collect()} == {0: 0, 1: 1, 2: 0}

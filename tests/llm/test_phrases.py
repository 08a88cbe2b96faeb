"""Repeated passages against a plain reading, and odd tables."""

import hashlib
import random

import numpy as np
import pytest
from odd import DOCS, no_docs, odd_docs, odd_rows

from wattline.llm.hashing import WordHasher, words_of
from wattline.llm.phrases import passages, remove_repeated_passages, seeds


def by_force(rows, window=13):
    texts = [(i, [w for w in words_of(t)]) for i, t in rows]
    last = float("inf")
    owner = {}
    for i, words in texts:
        for k in range(len(words) - window + 1):
            phrase = tuple(words[k : k + window])
            owner[phrase] = min(owner.get(phrase, last), last if i is None else i)
    found = []
    for i, words in texts:
        gone = set()
        for k in range(len(words) - window + 1):
            if owner[tuple(words[k : k + window])] < (last if i is None else i):
                gone.update(range(k, k + window))
        kept = b" ".join(w for k, w in enumerate(words) if k not in gone)
        found.append((i, len(words), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(found, key=repr)


def answers(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in df.collect()), key=repr)


def made(seed, docs=60):
    rng = random.Random(seed)
    shared = [[f"s{j}w{i}" for i in range(rng.randrange(5, 70))] for j in range(6)]
    rows = []
    for i in range(docs):
        words = []
        for _ in range(rng.randrange(0, 6)):
            words += [f"d{rng.randrange(10**6)}" for _ in range(rng.randrange(0, 20))]
            piece = rng.choice(shared)
            start = rng.randrange(len(piece))
            words += piece[start:] if rng.random() < 0.5 else piece
        rows.append((i * 3 % docs, "  \n".join(words) if i % 7 else "\t".join(words) + " É"))
    return rows


@pytest.mark.parametrize("chunk_docs", [5, 2000])
def test_many_and_few_chunks(spark, chunk_docs):
    rows = made(chunk_docs)
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOCS)
    got = remove_repeated_passages(df, chunk_docs=chunk_docs, bucket_tokens=50)
    assert answers(got) == by_force(rows)
    assert sum(r[2] for r in by_force(rows)) > 200


def test_a_passage_in_every_document_and_repeats_within_one(spark):
    passage = " ".join(f"p{i}" for i in range(50))
    rows = [(i, f"own{i} {passage} tail{i} {passage}") for i in range(40)] + [(100, "a " * 60), (101, "a " * 20)]
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOCS)
    got = remove_repeated_passages(df, with_text=True, chunk_docs=10)
    assert answers(got) == by_force(rows)
    texts = {r.doc_id: r.kept_text for r in got.collect()}
    assert texts[0].count("p1 ") == 2 and texts[5] == "own5 tail5" and texts[101] == ""


def test_seeds_depend_on_the_window_alone():
    words = [f"w{i * i % 17}".encode() for i in range(200)]
    hasher = WordHasher()
    whole = seeds(hasher, words, 13)
    for start in range(0, 180, 7):
        assert seeds(hasher, words[start : start + 13], 13)[0] == whole[start]
    assert len(seeds(hasher, words[:12], 13)) == 0


def test_runs_of_windows():
    big = np.iinfo("int64").max
    assert passages(np.array([1, 1, big, 5, 0]), 5, 13) == [(0, 14), (4, 17)]
    assert passages(np.array([], dtype=np.int64), 5, 13) == []


def test_odd_documents(spark):
    got = remove_repeated_passages(odd_docs(spark))
    assert answers(got) == by_force([(r[0], r[1]) for r in odd_rows()])
    assert remove_repeated_passages(no_docs(spark)).count() == 0
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("llm_chunks")]


def structured_words():
    """Two words of 1,024 letters that polynomials modulo 2^64 over their letters cannot tell apart."""
    s, t = "a", "b"
    for _ in range(10):
        s, t = s + t, t + s
    return s, t


def test_words_of_regular_structure_are_told_apart(spark):
    s, t = structured_words()
    texts = [(1, " ".join([s] * 13)), (2, " ".join([t] * 13)), (3, f"x {' '.join([s] * 13)}")]
    docs = spark.createDataFrame([(i, x, "en", "s", len(x)) for i, x in texts], DOCS)
    assert {r.doc_id: r.n_removed for r in remove_repeated_passages(docs).collect()} == {1: 0, 2: 0, 3: 13}

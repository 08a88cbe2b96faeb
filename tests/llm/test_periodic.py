"""Runs against a search by brute force; extensions against comparing symbol by symbol."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from conftest import DATA
from odd import DOCS, clash, no_docs, odd_docs, odd_rows

from wattline.llm.periodic import collapsed_texts, periodic_runs, run_report
from wattline.llm.recompression import Grammar


def common(s, i, j, step):
    n = 0
    while 0 <= min(i, j) and max(i, j) < len(s) and s[i] == s[j]:
        n, i, j = n + 1, i + step, j + step
    return n


def ended(symbols):
    return np.array([10**6, *symbols, 10**6 + 1], dtype=np.int64)


@pytest.mark.parametrize("letters", [1, 2, 3, 20])
def test_extensions_are_those_of_comparing(letters):
    rng = random.Random(letters)
    for size in (1, 2, 3, 10, 60, 300):
        symbols = [rng.randrange(letters) for _ in range(size)]
        if size > 100:
            symbols = symbols[:40] * 4 + symbols[:140]
        s = ended(symbols).tolist()
        pairs = [(i, j) for i in range(1, len(s)) for j in range(1, len(s)) if i != j]
        pairs = rng.sample(pairs, min(len(pairs), 4000))
        a, b = np.array(pairs).T
        grammar = Grammar(np.array(s))
        assert grammar.extensions(a, b).tolist() == [common(s, i, j, 1) for i, j in pairs]
        assert grammar.extensions(a, b, backwards=True).tolist() == [common(s, i - 1, j - 1, -1) for i, j in pairs]


def test_levels_shrink():
    """Some log(n) levels, so that an extension costs so many steps."""
    grammar = Grammar(ended([i % 7 for i in range(100_000)]))
    assert grammar.extensions([1], [8]).tolist() == [100_000 - 7]
    assert len(grammar._steps) < 120
    assert sum(len(step.symbols) for step in grammar._steps) < 10 * 100_000


def runs_by_force(words, min_length=24, min_repeats=3):
    found = {}
    n = len(words)
    for p in range(1, n // min_repeats + 1):
        i = 0
        while i + p < n:
            if words[i] != words[i + p]:
                i += 1
                continue
            start = i
            while i + p < n and words[i] == words[i + p]:
                i += 1
            end = i + p
            if end - start >= max(min_length, min_repeats * p):
                found.setdefault((start, end), p)
    return sorted((s, e - s, p) for (s, e), p in found.items())


def collapsed_by_force(words, runs):
    gone = {i for s, n, p in runs for i in range(s + p, s + n)}
    return [w for i, w in enumerate(words) if i not in gone]


def test_runs_are_those_of_brute_force():
    rng = random.Random(5)
    texts = [[], [b"a"], [b"a"] * 23, [b"a"] * 24, [b"a", b"b"] * 12, [b"a", b"b", b"a"] * 40, [b"x"] * 5 + [b"y"] * 100 + [b"x"] * 30]
    for _ in range(120):
        words = []
        while len(words) < rng.randrange(1, 300):
            period = [bytes([97 + rng.randrange(3)]) for _ in range(rng.randrange(1, 20))]
            words += period * rng.randrange(1, 6) + period[: rng.randrange(len(period) + 1)]
            words += [bytes([97 + rng.randrange(6)]) for _ in range(rng.randrange(6))]
        texts.append(words)
    got = collapsed_texts(texts)
    assert sum(len(runs) for runs, _ in got) > 100
    for words, (runs, kept) in zip(texts, got, strict=True):
        wanted = runs_by_force(words)
        assert runs == wanted, words
        assert kept == b" ".join(collapsed_by_force(words, wanted))


def test_texts_do_not_run_into_each_other():
    assert [runs for runs, _ in collapsed_texts([[b"a"] * 12] * 4)] == [[], [], [], []]


def report_by_force(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and words:
        n, g = len(words), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
    runs = runs_by_force(words)
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    listed = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
    kept = " ".join(collapsed_by_force(words, runs))
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *top, *(hashlib.sha256(t.encode()).hexdigest() for t in (listed, kept)))


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_report_of_the_given_documents(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect() if len(r.text) < 8000]
    few = spark.createDataFrame(rows, "doc_id long, text string")
    got = rows_of(run_report(few))
    assert got == sorted((report_by_force(*r) for r in rows), key=repr)
    assert sum(r[1] > 0 for r in got) > 5


def test_odd_documents(spark):
    rows = [(r[0], r[1]) for r in odd_rows() if len(r[1] or "") < 60_000]
    got = [r for r in rows_of(run_report(odd_docs(spark))) if r[0] not in (7, 8)]
    assert got == sorted((report_by_force(*r) for r in rows), key=repr)
    assert run_report(no_docs(spark)).count() == 0


def test_long_periodic_text_and_other_columns(spark):
    text = " ".join(["la", "di", "da"] * 100_000)
    docs = clash(spark.createDataFrame([(1, text, "en", "s", 1), (1, text, "en", "s", 1), (2, None, "en", "s", None)], DOCS))
    got = periodic_runs(docs.withColumn("runs", docs.doc_id))
    assert got.columns == [*docs.columns, "runs", "collapsed"]
    rows = got.orderBy("doc_id").collect()
    assert [r.collapsed for r in rows] == ["la di da", "la di da", ""]
    assert [tuple(x) for x in rows[0].runs] == [(0, 300_000, 3)]

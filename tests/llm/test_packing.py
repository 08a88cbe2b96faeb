"""Packing: ids of the tokenizers library, every id in one piece, little padding, odd tables."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import DATA
from hypothesis import given, settings
from hypothesis import strategies as st
from odd import DOCS, no_docs, odd_docs, odd_rows
from tokenizers import Tokenizer

from wattline.llm.packing import byte_bpe, default_tokenizer, encode, pack_documents, pack_histogram

REFERENCE = Tokenizer.from_file(default_tokenizer())


def ids(text):
    return REFERENCE.encode(text or "", add_special_tokens=False).ids + [0]


@settings(max_examples=150, deadline=None)
@given(
    st.text(max_size=80)
    | st.text(alphabet="a é'sSt\n\t1½ 😀<|endoftext|>", max_size=80)
    | st.lists(st.sampled_from(["<|endoftext|>", "<|", "|>", "endoftext", "a", " ", "é", "\n"])).map("".join)
)
def test_ids_are_those_of_the_library(text):
    assert encode(byte_bpe(default_tokenizer()), text) == ids(text)[:-1]


@pytest.mark.parametrize("space", [" ", "\t", "\n", "\u2003", " \n"])
def test_ids_of_long_white_space(space):
    run = space * 20_000
    for text in (run, f"a{run}b", f"{run} {run}x", f"a{run}<|endoftext|>{run}1", f"é{run}\n", f"<|{run}|>"):
        assert encode(byte_bpe(default_tokenizer()), text) == ids(text)[:-1]


def test_white_space_of_ten_million(spark):
    docs = spark.createDataFrame([(1, "a" + " " * 10_000_000 + "b", "en", "s", 0)], DOCS)
    assert pack_documents(docs).agg({"length": "sum"}).first()[0] == 10_000_002


def test_lengths_go_into_the_shortest_pack():
    assert pack_histogram({700: 1, 600: 1, 300: 1}, 1024) == [([600, 300], 1), ([700], 1)]


def check(df, texts):
    """All that holds of any packing; gives the number of sequences."""
    rows = df.collect()
    pieces, places = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id, r.doc_tokens].append((r.start, r.length, r.ids_crc32))
        places[r.sequence_id].append((r.offset, r.length))
    wanted = defaultdict(list)
    for doc, text in texts:
        whole = np.array(ids(text), dtype="<u4")
        for start in range(0, len(whole), 1024):
            piece = whole[start : start + 1024]
            wanted[doc, len(whole)].append((start, len(piece), zlib.crc32(piece.tobytes())))
    assert {k: sorted(v) for k, v in pieces.items()} == {k: sorted(v) for k, v in wanted.items()}
    for held in places.values():
        end = 0
        for offset, length in sorted(held):
            assert offset == end and length > 0
            end += length
        assert end <= 1024
    return len(places)


def test_given_documents(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    sequences = check(pack_documents(docs), texts)
    total = sum(len(ids(t)) for _, t in texts)
    assert sequences <= -(-total // 1024) * 1.02 + 1


def test_patterns_use_every_length_as_often_as_it_occurs():
    rng = random.Random(2)
    for spread in (30, 200, 1023):
        counts = Counter(rng.randrange(1, spread + 1) for _ in range(5000))
        patterns = pack_histogram(dict(counts), 1024)
        used = Counter()
        for pattern, times in patterns:
            assert sum(pattern) <= 1024 and times > 0
            for length in pattern:
                used[length] += times
        assert used == counts
        assert sum(t for _, t in patterns) <= -(-sum(k * v for k, v in counts.items()) // 1024) * 1.03 + 1
    assert pack_histogram({}, 1024) == []


def test_odd_documents(spark):
    docs = odd_docs(spark)
    check(pack_documents(docs), [(r[0], r[1]) for r in odd_rows()])
    assert pack_documents(no_docs(spark)).count() == 0
    exact = spark.createDataFrame([(i, " a" * 1023, "en", "s", 0) for i in range(3)], DOCS)
    assert check(pack_documents(exact), [(i, " a" * 1023) for i in range(3)]) == 3
    assert pack_documents(exact).columns == [
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset",
    ]


def test_packed_ids_have_added_tokens(spark):
    text = "a <|endoftext|> b"
    found = Tokenizer.from_file(default_tokenizer()).encode(text, add_special_tokens=False).ids
    wanted = np.array([*found, 0], dtype="<u4")
    row = pack_documents(spark.createDataFrame([(1, text, "en", "s", len(text))], DOCS)).first()
    assert (row.doc_tokens, row.ids_crc32) == (len(wanted), zlib.crc32(wanted.tobytes()))

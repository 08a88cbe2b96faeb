"""The manifest against trees built one by one in Python, on odd tables and on every small tree size."""

import hashlib
import zlib

import pytest
from odd import DOCS, clash, no_docs, odd_docs, odd_rows
from pyspark.sql import functions as F

from wattline.llm.merkle import butterfly, dataset_manifest, folded, merkle_proofs, verified_manifest


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def counted(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def climb(nodes, fanout=16):
    """The levels of one tree."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([H(*below[i : i + fanout]) for i in range(0, len(below), fanout)])
    return levels


def proof_of(levels, place, fanout=16):
    found = []
    for level in levels[:-1]:
        run = place // fanout * fanout
        found.append(("".join(level[run:place]), "".join(level[place + 1 : run + fanout])))
        place //= fanout
    return found


def by_hand(rows):
    trees = {}
    for doc_id, text, lang, source, n_chars in rows:
        def leaf_of(t):
            return H(*(counted(v) for v in (doc_id, source, lang, n_chars, t)))

        tampered = text
        if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0 and text is not None:
            tampered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
        trees.setdefault(source, []).append((doc_id is not None, doc_id or 0, leaf_of(text), leaf_of(tampered), doc_id))
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    levels = {s: climb([leaf[2] for leaf in sorted(trees[s])]) for s in order}
    top = climb([levels[s][-1][0] for s in order])
    out = []
    for i, s in enumerate(order):
        for place, (_, _, leaf, changed, doc_id) in enumerate(sorted(trees[s])):
            proof = proof_of(levels[s], place) + proof_of(top, i)
            own = changed
            for left, right in proof:
                own = H(left, own, right)
            root = top[-1][0]
            text = "".join(a + b for a, b in proof)
            out.append((doc_id, leaf, levels[s][-1][0], root, H(text), own, own == root))
    return sorted(out, key=repr)


def rows_of(df):
    columns = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_odd_documents(spark):
    assert rows_of(verified_manifest(odd_docs(spark))) == by_hand(odd_rows())
    assert verified_manifest(no_docs(spark)).count() == 0


def test_given_documents_and_a_large_source(spark):
    rows = [(i, f"Text {i} É", "en", "hot" if i % 3 else f"s{i % 40}", None if i % 7 else i) for i in range(1500)]
    rows += [(None, "A", None, None, None), (3, "B", "en", "hot", 1), (3, "B", "en", "hot", 1)]
    got = rows_of(verified_manifest(clash(spark.createDataFrame(rows, DOCS))))
    assert got == by_hand(rows)
    assert {g[6] for g in got} == {True, False}


@pytest.mark.parametrize("fanout", [2, 3])
def test_every_size_of_tree(spark, fanout):
    """Small fan-outs and blocks give many levels and every kind of short subtree."""
    sizes = [1, 2, 3, 4, 5, 7, 8, 9, 10, 13, 17, 26, 27, 28, 33, 50]
    rows = [(f"t{n:02d}", i, H(str(n), str(i))) for n in sizes for i in range(n)]
    leaves = spark.createDataFrame(rows, "tree string, place_in long, leaf string")
    found = merkle_proofs(leaves, ["place_in"], fanout=fanout, block_levels=1)
    found = found.withColumn("own", folded(F.col("leaf"), F.col("proof"))).collect()
    levels = {n: climb([H(str(n), str(i)) for i in range(n)], fanout) for n in sizes}
    top = climb([levels[n][-1][0] for n in sizes], fanout)
    assert len(found) == len(rows)
    for r in found:
        n = int(r.tree[1:])
        wanted = proof_of(levels[n], r.place_in, fanout) + proof_of(top, sizes.index(n), fanout)
        assert [tuple(p) for p in r.proof] == wanted
        assert r.own == r.root == top[-1][0]
        assert r.subroot == levels[n][-1][0]


def test_a_round_groups_no_more_than_the_fanout(spark):
    """1,000 nodes of one tree: three rounds of one shuffle each, with every proof complete."""
    nodes = spark.range(1000).select(F.lit("t").alias("tree"), F.col("id").alias("place"), F.sha2(F.col("id").cast("string"), 256).alias("digest"))
    found = butterfly(nodes, "test").collect()
    levels = climb([H(str(i)) for i in range(1000)])
    assert len(found) == 1000
    for r in found:
        assert r.root == levels[-1][0]
        assert [tuple(p) for p in r.proof] == proof_of(levels, r.place)


def test_a_changed_text_shows(spark):
    docs = spark.createDataFrame([(1, "Abc", "en", "s", 3), (2, "abc", "en", "s", 3)], DOCS)
    rows = {r.doc_id: r for r in dataset_manifest(docs, F.lower("text")).collect()}
    assert rows[1].changed_leaf not in (None, rows[1].leaf)
    assert rows[2].changed_leaf is None

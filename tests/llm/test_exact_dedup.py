"""Exact duplicates by a stream: against a plain grouping, over several batches, and odd tables."""

import hashlib
import re

import pytest
from conftest import DATA
from odd import no_docs, odd_docs, odd_rows
from pyspark.sql import functions as F

from wattline.llm import exact_dedup
from wattline.llm.exact_dedup import exact_duplicates


def by_force(rows):
    groups = {}
    for n, (doc, text) in enumerate(rows):
        content = re.sub(r"[\x20\x09-\x0D]", "", text or "")
        groups.setdefault(content, []).append((-len(text or ""), doc is None, doc, n))
    found = []
    for content, members in groups.items():
        members.sort(key=lambda m: (m[0], m[1], m[2] or 0))
        for _, _, doc, _ in members:
            digest = hashlib.sha256(content.encode()).hexdigest()
            found.append((doc, members[0][2], len(members), digest))
    return sorted(found, key=repr)


def answers(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in df.collect()), key=repr)


@pytest.mark.parametrize("files", [None, 1])
def test_in_one_batch_and_in_several(spark, tmp_path, files):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    path = str(tmp_path / "docs.parquet")
    copies = docs.where("doc_id % 3 = 0").withColumns(
        {"doc_id": F.col("doc_id") + 1000, "text": F.concat(F.lit(" \t"), F.regexp_replace("text", " ", "\n"))}
    )
    docs.unionByName(copies).repartition(3).write.parquet(path)
    got = exact_duplicates(spark, path, files)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(path).collect()]
    assert answers(got) == by_force(rows)
    kept = got.where("kept")
    assert kept.where("doc_id <> keep_id").count() == 0
    assert kept.count() == got.select("text_sha256").distinct().count()


def test_new_files_join_the_state(spark, tmp_path):
    path, state = str(tmp_path / "docs.parquet"), str(tmp_path / "state")
    schema = "doc_id long, text string"
    spark.createDataFrame([(5, "a b"), (6, "c")], schema).write.parquet(path)
    assert answers(exact_duplicates(spark, path, checkpoint=state)) == by_force([(5, "a b"), (6, "c")])
    spark.createDataFrame([(1, "ab"), (2, "a  b"), (3, "a  b")], schema).write.mode("append").parquet(path)
    rows = [(5, "a b"), (6, "c"), (1, "ab"), (2, "a  b"), (3, "a  b")]
    assert answers(exact_duplicates(spark, path, checkpoint=state)) == by_force(rows)


def test_equal_digests_of_different_texts_are_told_apart(spark, tmp_path, monkeypatch):
    """With a digest that only sees the length, the check of the full bytes decides."""
    path = str(tmp_path / "docs.parquet")
    rows = [(1, "aa"), (2, "bb"), (3, "a a"), (4, "ccc"), (5, "bb")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(path)
    monkeypatch.setattr(exact_dedup.F, "sha2", lambda column, bits: F.length(column).cast("string"))
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact_duplicates(spark, path).collect()}
    assert got == {1: (3, 2, False), 2: (2, 2, True), 3: (3, 2, True), 4: (4, 1, True), 5: (2, 2, False)}


def test_odd_tables(spark, tmp_path):
    path = str(tmp_path / "odd.parquet")
    odd_docs(spark).write.parquet(path)
    got = exact_duplicates(spark, path)
    assert answers(got) == by_force([(r[0], r[1]) for r in odd_rows()])
    assert got.where("kept").count() == got.select("text_sha256").distinct().count()
    no_docs(spark).write.parquet(str(tmp_path / "none.parquet"))
    assert exact_duplicates(spark, str(tmp_path / "none.parquet")).count() == 0


def test_settings_are_put_back(spark, tmp_path):
    key = "spark.sql.streaming.stateStore.unloadOnCommit"
    before = spark.conf.get(key, None)
    with exact_dedup._state_on_disk(spark):
        assert spark.conf.get(key) == "true"
    assert spark.conf.get(key, None) == before

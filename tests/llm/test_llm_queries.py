"""The registered queries against DuckDB, and that each gives its columns on the smallest tables."""

import pytest
from compare import connect, differences
from conftest import DATA

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from wattline.llm.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def duck():
    return connect(DATA)


def test_all_are_registered():
    assert {q.partition("_")[0] for q in QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= set(queries())
    assert set(ORACLES) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, duck, name):
    assert differences(QUERIES[name](spark, DATA), duck, ORACLES[name]) == []


def test_pipeline(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    before, columns = docs, docs.columns
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, before, DATA).cache()
        kept.append((name, before.count(), after.count()))
        if name != "packing":
            assert after.columns == columns
            assert after.select("doc_id").subtract(before.select("doc_id")).count() == 0
        before = after
    rows = {name: (a, b) for name, a, b in kept}
    assert rows["line dedup"][0] == rows["line dedup"][1]
    assert 0 < rows["n-gram join"][1] <= rows["n-gram join"][0]
    assert before.groupBy("sequence_id").sum("length").agg({"sum(length)": "max"}).first()[0] <= 1024
    whole = corpus_pipeline.run(spark, DATA)
    assert whole.count() == rows["packing"][1]
    for df in (before,):
        df.unpersist()

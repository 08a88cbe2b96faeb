"""Toxicity: held-out accuracy, what is learned from, and odd tables."""

import zlib

from conftest import DATA
from odd import no_docs, odd_docs
from pyspark.sql import functions as F

from wattline.llm.toxicity import (
    FEATURES,
    Lexicon,
    features,
    held_out,
    learnable,
    score_toxicity,
    without_toxic,
)

LABELS = "doc_id long, quality int, toxic int"


def made(spark, n=600):
    """Documents of which those with a marked word are toxic, in any spelling of its ending."""
    words = ["alpha", "bravo", "charlie", "delta", "echo", "golf"]
    rows, labels = [], []
    for i in range(n):
        text = [words[(i * 7 + k * k) % 6] for k in range(30 + i % 11)]
        toxic = i % 4 == 0
        if toxic:
            text[5], text[9] = ["blorp", "Blorpish", "blorpo"][i % 3], "fnord"
        rows.append((i, " ".join(text), "en", "s", 0))
        labels.append((i, 1, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return docs, spark.createDataFrame(labels, LABELS)


def test_held_out_accuracy(spark):
    docs, labels = made(spark)
    got = score_toxicity(docs, labels).join(labels, "doc_id").collect()
    assert len(got) == 600
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    mine = [r for r in got if r.held_out]
    assert sum(r.predicted == r.toxic for r in mine) >= 0.98 * len(mine)


def test_held_out_rows_and_other_columns_teach_nothing(spark):
    docs, labels = made(spark, 400)
    wrong = labels.withColumn("toxic", F.when(held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    other = docs.withColumns({"lang": F.lit("xx"), "source": F.col("doc_id").cast("string")})
    first = sorted(score_toxicity(docs, labels).select("doc_id", "score").collect())
    assert sorted(score_toxicity(other, wrong).select("doc_id", "score").collect()) == first
    rows = learnable(docs, labels, 100)
    assert rows.count() == 100 and rows.where("calibrate").count() > 0


def test_toxic_documents_go_and_clean_ones_stay(spark):
    docs, labels = made(spark)
    kept = without_toxic(docs, labels)
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.collect()}
    assert len([i for i in range(600) if i % 4 and i in ids]) >= 440
    assert len([i for i in range(0, 600, 4) if i in ids]) <= 3


def test_features():
    lexicon = Lexicon({"idiot": 3.0}, {"blor": 2.0})
    found = dict(zip(FEATURES, features("You are an IDIOT! id10t i d i o t blorping ok?", lexicon)))
    assert found["hits_per_word"] > 0 and found["stem_hits_per_word"] > found["hits_per_word"]
    assert found["largest_weight"] == 3.0 and found["distinct_hits"] == 2
    assert found["disguised_hits_per_word"] > 0 and found["second_person_proximity"] == 0.25
    assert found["exclamations_per_char"] > 0 and found["questions_per_char"] > 0
    assert len(features("", lexicon)) == len(FEATURES) and not any(features("", lexicon))
    assert len(features("x" * 200_000 + " 1a1" * 50_000, lexicon)) == len(FEATURES)


def test_odd_tables(spark):
    docs, labels = made(spark, 200)
    odd = odd_docs(spark)
    both = docs.unionByName(odd.select(docs.columns))
    messy = labels.unionByName(spark.createDataFrame([(1, 0, None), (None, 1, 1), (2, 1, 7), (3, 1, 0)], LABELS))
    assert score_toxicity(both, messy).count() == 200 + odd.count()
    none = spark.createDataFrame([], LABELS)
    scores = score_toxicity(odd, none)
    assert {(r.score, r.predicted) for r in scores.collect()} == {(0.0, 0)} and scores.count() == odd.count()
    only = labels.where("toxic = 1")
    assert {r.score for r in score_toxicity(docs, only).collect()} == {1.0}
    assert score_toxicity(no_docs(spark), labels).count() == 0
    kept = without_toxic(odd, none)
    assert kept.columns == odd.columns and kept.count() == odd.count()


def test_given_tables(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    assert score_toxicity(docs, spark.read.parquet(f"{DATA}/labels.parquet")).count() == docs.count()

"""Mixing: targets by hand, budgets to the word, reruns, repeats, odd tables."""

from collections import defaultdict

import pytest
from conftest import DATA
from odd import DOCS, no_docs, odd_docs
from pyspark.sql import functions as F

from wattline.llm.common import running_totals
from wattline.llm.mixing import mix_plan, mixed_documents


def docs_of(spark, sizes):
    """Documents of given sizes for each source."""
    rows = []
    for source, counts in sizes.items():
        rows += [(len(rows) + i, " ".join(["w"] * n), "en", source, max(0, 2 * n - 1)) for i, n in enumerate(counts)]
    return spark.createDataFrame(rows, DOCS)


def targets(sizes, weights=(5, 2, 1), ratio=1.5, cap=2.0):
    """Share, cap, share again what is left over."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, capped = ratio * sum(sizes.values()), {}
    while True:
        open_ = [s for s in order if s not in capped]
        level = left / sum(weight[s] for s in open_) if open_ else 0
        above = [s for s in open_ if weight[s] * level > cap * sizes[s]]
        if not above:
            return capped | {s: weight[s] * level for s in open_}
        for s in above:
            capped[s] = cap * sizes[s]
            left -= capped[s]


@pytest.mark.parametrize(
    "sizes",
    [
        {"a": [10] * 10, "b": [10] * 10, "c": [10] * 10},
        {"a": [1, 2, 3], "b": [100] * 30, None: [7] * 9, "Z": [5], "é": [50] * 4},
        {"a": [0, 0], "b": [3, 5]},
        {"a": [1000]},
    ],
)
def test_targets_and_budgets(spark, sizes):
    rows = mix_plan(docs_of(spark, sizes)).collect()
    total = {s: sum(counts) for s, counts in sizes.items()}
    wanted = targets(total)
    taken = defaultdict(int)
    source = {r.doc_id: r.source for r in docs_of(spark, sizes).collect()}
    for r in rows:
        s = source[r.doc_id]
        assert r.source_size == total[s] and r.target == pytest.approx(wanted[s])
        assert 0 <= r.taken <= 2 * r.size
        taken[s] += r.taken
    assert {s: taken[s] for s in total} == {s: int(wanted[s] + 1e-9) for s in total}


def test_reruns_and_partitions_agree(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    first = sorted(mix_plan(docs).collect())
    assert sorted(mix_plan(docs.repartition(7)).collect()) == first
    assert sorted(mix_plan(docs, seed="other").collect()) != first


def test_documents_are_repeated_cut_and_left_out(spark):
    docs = docs_of(spark, {"a": [4] * 5, "b": [9] * 20, "c": [3] * 3})
    plan = {r.doc_id: r for r in mix_plan(docs).collect()}
    rows = defaultdict(list)
    for r in mixed_documents(docs).collect():
        rows[r.doc_id].append(len(r.text.split()))
        assert r.n_chars == len(r.text)
    assert {i: sum(v) for i, v in rows.items()} == {i: p.taken for i, p in plan.items() if p.taken}
    assert any(len(v) > 1 for v in rows.values())
    for i, v in rows.items():
        assert all(n == plan[i].size for n in v[:-1]) or sorted(v)[1:] == [plan[i].size] * (len(v) - 1)


def test_running_totals_of_a_group_over_many_partitions(spark):
    df = spark.range(1000).select(F.when(F.col("id") % 3 > 0, F.lit("hot")).alias("g"), F.col("id").alias("o"), (F.col("id") % 5).alias("v"))
    got = running_totals(df, ["g"], ["o"], {"v": "before"}, "test").collect()
    sums = defaultdict(int)
    for r in sorted(got, key=lambda r: r.o):
        assert r.before == sums[r.g]
        sums[r.g] += r.v
    assert len(got) == 1000


def test_odd_tables(spark):
    docs = odd_docs(spark)
    plan = mix_plan(docs)
    assert plan.count() == docs.count()
    assert plan.where("doc_id = 4").first().taken == 0
    totals = plan.agg(F.sum("taken"), F.sum("size")).first()
    assert totals[0] <= 1.5 * totals[1] <= totals[0] + 3
    assert mix_plan(no_docs(spark)).count() == 0 and mixed_documents(no_docs(spark)).count() == 0
    one = docs.where("doc_id IN (1, 7, 9)")
    assert mixed_documents(one).columns == docs.columns
    nothing = docs.where("doc_id IN (4, 5, 6)")
    assert [r.taken for r in mix_plan(nothing).collect()] == [0, 0, 0] and mixed_documents(nothing).count() == 0


def test_repeated_rows_and_rows_without_id_are_taken_each_for_itself(spark):
    rows = [(1, "a b c d", "en", "s", 7)] * 4 + [(None, t, "en", "s", len(t)) for t in ("e f", "g h i j", "")]
    docs = spark.createDataFrame(rows, DOCS)
    taken = mix_plan(docs).agg(F.sum("taken")).first()[0]
    mixed = mixed_documents(docs).collect()
    assert taken == 33 and sum(len(r.text.split()) for r in mixed) == taken
    copies = sorted(-(-r.taken // r.size) for r in mix_plan(docs).where("taken > 0").collect())
    assert len(mixed) == sum(copies) <= 12


def test_texts_are_read_once(spark):
    """Everything after the table of sizes works on it."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    plan = mix_plan(docs)._jdf.queryExecution().toString()
    assert "documents.parquet" not in plan and "text" not in plan

"""Mixing sources to target weights."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattline.llm.common import SPACE, materialize, running_totals, word_count


def source_targets(
    sizes: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    ratio: float = 1.5,
    max_repeats: float = 2.0,
) -> DataFrame:
    """One row per source with its size and target (``mix_key``, ``source_size``, ``target``).

    Sources in code point order, null last, take the weights in turn and share ``ratio`` times
    all sizes. A target stops at ``max_repeats`` times its source's size; what is left over is
    shared by weight among the others, until no target is above. With sources in the order of
    cap / weight, the level of the uncapped ones is the largest of (total - caps before) /
    (weights from here on): it rises while sources hit their caps and falls afterwards.
    The windows span one row per source, never rows of documents: all sources are compared in one
    task, which suits some million of them.
    """
    per_source = sizes.groupBy("mix_key").agg(F.sum("size").alias("source_size"))
    turn = F.row_number().over(Window.orderBy(F.col("mix_key").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (turn % len(weights) + 1).cast("int"))
    caps = per_source.withColumn("weight", weight).withColumn(
        "cap", F.col("source_size") * F.lit(float(max_repeats))
    )
    everything = Window.partitionBy()
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.col("mix_key").asc_nulls_last())
    earlier = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_cap.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (
        F.sum("source_size").over(everything) * F.lit(float(ratio))
        - F.coalesce(F.sum("cap").over(earlier), F.lit(0.0))
    ) / F.sum("weight").over(onward)
    return (
        caps.withColumn("level", level)
        .withColumn("level", F.max("level").over(everything))
        .select("mix_key", "source_size", F.least("cap", F.col("weight") * F.col("level")).alias("target"))
    )


def mix_plan(
    docs: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    ratio: float = 1.5,
    max_repeats: float = 2.0,
    seed: str = "mix",
) -> DataFrame:
    """What the mix takes of each document: doc_id, size, source_size, target, taken.

    Size is the number of words. Documents of a source get a hash-random key, are sorted by it
    in ranges, and take their words in that order: whole epochs over the source first, then the
    rest of the target, cut inside the document where the budget ends. So a source's taken words
    are exactly its target, rounded down, and no document gives more than ``max_repeats`` times
    its words, rounded up to whole epochs. The key depends on doc_id and seed alone: reruns agree.

    Null text has size 0 and takes nothing. A null source is a source, a null doc_id a value.
    Repeated rows are rows of their own; with equal ids the shorter comes first. An empty table
    gives an empty plan. Other columns of ``docs`` play no part. Texts are read once.
    """
    numbered = docs.withColumn("_mix_row", F.monotonically_increasing_id())
    return _planned(numbered, weights, ratio, max_repeats, seed).drop("_mix_row")


def _planned(
    docs: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    ratio: float = 1.5,
    max_repeats: float = 2.0,
    seed: str = "mix",
) -> DataFrame:
    """The plan with the number ``_mix_row`` that each row of ``docs`` has, which orders equal ones."""
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    sizes = docs.select(
        "_mix_row",
        "doc_id",
        F.col("source").alias("mix_key"),
        word_count(F.col("text")).alias("size"),
        key.alias("key"),
    )
    # Written once: the sizes are summed, sampled for ranges, dealt and placed.
    sizes = materialize(sizes, "mix-sizes")
    placed = running_totals(sizes, ["mix_key"], ["key", "doc_id", "size", "_mix_row"], {"size": "before"}, "mix")
    targets = source_targets(sizes, weights, ratio, max_repeats).withColumnRenamed("mix_key", "target_key")
    budget = F.floor("target").cast("bigint")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0)
    rest = budget - F.col("epochs") * F.col("source_size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("before")))
    return (
        placed.join(targets, F.col("mix_key").eqNullSafe(F.col("target_key")))
        .withColumn("epochs", epochs.cast("bigint"))
        .select(
            "_mix_row",
            "doc_id",
            "size",
            "source_size",
            "target",
            (F.col("epochs") * F.col("size") + part).cast("bigint").alias("taken"),
        )
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix: one row for each epoch that takes words of a document.

    The last of a document's rows holds only the words taken, joined by one space, if the budget
    ends inside it. Columns are those of ``docs``; ``n_chars``, where there is one, follows the
    text. Documents of which nothing is taken go. Rows get numbers, which are written with them, so
    repeated rows and rows without doc_id are taken each for itself.
    """
    numbered = materialize(docs.withColumn("_mix_row", F.monotonically_increasing_id()), "mix-rows")
    plan = _planned(numbered, **options).where("taken > 0").select(
        "_mix_row", F.col("size").alias("_mix_size"), F.col("taken").alias("_mix_taken")
    )
    whole = F.floor(F.col("_mix_taken") / F.col("_mix_size"))
    copies = F.ceil(F.col("_mix_taken") / F.col("_mix_size"))
    rows = (
        numbered.join(plan, "_mix_row")
        .withColumn("_mix_words", F.col("_mix_taken") - whole * F.col("_mix_size"))
        .withColumn("_mix_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), copies)))
        .withColumn("_mix_cut", (F.col("_mix_copy") == copies) & (F.col("_mix_words") > 0))
    )
    words = F.filter(F.split("text", SPACE), lambda word: word != "")
    cut = F.concat_ws(" ", F.slice(words, 1, F.col("_mix_words").cast("int")))
    text = F.when(F.col("_mix_cut"), cut).otherwise(F.col("text"))
    changed = {"text": text}
    if "n_chars" in docs.columns:
        length = F.when(F.col("_mix_cut"), F.length(cut)).otherwise(F.col("n_chars"))
        changed["n_chars"] = length.cast(docs.schema["n_chars"].dataType)
    return rows.select(*((changed[c].alias(c) if c in changed else F.col(c)) for c in docs.columns))


#: The same plan as SQL.
MIX_SQL = r"""
WITH sizes AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents),
per_source AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1 AS turn
  FROM sizes GROUP BY source),
caps AS (
  SELECT source, source_size, source_size * 2.0::DOUBLE AS cap,
         (CASE turn % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END)::DOUBLE AS weight, turn
  FROM per_source),
levels AS (
  SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(cap) OVER (
               ORDER BY cap / weight, turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (
               ORDER BY cap / weight, turn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM caps),
targets AS (
  SELECT source, source_size, least(cap, weight * max(level) OVER ()) AS target FROM levels),
placed AS (
  SELECT s.doc_id, s.size, t.source_size, t.target, floor(t.target)::BIGINT AS budget,
         coalesce(sum(s.size) OVER (
           PARTITION BY s.source ORDER BY md5('mix:' || coalesce(s.doc_id::VARCHAR, '')), s.doc_id, s.size
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
epoch AS (
  SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS epochs FROM placed)
SELECT doc_id, size, source_size, target,
       (epochs * size + greatest(0, least(size, budget - epochs * source_size - before)))::BIGINT AS taken
FROM epoch
"""

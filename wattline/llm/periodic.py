"""Stretches of a text that repeat with a period: found through a grammar, and cut to one period."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.llm.common import SPACE, small_batches
from wattline.llm.hashing import words_of
from wattline.llm.recompression import Grammar

MIN_LENGTH, MIN_REPEATS = 24, 3
#: Texts are taken together up to so many words, and candidates are looked at in parts of this size.
BATCH_WORDS = 300_000
CANDIDATES = 500_000

RUN = "struct<start:bigint,length:bigint,period:bigint>"
_RUN_TYPE = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def grid_candidates(
    sequence: np.ndarray, longest: int, min_length: int, min_repeats: int, part: int = CANDIDATES
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions and periods at which a run must show, in parts.

    A run of period q and length of at least max(min_length, min_repeats * q) has that many
    positions less q whose symbol comes again q later, side by side. So one of them is a multiple
    of that number. Over all periods the grids have about n log(n) points, as a harmonic sum.
    """
    size = len(sequence)
    periods = np.arange(1, longest // min_repeats + 1, dtype=np.int64)
    steps = np.maximum(min_length - periods, (min_repeats - 1) * periods)
    points = (size - periods - 1) // steps + 1
    before = np.cumsum(points) - points
    start = 0
    while start < len(periods):
        end = max(start + 1, int(np.searchsorted(before, before[start] + part)))
        many = points[start:end]
        number = np.arange(int(many.sum()), dtype=np.int64) - np.repeat(before[start:end] - before[start], many)
        at = number * np.repeat(steps[start:end], many)
        period = np.repeat(periods[start:end], many)
        equal = sequence[at] == sequence[at + period]
        yield at[equal], period[equal]
        start = end


def periodic_stretches(
    sequence: np.ndarray, longest: int, min_length: int = MIN_LENGTH, min_repeats: int = MIN_REPEATS
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and smallest periods of all runs, by start and end.

    ``sequence`` begins and ends with a symbol that occurs once, and has one between any two texts;
    ``longest`` is the length of the longest text. A candidate is extended both ways by the grammar,
    which makes it maximal. A stretch found with several periods has its smallest one among them:
    three of each fit, so the others are multiples of it.
    """
    grammar = Grammar(sequence)
    found = [np.empty((0, 3), dtype=np.int64)]
    for at, period in grid_candidates(sequence, longest, min_length, min_repeats):
        ahead = grammar.extensions(at, at + period)
        back = grammar.extensions(at, at + period, backwards=True)
        start, end = at - back, at + ahead + period
        runs = np.stack((start, end, period), axis=1)[end - start >= np.maximum(min_length, min_repeats * period)]
        found.append(np.unique(runs, axis=0))
    runs = np.unique(np.concatenate(found), axis=0)
    first = np.ones(len(runs), dtype=bool)
    first[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    start, end, period = runs[first].T
    return start, end, period


def collapsed_texts(
    texts: list[list[bytes]], min_length: int = MIN_LENGTH, min_repeats: int = MIN_REPEATS
) -> list[tuple[list[tuple[int, int, int]], bytes]]:
    """For each text its runs (start, length, period) by start, and its words without repeats."""
    sizes = np.array([len(words) for words in texts], dtype=np.int64)
    # A symbol of its own stands before every text and after the last.
    begins = np.cumsum(sizes + 1) - sizes
    every = [word for words in texts for word in words]
    names, distinct = pd.factorize(np.array([*every, b""], dtype=object)[:-1])
    sequence = np.empty(len(every) + len(texts) + 1, dtype=np.int64)
    own = np.ones(len(sequence), dtype=bool)
    own[begins - 1] = own[-1] = False
    sequence[own] = names
    sequence[~own] = len(distinct) + np.arange(len(texts) + 1)
    longest = int(sizes.max(initial=0))
    if longest < max(min_length, min_repeats):
        return [([], b" ".join(words)) for words in texts]
    start, end, period = periodic_stretches(sequence, longest, min_length, min_repeats)
    change = np.zeros(len(sequence) + 1, dtype=np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, end, -1)
    gone = np.cumsum(change) > 0
    text = np.searchsorted(begins, start, side="right") - 1
    runs: dict[int, list[tuple[int, int, int]]] = {}
    for i, s, e, p in zip(text.tolist(), start.tolist(), end.tolist(), period.tolist(), strict=True):
        runs.setdefault(i, []).append((s - int(begins[i]), e - s, p))
    results = []
    for i, words in enumerate(texts):
        own_runs = sorted(runs.get(i, []), key=lambda run: (run[0], run[2]))
        if own_runs:
            dropped = gone[begins[i] : begins[i] + sizes[i]]
            words = [word for word, drop in zip(words, dropped.tolist(), strict=True) if not drop]
        results.append((own_runs, b" ".join(words)))
    return results


def periodic_runs(docs: DataFrame, min_length: int = MIN_LENGTH, min_repeats: int = MIN_REPEATS) -> DataFrame:
    """The rows of ``docs`` with ``runs``, the periodic stretches of their words, and ``collapsed``.

    A run is a stretch of words in which words ``period`` apart are equal, with that smallest
    period, of at least ``min_length`` words and ``min_repeats`` periods, that cannot be extended on
    either side. ``runs`` is an array of (start, length, period) by start, then period, in words
    from 0. ``collapsed`` holds the words that no run contains after its first period, joined by
    one space. Runs may overlap, as when a period changes half way.

    Texts are taken whole, a batch at a time, in the task that reads them: nothing is shuffled. A
    batch is one sequence with a symbol of its own between any two texts; a run-length grammar of it
    (``recompression``) answers how far each candidate extends. The memory of a task follows
    ``BATCH_WORDS`` or the longest text, whichever is more, at some 200 bytes a word.

    A null or empty text, or one of white space, has no run and collapses to an empty text. Equal
    rows give equal results. An empty table gives no rows. All columns of ``docs`` stay but two of
    the new names, which are replaced.
    """
    docs = docs.drop("runs", "collapsed")
    small_batches(docs.sparkSession)

    def finish(rows: list[pa.RecordBatch], texts: list[list[bytes]]) -> Iterator[pa.RecordBatch]:
        found = collapsed_texts(texts, min_length, min_repeats)
        done = 0
        for batch in rows:
            mine = found[done : done + batch.num_rows]
            done += batch.num_rows
            runs = pa.array(
                [[{"start": s, "length": n, "period": p} for s, n, p in runs] for runs, _ in mine],
                pa.list_(_RUN_TYPE),
            )
            collapsed = pa.array([text.decode("utf-8", "replace") for _, text in mine], pa.string())
            names = [*batch.schema.names, "runs", "collapsed"]
            yield pa.RecordBatch.from_arrays([*batch.columns, runs, collapsed], names=names)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[pa.RecordBatch] = []
        texts: list[list[bytes]] = []
        size = 0
        for whole in batches:
            at = whole.schema.names.index("text")
            column = whole.column(at).to_pylist()
            begin = 0
            for i, text in enumerate(column):
                texts.append(words_of(text))
                size += len(texts[-1])
                if size >= BATCH_WORDS:
                    yield from finish([*rows, whole.slice(begin, i + 1 - begin)], texts)
                    rows, texts, size, begin = [], [], 0, i + 1
            if begin < len(column):
                rows.append(whole.slice(begin))
        if rows:
            yield from finish(rows, texts)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(work, f"{fields}, runs array<{RUN}>, collapsed string")


def strongest(runs: Column) -> Column:
    """The run with the greatest length / period, exactly; of equal ones the first, then shortest."""

    def better(best: Column, run: Column) -> Column:
        ahead, behind = run["length"] * best["period"], best["length"] * run["period"]
        earlier = (run["start"] < best["start"]) | (
            (run["start"] == best["start"]) & (run["period"] < best["period"])
        )
        return F.when(best.isNull() | (ahead > behind) | ((ahead == behind) & earlier), run).otherwise(best)

    return F.aggregate(runs, F.lit(None).cast(RUN), better)


def with_planted_tails(docs: DataFrame) -> DataFrame:
    """doc_id and text, where every tenth document (by crc32 of its doc_id) ends in a repetition.

    From word a on, its words are those of a stretch of p words over and over: with g the tenth of
    the crc32 and n words, a = g % n and p = 1 + (n - a) / (3 + g % 8), rounded down. Documents
    without words or without doc_id stay as they are.
    """
    crc = F.crc32(F.col("doc_id").cast("string"))
    words = F.filter(F.split("text", SPACE), lambda word: word != "")
    g = F.expr("crc DIV 10")
    tenth = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        "text",
        F.coalesce(crc, F.lit(1)).alias("crc"),
    ).withColumn("words", F.when(F.col("crc") % 10 == 0, words))
    planted = F.col("words").isNotNull() & (F.size("words") > 0)
    n = F.size("words").cast("bigint")
    start = F.when(planted, g % n).cast("int")
    period = (F.lit(1) + F.floor((n - F.col("a")) / (F.lit(3) + g % 8))).cast("int")
    placed = tenth.withColumn("a", start).withColumn("p", period)
    # The stretch as often as it takes, cut to the length of the text.
    stretch = F.slice("words", F.col("a") + 1, F.col("p"))
    times = F.ceil((n - F.col("a")) / F.col("p")).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(stretch, times)), F.lit(1), (n - F.col("a")).cast("int"))
    text = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a")), tail), " ")
    return placed.select("doc_id", F.when(planted, text).otherwise(F.col("text")).alias("text"))


def run_report(docs: DataFrame) -> DataFrame:
    """One row per document: n_runs, the strongest run, and digests of all runs and of what is kept.

    Documents are those of ``with_planted_tails``. See ``periodic_runs`` for runs, nulls, empty and
    repeated rows.
    """
    found = periodic_runs(with_planted_tails(docs)).withColumn("top", strongest(F.col("runs")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        "top.start",
        "top.length",
        "top.period",
        F.expr("(1000 * top.length) DIV top.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )

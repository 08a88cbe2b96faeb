"""Removal of passages that other documents have, located by Aho-Corasick automata."""

from __future__ import annotations

import hashlib
import math
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.llm.common import materialize
from wattline.llm.hashing import WordHasher, words_of
from wattline.session import work_folder

SEED_WORDS = 5
#: A chunk is a task of its own up to so many; the driver keeps an entry for every file of them.
MOST_PARTS = 50_000
NO_ID = np.iinfo("int64").max
EMPTY = np.empty(0, dtype="<u8")


def seeds(hasher: WordHasher, words: list[bytes], window: int) -> np.ndarray:
    """For each window of words, the smallest hash of its runs of five words.

    Equal windows have equal seeds, and neighbours mostly the same one, so seeds are about a fifth
    as many as windows.
    """
    runs = hasher.runs(words, SEED_WORDS)
    width = window - SEED_WORDS + 1
    if len(runs) < width:
        return EMPTY
    return np.lib.stride_tricks.sliding_window_view(runs, width).min(axis=1)


def _by_bucket(buckets: int, chunk: int, tokens: np.ndarray, values: np.ndarray) -> Iterator[tuple]:
    """Rows (bucket, chunk, tokens, values) of sorted tokens."""
    where = ((tokens >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    edges = np.searchsorted(where, np.arange(buckets + 1, dtype=np.uint64))
    for i, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
        if a < b:
            yield i, chunk, tokens[a:b].astype("<u8").tobytes(), values[a:b].astype("<i8").tobytes()


def _arrays(frame: pd.DataFrame, *columns: str) -> list[np.ndarray]:
    """The packed arrays of a chunk's answers, ordered by the first."""
    found = []
    for column in columns:
        kind = "<u8" if column == "tokens" else "<i8"
        found.append(np.concatenate([np.frombuffer(x, kind) for x in frame[column]] or [np.empty(0, kind)]))
    order = np.argsort(found[0])
    return [x[order] for x in found]


def _known(tokens: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """For each wanted token its place among the sorted tokens, -1 if it is not there."""
    if not len(tokens):
        return np.full(len(wanted), -1)
    place = np.minimum(np.searchsorted(tokens, wanted), len(tokens) - 1)
    return np.where(tokens[place] == wanted, place, -1)


SENT = "bucket int, chunk bigint, tokens binary, values binary"
ANSWERED = "chunk bigint, tokens binary, values binary"


def shared_seeds(texts: DataFrame, window: int, buckets: int) -> DataFrame:
    """For each chunk, its seeds that more than one document has.

    A chunk sends each of its seeds once, with whether several of its documents have it.
    """

    def send(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        hasher = WordHasher()
        found = [np.unique(seeds(hasher, words_of(text), window)) for text in frame.text]
        tokens, counts = np.unique(np.concatenate([EMPTY, *found]), return_counts=True)
        rows = _by_bucket(buckets, key[0], tokens, np.minimum(counts, 2))
        return pd.DataFrame(rows, columns=["bucket", "chunk", "tokens", "values"])

    def answer(frame: pd.DataFrame) -> pd.DataFrame:
        parts = [np.frombuffer(x, "<u8") for x in frame["tokens"]]
        _, place = np.unique(np.concatenate(parts), return_inverse=True)
        counts = np.concatenate([np.frombuffer(x, "<i8") for x in frame["values"]])
        several = np.bincount(place, weights=counts)[place] > 1
        rows, at = [], 0
        for chunk, part in zip(frame["chunk"], parts, strict=True):
            rows.append((chunk, part[several[at : at + len(part)]].tobytes(), b""))
            at += len(part)
        return pd.DataFrame(rows, columns=["chunk", "tokens", "values"])

    sent = texts.select("chunk", "text").groupBy("chunk").applyInPandas(send, SENT)
    return sent.groupBy("bucket").applyInPandas(answer, ANSWERED)


def window_owners(texts: DataFrame, found: DataFrame, window: int, buckets: int) -> DataFrame:
    """For each chunk, its windows that a smaller doc_id may have, with the smallest doc_id.

    Only windows with a shared seed are looked at. A chunk sends each window once, with its
    smallest doc_id, made negative if several documents of the chunk have it; a bucket answers
    where that is not the smallest of all or where several documents of the chunk need to know.
    """

    def send(key: tuple, docs: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        (shared,) = _arrays(known, "tokens")
        hasher, tokens, owners = WordHasher(), [EMPTY], [np.empty(0, dtype="<i8")]
        for doc, text in zip(docs.order_id, docs.text, strict=True):
            words = words_of(text)
            some = _known(shared, seeds(hasher, words, window)) >= 0
            mine = np.unique(hasher.runs(words, window)[some])
            tokens.append(mine)
            owners.append(np.full(len(mine), doc))
        tokens, owners = np.concatenate(tokens), np.concatenate(owners)
        order = np.lexsort((owners, tokens))
        tokens, owners = tokens[order], owners[order]
        head = np.ones(len(tokens), dtype=bool)
        head[1:] = tokens[1:] != tokens[:-1]
        last = np.append(head[1:], True)
        first, final = owners[head], owners[last]
        rows = _by_bucket(buckets, key[0], tokens[head], np.where(first < final, ~first, first))
        return pd.DataFrame(rows, columns=["bucket", "chunk", "tokens", "values"])

    def answer(frame: pd.DataFrame) -> pd.DataFrame:
        parts = [np.frombuffer(x, "<u8") for x in frame["tokens"]]
        sent = np.concatenate([np.frombuffer(x, "<i8") for x in frame["values"]])
        tokens, place = np.unique(np.concatenate(parts), return_inverse=True)
        own = np.where(sent < 0, ~sent, sent)
        least = np.full(len(tokens), NO_ID)
        np.minimum.at(least, place, own)
        least = least[place]
        needed = (least < own) | (sent < 0)
        rows, at = [], 0
        for chunk, part in zip(frame["chunk"], parts, strict=True):
            here = slice(at, at + len(part))
            rows.append((chunk, part[needed[here]].tobytes(), least[here][needed[here]].tobytes()))
            at += len(part)
        return pd.DataFrame(rows, columns=["chunk", "tokens", "values"])

    sent = (
        texts.select("chunk", "order_id", "text")
        .groupBy("chunk")
        .cogroup(found.groupBy("chunk"))
        .applyInPandas(send, SENT)
    )
    return sent.groupBy("bucket").applyInPandas(answer, ANSWERED)


def passages(owners: np.ndarray, doc: int, window: int) -> list[tuple[int, int]]:
    """The maximal runs of windows that a smaller document has, as (first, last) word."""
    repeated = np.concatenate(([False], owners < doc, [False]))
    edges = np.flatnonzero(repeated[1:] != repeated[:-1])
    return [(int(a), int(b) + window - 1) for a, b in zip(edges[::2], edges[1::2], strict=True)]


class PassageAutomaton:
    """All passages of a shard in one automaton; each knows the owner of each of its windows."""

    def __init__(self, found: dict[str, np.ndarray]):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for passage, owners in found.items():
            self.automaton.add_word(f" {passage} ", (len(passage) + 2, owners))
        self.empty = not found
        if found:
            self.automaton.make_automaton()

    def covered(self, words: list[bytes], doc: int, window: int) -> np.ndarray:
        """Which words lie in a window of a passage that a smaller document owns."""
        marks = np.zeros(len(words) + 1, dtype=np.int64)
        if self.empty or len(words) < window:
            return marks[:-1] > 0
        text = " " + b" ".join(words).decode("utf-8", "surrogatepass") + " "
        starts: dict[int, int] = {}
        at = 0
        for number, part in enumerate(text[1:-1].split(" ")):
            starts[at] = number
            at += len(part) + 1
        for end, (length, owners) in self.automaton.iter(text):
            word = starts[end - length + 1]
            for a, b in passages(owners, doc, window):
                marks[word + a] += 1
                marks[word + b] -= 1
        return np.cumsum(marks)[:-1] > 0


def without_passages(texts: DataFrame, owners: DataFrame, window: int) -> DataFrame:
    """The words that stay of each document, chunk by chunk.

    The lookup of each document's windows locates its passages. Each chunk's shard is an automaton
    of these; all its documents stream through it, which finds the same passages again.
    """

    def locate(key: tuple, docs: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        tokens, least = _arrays(known, "tokens", "values")
        hasher, found = WordHasher(), {}
        for doc, text in zip(docs.order_id, docs.text, strict=True):
            words = words_of(text)
            place = _known(tokens, hasher.runs(words, window))
            own = np.where(place >= 0, least[place] if len(least) else NO_ID, NO_ID)
            for a, b in passages(own, doc, window):
                passage = b" ".join(words[a:b]).decode("utf-8", "surrogatepass")
                # The owners are the windows' own, whichever document they are read from.
                found[passage] = own[a : b - window + 1]
        automaton = PassageAutomaton(found)
        rows = []
        for doc, text in zip(docs.order_id, docs.text, strict=True):
            words = words_of(text)
            gone = automaton.covered(words, doc, window)
            kept = b" ".join(word for word, out in zip(words, gone, strict=True) if not out)
            rows.append((doc, len(words), int(gone.sum()), hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "replace")))
        columns = ["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"]
        return pd.DataFrame(rows, columns=columns)

    kept = (
        texts.select("chunk", "order_id", "text")
        .groupBy("chunk")
        .cogroup(owners.groupBy("chunk"))
        .applyInPandas(
            locate, "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, kept_text string"
        )
    )
    return kept.withColumn("doc_id", F.when(F.col("doc_id") != int(NO_ID), F.col("doc_id")))


def remove_repeated_passages(
    docs: DataFrame,
    window: int = 13,
    with_text: bool = False,
    chunk_docs: int = 2_000,
    bucket_tokens: int = 2_000_000,
) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256, and ``kept_text`` if asked for.

    Words are cut by ASCII white space and compared unchanged. Every word goes that is covered by a
    window of ``window`` words which a document with a smaller doc_id has as well, judged on the
    input. Windows that share a seed (see ``seeds``) are compared by 64-bit hashes in buckets, which
    confirms the recurring ones and finds their smallest doc_id. Passages, the maximal runs of such
    windows, are located by looking up each document's windows by hash and compiled into Aho-Corasick
    automata, one per chunk of documents; every document streams through its chunk's automaton, which
    only finds them again. Documents are dealt to chunks once, as a bucketed table,
    and stay there. What a chunk sends of a passage does not depend on how many of its documents
    have it, so a passage in a third of all documents is one entry per chunk.

    A null text has no words. A null doc_id counts as larger than all others. Rows with equal ids
    do not remove from each other. An empty table gives no rows. Other columns play no part.
    """
    spark = docs.sparkSession
    size = docs.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.length("text")).alias("chars")).first()
    chars = size["chars"] or 0
    chunks = max(1, math.ceil(max(size["rows"] / chunk_docs, chars / (chunk_docs * 4_000))))
    parts = min(chunks, MOST_PARTS)
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(int(NO_ID))).alias("order_id"),
        "text",
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)).alias("chunk"),
    )
    table = f"llm_chunks_{uuid.uuid4().hex}"
    (
        rows.repartition(parts, "chunk")
        .write.format("parquet")
        .bucketBy(parts, "chunk")
        .option("compression", "zstd")
        .option("path", work_folder(spark, "chunks"))
        .saveAsTable(table)
    )
    try:
        texts = spark.table(table)
        # A seed for about every fifth of some six characters; a window for each of the shared ones.
        buckets = max(1, math.ceil(chars / 30 / bucket_tokens))
        found = materialize(shared_seeds(texts, window, buckets), "seeds")
        owners = materialize(window_owners(texts, found, window, buckets), "owners")
        kept = without_passages(texts, owners, window)
        if not with_text:
            kept = kept.drop("kept_text")
        return materialize(kept, "kept")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")


#: The same as SQL.
PHRASES_SQL = r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(words[i:i + 12], ' ') AS phrase
  FROM docs, unnest(range(1, len(words) - 11)) AS t(i)),
owners AS (
  SELECT phrase, min(doc_id) AS owner FROM windows GROUP BY phrase HAVING count(DISTINCT doc_id) > 1),
gone AS (
  SELECT DISTINCT w.doc_id, w.i + k AS i
  FROM windows w JOIN owners o ON w.phrase = o.phrase AND o.owner < w.doc_id, unnest(range(13)) AS u(k)),
words AS (
  SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM docs),
kept AS (
  SELECT w.doc_id, count(g.i) AS n_removed,
         string_agg(CASE WHEN g.i IS NULL THEN w.word END, ' ' ORDER BY w.i) AS kept
  FROM words w LEFT JOIN gone g ON w.doc_id = g.doc_id AND w.i = g.i GROUP BY w.doc_id)
SELECT d.doc_id, len(d.words)::BIGINT AS n_words, coalesce(k.n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(k.kept, '')) AS kept_sha256
FROM docs d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""

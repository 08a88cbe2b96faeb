"""Packing documents into sequences: shortest-pack-first over the length histogram."""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.llm.common import filled, materialize, ranked, small_batches, unfilled

PIECES = "doc_id bigint, copy bigint, doc_tokens bigint, start bigint, length bigint, ids_crc32 bigint"


#: Runs of white space (as the tokenizer's pattern knows it) that are too long for its matcher.
LONG_SPACE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{10000,}")


def byte_bpe(path: str):
    """An encoder over the vocabulary of a byte-level BPE file; a worker keeps it between tasks.

    It gives the ids of the ``tokenizers`` library for that file (tests compare them) at about
    four times its speed. Strings of the file's added tokens get the ids of these, as there.
    """
    import public_tokenizers
    import tiktoken
    from tiktoken.registry import ENCODINGS

    if path not in ENCODINGS:
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        vocabulary = content["model"]["vocab"]
        added = {token["content"]: token["id"] for token in content.get("added_tokens") or ()}
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        letters = {chr(b): b for b in plain}
        letters |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))}
        ranks = {}
        for token, rank in vocabulary.items():
            if all(c in letters for c in token) and token not in added:
                ranks[bytes(letters[c] for c in token)] = rank
        ENCODINGS[path] = tiktoken.Encoding(
            "byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=added
        )
    return ENCODINGS[path]


def encode(tokenizer, text: str) -> list[int]:
    """The ids of a text, added tokens included.

    The pattern takes a run of white space but its last sign as one piece, and the whole run at an
    end, after steps for every sign. Its matcher has room for about a million, so long runs are cut
    out here, where pieces end anyway.
    """
    if not LONG_SPACE.search(text):
        return tokenizer.encode(text, allowed_special="all")
    added = "|".join(re.escape(token) for token in sorted(tokenizer.special_tokens_set, key=len, reverse=True))
    ids: list[int] = []
    for i, part in enumerate(re.split(f"({added})", text) if added else [text]):
        start = 0
        for run in LONG_SPACE.finditer(part) if i % 2 == 0 else ():
            end = run.end() if run.end() == len(part) else run.end() - 1
            ids += tokenizer.encode_ordinary(part[start : run.start()])
            ids += tokenizer._encode_single_piece(part[run.start() : end])
            start = end
        ids += tokenizer.encode(part[start:], allowed_special="all")
    return ids


def default_tokenizer() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


def cut_pieces(docs: DataFrame, tokenizer: str, size: int, end_id: int) -> DataFrame:
    """One row per piece: each document's ids in pieces of ``size``, the last one shorter."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = byte_bpe(tokenizer)
        for batch in batches:
            rows = []
            for doc_id, copy, text in zip(batch.doc_id, batch.copy_, batch.text, strict=True):
                ids = np.array([*encode(encoder, text or ""), end_id], dtype="<u4")
                for start in range(0, len(ids), size):
                    piece = ids[start : start + size]
                    crc = zlib.crc32(piece.tobytes())
                    rows.append((doc_id, copy, len(ids), start, len(piece), crc))
            columns = ["doc_id", "copy", "doc_tokens", "start", "length", "ids_crc32"]
            yield pd.DataFrame(rows, columns=columns)

    # The copy number only keeps repeated rows apart; a text is never held twice.
    texts = docs.select(filled("doc_id"), F.monotonically_increasing_id().alias("copy_"), "text")
    pieces = texts.mapInPandas(cut, PIECES)
    return pieces.withColumn("doc_id", unfilled("doc_id"))


def pack_histogram(counts: dict[int, int], size: int) -> list[tuple[list[int], int]]:
    """Shortest-pack-first: packing patterns (lengths in order) with how often each is used.

    Lengths are placed longest first, into the shortest pack, the one with most room left, if it
    has room enough, as many packs at once as there are. Where none has, new packs take as many of
    this length as they hold. Work and result depend on ``size`` and on
    the number of distinct lengths, not on how many pieces there are.
    """
    open_packs: dict[int, list[tuple[list[int], int]]] = {}
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            room = next((r for r in range(size - 1, length - 1, -1) if open_packs.get(r)), None)
            if room is None:
                held = min(size // length, left)
                open_packs.setdefault(size - held * length, []).append(([length] * held, left // held))
                left %= held
                continue
            pattern, available = open_packs[room].pop()
            used = min(left, available)
            if available > used:
                open_packs[room].append((pattern, available - used))
            open_packs.setdefault(room - length, []).append(([*pattern, length], used))
            left -= used
    return [pack for room in sorted(open_packs) for pack in open_packs[room]]


def pattern_slots(spark: SparkSession, patterns: list[tuple[list[int], int]]) -> DataFrame:
    """For every place of a pattern, which ranks of its length go there, and to which sequences."""
    rows, given, first = [], {}, 0
    for pattern, used in patterns:
        offset = 0
        for length in pattern:
            rank = given.get(length, 0)
            rows.append((length, rank, rank + used, first, offset))
            given[length] = rank + used
            offset += length
        first += used
    schema = "slot_length bigint, rank_from bigint, rank_to bigint, first_sequence bigint, offset bigint"
    return spark.createDataFrame(rows, schema)


def pack_documents(
    docs: DataFrame, tokenizer: str | None = None, size: int = 1024, end_id: int = 0
) -> DataFrame:
    """Packs documents into sequences of at most ``size`` tokens; one row per piece.

    Columns: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset. A document's ids
    end with ``end_id``. Full pieces are sequences of their own; what is left of each document is
    packed by the histogram of lengths. That histogram has at most ``size`` - 1 rows and is all
    the driver sees. Packing patterns come back to the pieces by length and rank.

    A null or empty text is one piece of one id. Repeated rows are packed each. An empty table
    gives no pieces. Other columns of ``docs`` play no part.
    """
    tokenizer = tokenizer or default_tokenizer()
    spark = docs.sparkSession
    small_batches(spark)
    pieces = materialize(cut_pieces(docs, tokenizer, size, end_id), "pieces")
    rest = pieces.where(F.col("length") < size)
    counts = {r["length"]: r["count"] for r in rest.groupBy("length").count().collect()}
    patterns = pack_histogram(counts, size)
    packed = sum(used for _, used in patterns)
    slots = pattern_slots(spark, patterns)
    placed = ranked(rest, ["length"], ["doc_id", "doc_tokens", "ids_crc32", "copy"], "ranks")
    fits = (F.col("length") == F.col("slot_length")) & F.col("rank").between(
        F.col("rank_from"), F.col("rank_to") - 1
    )
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    sequence = F.col("first_sequence") + F.col("rank") - F.col("rank_from")
    shared = placed.join(F.broadcast(slots), fits).select(
        *columns, sequence.alias("sequence_id"), "offset"
    )
    full = ranked(pieces.where(F.col("length") == size), [], ["doc_id", "copy", "start"], "full")
    alone = full.select(
        *columns, (F.col("rank") + packed).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset")
    )
    return shared.unionByName(alone)

"""Similarity join on word shingles by prefixes and token combinations.

Two documents link when their sets of shingles have a Jaccard similarity of at least 3/4. Then at
most a quarter of either set is missing from the other. With all tokens in one order, take the
first tokens of each set, enough of them that a quarter cannot hide every signature: rare tokens
count one each, and are signatures by themselves; frequent tokens are dealt into groups, a group of
n tokens counts n - 1, and every pair of its tokens is a signature. Linked sets share a signature.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.llm.common import filled, matching, materialize, small_batches, unfilled
from wattline.llm.components import connected_groups
from wattline.llm.hashing import WordHasher, mix, words_of

#: Documents a task looks at together; their places fit in 16 bits.
CHUNK_DOCS, CHUNK_CHARS = 4096, 1 << 22
NO_OWNER = 65535


def shingles(hasher: WordHasher, text: str | None, width: int = 5) -> np.ndarray:
    """The set of a text's shingles as sorted hashes; the whole text if it has fewer words."""
    words = words_of(text, lower=True)
    return np.unique(hasher.runs(words, min(width, len(words)) or 1))


def _quarter(n: int) -> int:
    """One more than the most tokens of a set of ``n`` that a linked set may lack."""
    return n // 4 + 1


def set_rows(docs: DataFrame, width: int) -> DataFrame:
    """Size and 128-bit digest of every document's set."""

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = WordHasher()
        for batch in batches:
            sizes, first, second = [], [], []
            for text in batch.text:
                found = shingles(hasher, text, width)
                value = hashlib.blake2b(found.tobytes(), digest_size=16).digest()
                sizes.append(len(found))
                first.append(int.from_bytes(value[:8], "little", signed=True))
                second.append(int.from_bytes(value[8:], "little", signed=True))
            yield pd.DataFrame(
                {"doc_id": batch.doc_id, "doc_key": batch.doc_key, "n": sizes, "d1": first, "d2": second}
            )

    schema = "doc_id bigint, doc_key bigint, n bigint, d1 bigint, d2 bigint"
    rows = _keyed(docs).mapInPandas(digest, schema)
    return rows.withColumn("doc_id", unfilled("doc_id"))


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(filled("doc_id"), F.xxhash64("doc_id", "text").alias("doc_key"), "text")


def _buckets_of(tokens: np.ndarray, buckets: int) -> np.ndarray:
    return ((tokens >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def shared_counts(docs: DataFrame, total: int, width: int, bucket_tokens: int = 4_000_000) -> DataFrame:
    """How many of a document's first tokens, in the order of hashes, some other document has too.

    Looks at the quarter that may be missing plus an eighth. Of linked sets, the one whose tokens
    end first has more than an eighth of itself in the other's, so a document with fewer has no
    partner, and is left out from here on. Tokens go to buckets by value, packed as arrays. Those
    that several documents of a chunk share are counted there and sent once, so a token in a third
    of all documents is one entry per chunk.
    """
    buckets = max(1, math.ceil(total * 0.375 / bucket_tokens))

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = WordHasher()
        for keys, sets in _chunks(batches, hasher, width):
            first = [found[: _quarter(len(found)) + len(found) // 8] for found in sets]
            tokens = np.concatenate(first)
            owners = np.repeat(np.arange(len(first)), [len(x) for x in first])
            order = np.argsort(tokens, kind="stable")
            tokens, owners = tokens[order], owners[order].astype("<u2")
            head = np.concatenate(([True], tokens[1:] != tokens[:-1]))
            runs = np.diff(np.append(np.flatnonzero(head), len(tokens)))
            several = np.repeat(runs > 1, runs)
            local = np.bincount(owners[several], minlength=len(keys))
            owners = np.where(several, NO_OWNER, owners).astype("<u2")[head]
            tokens = tokens[head]
            where = _buckets_of(tokens, buckets)
            edges = np.searchsorted(where, np.arange(buckets + 1, dtype=np.uint64))
            rows = []
            for bucket in range(buckets):
                a, b = edges[bucket], edges[bucket + 1]
                if a < b:
                    used = np.unique(owners[a:b])
                    used = used[used != NO_OWNER]
                    renamed = np.searchsorted(used, owners[a:b]).astype("<u2")
                    renamed[owners[a:b] == NO_OWNER] = NO_OWNER
                    rows.append((bucket, keys[used].tobytes(), tokens[a:b].astype("<u4").tobytes(), renamed.tobytes(), b"", b""))
            known = np.flatnonzero(local)
            rows.append((int(keys[0]) % buckets, b"", b"", b"", keys[known].tobytes(), local[known].astype("<i8").tobytes()))
            yield pd.DataFrame(rows, columns=["bucket", "keys", "tokens", "owners", "known", "counts"])

    def meet(frame: pd.DataFrame) -> pd.DataFrame:
        keys = [np.frombuffer(x, "<i8") for x in frame["keys"]]
        tokens = np.concatenate([np.frombuffer(x, "<u4") for x in frame["tokens"]])
        offset, owners = 0, []
        for own, known in zip(frame["owners"], keys, strict=True):
            places = np.frombuffer(own, "<u2").astype(np.int32)
            owners.append(np.where(places == NO_OWNER, -1, places + offset))
            offset += len(known)
        owners, keys = np.concatenate(owners), np.concatenate(keys)
        order = np.argsort(tokens, kind="stable")
        tokens, owners = tokens[order], owners[order]
        same = np.zeros(len(tokens) + 1, dtype=bool)
        same[1:-1] = tokens[1:] == tokens[:-1]
        shared = owners[(same[1:] | same[:-1]) & (owners >= 0)]
        del tokens, order, same
        counts = np.bincount(shared, minlength=len(keys))
        some = counts > 0
        known = np.concatenate([np.frombuffer(x, "<i8") for x in frame["known"]])
        local = np.concatenate([np.frombuffer(x, "<i8") for x in frame["counts"]])
        return pd.DataFrame(
            {"doc_key": np.concatenate((keys[some], known)), "shared": np.concatenate((counts[some], local))}
        )

    sent = _keyed(docs).select("doc_key", "text").mapInPandas(
        send, "bucket int, keys binary, tokens binary, owners binary, known binary, counts binary"
    )
    met = sent.groupBy("bucket").applyInPandas(meet, "doc_key bigint, shared bigint")
    return met.groupBy("doc_key").agg(F.sum("shared").alias("shared"))


def _chunks(batches: Iterator[pd.DataFrame], hasher: WordHasher, width: int):
    """Keys and sets of a bounded number of documents at a time; sets below three have no partner."""
    keys: list[int] = []
    sets: list[np.ndarray] = []
    chars = 0
    for batch in batches:
        for key, text in zip(batch.doc_key, batch.text, strict=True):
            found = shingles(hasher, text, width)
            if len(found) >= 3:
                keys.append(key)
                sets.append(found)
                chars += len(text)
            if len(keys) >= CHUNK_DOCS or chars >= CHUNK_CHARS:
                yield np.array(keys, dtype="<i8"), sets
                keys, sets, chars = [], [], 0
    if keys:
        yield np.array(keys, dtype="<i8"), sets


def token_frequencies(texts: DataFrame, total: int, width: int, bucket_tokens: int = 2_000_000) -> DataFrame:
    """For each chunk of documents, its tokens that more than one document has, and how many do.

    Every chunk sends its distinct tokens with their counts to buckets by value; a bucket adds up
    and answers each chunk. A token's entries grow with the chunks, not with the documents.
    """
    buckets = max(1, math.ceil(total / bucket_tokens))

    def send(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        hasher = WordHasher()
        tokens, counts = np.unique(
            np.concatenate([shingles(hasher, text, width) for text in frame.text]), return_counts=True
        )
        where = _buckets_of(tokens, buckets)
        edges = np.searchsorted(where, np.arange(buckets + 1, dtype=np.uint64))
        rows = [
            (i, key[0], tokens[a:b].astype("<u8").tobytes(), counts[a:b].astype("<u2").tobytes())
            for i, (a, b) in enumerate(zip(edges, edges[1:], strict=False))
            if a < b
        ]
        return pd.DataFrame(rows, columns=["bucket", "chunk", "tokens", "counts"])

    def answer(frame: pd.DataFrame) -> pd.DataFrame:
        parts = [np.frombuffer(x, "<u8") for x in frame["tokens"]]
        tokens, place = np.unique(np.concatenate(parts), return_inverse=True)
        counts = np.concatenate([np.frombuffer(x, "<u2") for x in frame["counts"]])
        totals = np.bincount(place, weights=counts).astype(np.int64)
        rows, at = [], 0
        for chunk, part in zip(frame["chunk"], parts, strict=True):
            here = totals[place[at : at + len(part)]]
            at += len(part)
            some = here > 1
            rows.append((chunk, part[some].tobytes(), np.minimum(here[some], 2**31).astype("<u4").tobytes()))
        return pd.DataFrame(rows, columns=["chunk", "tokens", "totals"])

    sent = texts.select("chunk", "text").groupBy("chunk").applyInPandas(
        send, "bucket int, chunk bigint, tokens binary, counts binary"
    )
    return sent.groupBy("bucket").applyInPandas(answer, "chunk bigint, tokens binary, totals binary")


#: The last byte of a signature is the step of its groups, or all ones for a single token.
LOW_BYTE = np.uint64(255)


def signatures(found: np.ndarray, totals: np.ndarray, frequent: int) -> np.ndarray:
    """The signatures of a set, given how many documents have each of its tokens.

    Order: tokens of no other document, then rare ones, then frequent ones, by frequency and hash.
    The number of groups follows the size of the set, in steps of 4/3. Linked sets are at most one
    step apart, so each set signs for its own step and for the next.
    """
    enough = _quarter(len(found))
    alone = int((totals <= 1).sum())
    if alone >= enough:
        return np.empty(0, dtype=np.uint64)
    shared = totals > 1
    found, totals = found[shared], totals[shared]
    rank = np.lexsort((found, totals))
    found, totals = found[rank], totals[rank]
    rare = found[totals < frequent] | LOW_BYTE
    if alone + len(rare) >= enough:
        return rare[: enough - alone]
    often, signed = found[totals >= frequent], [rare]
    step = int(math.floor(math.log(len(shared)) / math.log(4 / 3)))
    for scheme in (step, step + 1):
        groups = max(1, int((4 / 3) ** scheme / 16))
        group = (mix(often ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(groups)).astype(np.int64)
        seen: dict[int, list[int]] = {}
        held = alone + len(rare)
        for token, g in zip(often.tolist(), group.tolist(), strict=True):
            members = seen.setdefault(g, [])
            held += len(members) > 0
            members.append(token)
            if held >= enough:
                break
        for members in seen.values():
            m = np.array(sorted(members), dtype=np.uint64)
            a, b = np.triu_indices(len(m), 1)
            signed.append((mix(mix(m[a]) + m[b]) & ~LOW_BYTE) | np.uint64(scheme & 127))
    return np.unique(np.concatenate(signed))


def signed_documents(texts: DataFrame, answers: DataFrame, width: int, frequent: int) -> DataFrame:
    """(signature, node, info) of every document; chunks meet the answers to their tokens."""

    def sign(key: tuple, docs: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        tokens = np.concatenate([np.frombuffer(x, "<u8") for x in known["tokens"]] or [np.empty(0, "<u8")])
        totals = np.concatenate([np.frombuffer(x, "<u4") for x in known["totals"]] or [np.empty(0, "<u4")])
        order = np.argsort(tokens)
        tokens, totals = tokens[order], totals[order]
        hasher, frames = WordHasher(), []
        for node, text in zip(docs.node, docs.text, strict=True):
            found = shingles(hasher, text, width)
            here = np.ones(len(found), dtype=np.int64)
            if len(tokens):
                place = np.minimum(np.searchsorted(tokens, found), len(tokens) - 1)
                here = np.where(tokens[place] == found, totals[place], 1)
            signed = signatures(found, here, frequent)
            if len(signed):
                frames.append(pd.DataFrame({"signature": signed.view(np.int64), "node": node, "info": len(found)}))
        if not frames:
            return pd.DataFrame({"signature": [], "node": [], "info": []}, dtype="int64")
        return pd.concat(frames, ignore_index=True)

    return (
        texts.select("chunk", "node", "text")
        .groupBy("chunk")
        .cogroup(answers.groupBy("chunk"))
        .applyInPandas(sign, "signature bigint, node bigint, info bigint")
    )


def similar_enough(a: Column, b: Column) -> Column:
    """Whether sets of such sizes can be linked."""
    return F.least(a, b) * 4 >= F.greatest(a, b) * 3


#: Bits of a set's bitmap, in longs of 64.
BITMAP_LONGS = 32


def bitmaps(texts: DataFrame, width: int) -> DataFrame:
    """(node, detail): for each set a bitmap, in which every token turns one bit, and its size."""
    names = [f"w{i}" for i in range(BITMAP_LONGS)]

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = WordHasher()
        for batch in batches:
            rows = np.zeros((len(batch), BITMAP_LONGS), dtype=np.int64)
            sizes = []
            for i, text in enumerate(batch.text):
                found = shingles(hasher, text, width)
                odd = np.bincount((found % np.uint64(64 * BITMAP_LONGS)).astype(np.int64), minlength=64 * BITMAP_LONGS) & 1
                rows[i] = np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")
                sizes.append(len(found))
            frame = pd.DataFrame(rows, columns=names)
            yield frame.assign(node=batch.node.to_numpy(), n=sizes)[["node", "n", *names]]

    schema = "node bigint, n bigint, " + ", ".join(f"{name} bigint" for name in names)
    drawn = texts.select("node", "text").mapInPandas(draw, schema)
    return drawn.select("node", F.struct("n", *names).alias("detail"))


def few_differences(a: Column, b: Column) -> Column:
    """Whether two sets that share a signature can be linked, as far as this signature tells.

    Of two sets the larger one's step is the one that both must share a signature of. Bitmaps
    differ in no more bits than sets have tokens apart; linked sets have at most a seventh.
    """
    step = F.floor(F.log(F.greatest(a["n"], b["n"])) / F.lit(math.log(4 / 3)))
    scheme = F.col("signature").bitwiseAND(F.lit(255))
    differing = F.lit(0)
    for i in range(BITMAP_LONGS):
        differing = differing + F.bit_count(a[f"w{i}"].bitwiseXOR(b[f"w{i}"]))
    return ((scheme == 255) | (scheme == step % 128)) & (differing * 7 <= a["n"] + b["n"])


def verified_pairs(pairs: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """The pairs whose whole sets meet 100 * intersection >= 75 * union."""

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = WordHasher()
        last: tuple[int | None, np.ndarray | None] = (None, None)
        for batch in batches:
            keep = []
            for a, left, right in zip(batch.a, batch.text_a, batch.text_b, strict=True):
                if last[0] != a:
                    last = (a, shingles(hasher, left, width))
                other = shingles(hasher, right, width)
                both = len(np.intersect1d(last[1], other, assume_unique=True))
                keep.append(100 * both >= 75 * (len(last[1]) + len(other) - both))
            yield batch.loc[keep, ["a", "b"]]

    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(left, "a").join(right, "b").mapInPandas(check, "a bigint, b bigint")


def similar_documents(docs: DataFrame, width: int = 5, frequent: int = 64) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id.

    A component is what links reach; its id is its smallest doc_id. Documents with equal sets are
    one class from the start, so that copies, however many, are one set among the others. Tokens of
    ``frequent`` or more documents sign in pairs. Hashes of 64 bits stand for shingles and rows.

    A text without words (null, empty, white space) has no shingle and is linked with nothing: its
    component is itself. Fewer than ``width`` words are one shingle. Repeated rows are rows each. A
    null doc_id is linked like any other, but is a component's id only if no member has one. An
    empty table gives no rows. Other columns play no part.
    """
    small_batches(docs.sparkSession)
    rows = materialize(set_rows(docs, width), "sets")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "doc_key")
    classes = rows.where("n > 0").groupBy("d1", "d2").agg(F.min(place).alias("first"), F.max("n").alias("n"))
    classes = materialize(classes, "classes").withColumn("node", F.col("first.doc_key"))
    total = rows.agg(F.sum("n")).first()[0] or 0
    shared = shared_counts(docs, total, width)
    least = F.floor(F.ceil(F.col("n") * 0.75) / 8) + 1
    open_sets = (
        classes.select("node", "n")
        .join(shared.withColumnRenamed("doc_key", "node"), "node")
        .where(F.col("shared") >= least)
        .select("node", "n")
    )
    open_sets = materialize(open_sets, "open")
    size = open_sets.agg(F.sum("n").alias("tokens"), F.count(F.lit(1)).alias("docs")).first()
    chunks = max(1, math.ceil(max((size["tokens"] or 0) / 1_000_000, size["docs"] / 2_000)))
    texts = matching(
        docs.select(F.xxhash64("doc_id", "text").alias("node"), "text"),
        open_sets.select("node"),
        "node",
        "texts",
    )
    # A repeated row has the node of the others; one text a node, or all would land in one chunk.
    texts = materialize(texts.dropDuplicates(["node"]), "node-texts")
    texts = texts.withColumn("chunk", F.pmod(F.xxhash64("node", F.lit("chunk")), F.lit(chunks)))
    answers = token_frequencies(texts, size["tokens"] or 0, width)
    buckets = materialize(signed_documents(texts, answers, width, frequent), "signatures")
    details = materialize(bitmaps(texts, width), "bitmaps")
    groups = connected_groups(
        buckets,
        similar_enough,
        lambda pairs: verified_pairs(pairs, texts, width),
        details=details,
        near=few_differences,
    )
    labelled = classes.join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    names = labelled.groupBy("component").agg(F.min("first").alias("least"))
    named = labelled.join(names, "component").select("d1", "d2", F.col("least.doc_id").alias("component_id"))
    named = materialize(named, "named")
    linked = rows.where("n > 0").join(named, ["d1", "d2"])
    alone = rows.where("n = 0").withColumn("component_id", F.col("doc_id"))
    columns = ["doc_id", F.col("n").alias("n_shingles"), "component_id"]
    return linked.select(*columns).unionByName(alone.select(*columns))


def one_of_each_group(docs: DataFrame, **options) -> DataFrame:
    """The document with the smallest doc_id of each component, with all its columns.

    Of rows with equal ids all stay; documents without a doc_id that are alone stay as well.
    """
    groups = similar_documents(docs, **options)
    stays = groups.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    stays = stays.select(F.col("doc_id").alias("_group_id")).distinct()
    return docs.join(stays, F.col("doc_id").eqNullSafe(F.col("_group_id")), "left_semi")

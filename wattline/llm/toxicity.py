"""Toxicity scores: gradient-boosted trees over dense features, calibrated by isotonic regression."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattline.llm.common import materialize, small_batches

# Words that address the reader, and signs that stand for letters.
SECOND_PERSON = frozenset(
    "you your yours yourself yourselves u ur du dich dir dein deine deinen deiner euch euer eure"
    " tu te toi ton ta tes vous votre vos tú ti contigo usted ustedes vosotros vuestro vuestra".split()
)
DISGUISED = str.maketrans("013457@$!|", "oieastasil")

FEATURES = (
    "hits_per_word",
    "stem_hits_per_word",
    "log_hits",
    "weight_per_word",
    "largest_weight",
    "distinct_hits",
    "distinct_weight",
    "disguised_hits_per_word",
    "second_person_proximity",
    "second_person_per_word",
    "capitals_per_char",
    "exclamations_per_char",
    "questions_per_char",
    "other_signs_per_char",
    "disguised_per_word",
    "log_words",
)

_WORDS = re.compile(r"[^\W\d_]+")
_CAPITALS = re.compile(r"[A-ZÀ-ÖØ-Þ]")
_MIXED = re.compile(r"[^\W\d_][0-9@$!|*.\-][^\W_]")
_SPACED = re.compile(r"(?<!\S)(?:[^\W\d_][ .\-_]){2,}[^\W\d_](?!\S)")
STEMS = (4, 5, 6, 7)


@dataclass(frozen=True)
class Lexicon:
    """Words, and beginnings of words, that mark label 1 far more often than label 0.

    Each has the logarithm of its odds as a weight.
    """

    words: dict[str, float]
    stems: dict[str, float]

    def weight(self, word: str) -> float:
        return max(self.words.get(word, 0.0), *(self.stems.get(word[:k], 0.0) for k in STEMS))


def features(text: str, lexicon: Lexicon) -> list[float]:
    """The dense features of a text, in the order of FEATURES."""
    lower = text.lower()
    words = _WORDS.findall(lower)
    known, stems = lexicon.words, lexicon.stems
    places = [
        i
        for i, w in enumerate(words)
        if w[:4] in stems or w in known or w[:5] in stems or w[:6] in stems or w[:7] in stems
    ]
    hits = [words[i] for i in places if words[i] in known]
    weights = {words[i]: lexicon.weight(words[i]) for i in places}
    disguised, unmasked = 0, 0
    for match in _MIXED.finditer(lower):
        disguised += 1
        plain = "".join(_WORDS.findall(_token_at(lower, match).translate(DISGUISED)))
        unmasked += plain in known
    for match in _SPACED.finditer(lower):
        disguised += 1
        unmasked += "".join(_WORDS.findall(match.group())) in known
    near = 0.0
    persons = [i for i, w in enumerate(words) if w in SECOND_PERSON]
    if persons and places:
        near = max(1 / (1 + min(abs(i - p) for p in _around(persons, i))) for i in places)
    n, chars = max(1, len(words)), max(1, len(text))
    signs = sum(map(text.count, "#$%&*@"))
    return [
        len(hits) / n,
        len(places) / n,
        math.log1p(len(places)),
        sum(weights[words[i]] for i in places) / n,
        max(weights.values(), default=0.0),
        float(len(weights)),
        sum(weights.values()),
        unmasked / n,
        near,
        len(persons) / n,
        len(_CAPITALS.findall(text)) / chars,
        text.count("!") / chars,
        text.count("?") / chars,
        signs / chars,
        disguised / n,
        math.log1p(len(words)),
    ]


def _token_at(text: str, match: re.Match) -> str:
    """What stands around a match up to white space, at most 40 characters on either side."""
    before = re.split(r"\s", text[max(0, match.start() - 40) : match.start()])[-1]
    after = re.split(r"\s", text[match.end() : match.end() + 40], maxsplit=1)[0]
    return before + match.group() + after


def _around(ordered: list[int], value: int) -> list[int]:
    from bisect import bisect

    at = bisect(ordered, value)
    return ordered[max(0, at - 1) : at + 1]


def held_out(doc_id: Column) -> Column:
    """Whether a document's label may only be used to measure, never to learn."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def learnable(docs: DataFrame, labels: DataFrame, fit_rows: int) -> DataFrame:
    """Texts with labels to learn from: at most ``fit_rows``, picked by a hash of doc_id.

    The pick works on ids and labels alone; only the picked ids are broadcast. ``calibrate`` marks
    every fourth row, which the trees and the lexicon never see.
    """
    pick = F.xxhash64(F.col("doc_id").cast("string"), F.lit("fit"))
    known = (
        labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
        .where(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("double").alias("label"))
    )
    picked = known.orderBy(pick, "doc_id").limit(fit_rows).select(F.col("doc_id").alias("_id"), "label")
    rows = docs.select("doc_id", "text").join(F.broadcast(picked), F.col("doc_id") == F.col("_id"))
    apart = F.pmod(F.xxhash64("doc_id", F.lit("calibrate")), F.lit(4)) == 0
    return rows.select(F.coalesce("text", F.lit("")).alias("text"), "label", apart.alias("calibrate"))


def learn_lexicon(rows: DataFrame, size: int, min_docs: int, odds: float) -> Lexicon:
    """The ``size`` words and stems with the most label-1 documents among those with ``odds``."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            counts: dict[float, Counter] = {0.0: Counter(), 1.0: Counter()}
            for text, label in zip(batch.text, batch.label, strict=True):
                words = set(_WORDS.findall(text.lower()))
                counts[label].update(words)
                counts[label].update({f"{w[:k]}-" for w in words for k in STEMS if len(w) >= k})
            terms = list(counts[0.0] | counts[1.0])
            yield pd.DataFrame(
                {
                    "term": pd.Series(terms, dtype="object"),
                    "ones": [counts[1.0][t] for t in terms],
                    "zeros": [counts[0.0][t] for t in terms],
                }
            )

    sizes = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    ones, zeros = sizes.get(1.0, 0), sizes.get(0.0, 0)
    ratio = ((F.col("ones") + 0.5) / (ones + 1)) / ((F.col("zeros") + 0.5) / (zeros + 1))
    terms = (
        rows.select("text", "label")
        .mapInPandas(count, "term string, ones bigint, zeros bigint")
        .groupBy("term")
        .agg(F.sum("ones").alias("ones"), F.sum("zeros").alias("zeros"))
        .withColumn("odds", ratio)
        .where((F.col("ones") >= min_docs) & (F.col("odds") >= odds))
        .orderBy(F.desc("ones"), "zeros", "term")
        .limit(size)
        .collect()
    )
    found = {r["term"]: math.log(r["odds"]) for r in terms}
    return Lexicon(
        {t: w for t, w in found.items() if not t.endswith("-")},
        {t[:-1]: w for t, w in found.items() if t.endswith("-")},
    )


def with_features(rows: DataFrame, lexicon: Lexicon, *keep: str) -> DataFrame:
    """Adds a vector of FEATURES to the columns ``keep``, which go through as they are."""
    small_batches(rows.sparkSession)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *kept, texts = batch.columns
            dense = [features(text or "", lexicon) for text in texts.to_pylist()]
            columns = [*kept, pa.array(dense, pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, [*keep, "_dense"])

    texts = rows.select(*keep, F.col("text").alias("_text"))
    schema = T.StructType(
        [*(rows.schema[c] for c in keep), T.StructField("_dense", T.ArrayType(T.DoubleType()))]
    )
    dense = texts.mapInArrow(extract, schema)
    return dense.select(*keep, array_to_vector("_dense").alias("features"))


@dataclass(frozen=True)
class ToxicityModel:
    """Trees with their calibration; without both labels to learn from only the share of label 1."""

    lexicon: Lexicon
    trees: GBTClassificationModel | None
    calibration: IsotonicRegressionModel | None
    share: float

    def score(self, rows: DataFrame, *keep: str) -> DataFrame:
        """The columns ``keep`` and ``score``, from 0 to 1."""
        if self.trees is None or self.calibration is None:
            return rows.select(*keep, F.lit(self.share).alias("score"))
        raw = self.trees.transform(with_features(rows, self.lexicon, *keep))
        raw = raw.withColumn("raw_score", vector_to_array("probability")[1])
        scored = self.calibration.transform(raw.select(*keep, "raw_score"))
        return scored.select(*keep, F.least(F.lit(1.0), F.greatest(F.lit(0.0), "score")).alias("score"))


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    fit_rows: int = 40_000,
    lexicon_size: int = 4_000,
    min_docs: int = 5,
    odds: float = 10.0,
    trees: int = 20,
    depth: int = 4,
) -> ToxicityModel:
    """Learns lexicon, trees and calibration from at most ``fit_rows`` labelled rows.

    Learns nothing from held-out rows, and uses neither labels, lang, source nor doc_id as input
    of a score. Labels that are null or not 0 or 1 are left out; with several, the larger counts.
    """
    rows = materialize(learnable(docs, labels, fit_rows), "labelled")
    counted = rows.groupBy("calibrate", "label").count().collect()
    kinds = {(r["calibrate"], r["label"]): r["count"] for r in counted}
    total = sum(kinds.values())
    share = sum(n for (_, label), n in kinds.items() if label == 1.0) / total if total else 0.0
    train = rows.where("NOT calibrate")
    if len(kinds) < 4:
        return ToxicityModel(Lexicon({}, {}), None, None, share)
    lexicon = learn_lexicon(train, lexicon_size, min_docs, odds)
    dense = materialize(with_features(rows, lexicon, "label", "calibrate"), "features").coalesce(8)
    boosted = GBTClassifier(maxIter=trees, maxDepth=depth, stepSize=0.3, seed=7)
    model = boosted.fit(dense.where("NOT calibrate"))
    raw = model.transform(dense.where("calibrate")).select(
        "label", vector_to_array("probability")[1].alias("raw_score")
    )
    isotonic = IsotonicRegression(featuresCol="raw_score", predictionCol="score")
    return ToxicityModel(lexicon, model, isotonic.fit(raw), share)


def score_toxicity(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    A null or empty text is scored like any other, by features that are all zero. A null doc_id
    is never learned from and not held out. Repeated rows are scored each. Without any labelled
    row of one of the two labels all scores are the share of label 1 (0 if there is no label).
    An empty table gives no rows. Other columns play no part.
    """
    model = fit_toxicity(docs, labels, **options)
    scored = model.score(docs, "doc_id")
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def without_toxic(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The documents that are not predicted toxic, with all their columns."""
    model = fit_toxicity(docs, labels, **options)
    names = [f"c{i}" for i in range(len(docs.columns))]
    renamed = docs.toDF(*names).withColumn("text", F.col(names[docs.columns.index("text")]))
    return model.score(renamed, *names).where("score < 0.5").drop("score").toDF(*docs.columns)

"""Odd tables for every operator: nulls, empty and long texts, ties, repeated rows, clashing names."""

import itertools

CLASHING = ("node", "component", "size", "rank", "key", "chunk", "score", "label", "signature", "group")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def clash(df, *but):
    """More columns whose names operators might use themselves."""
    from pyspark.sql import functions as F

    return df.select("*", *(F.lit(f"own {c}").alias(c) for c in CLASHING if c not in but))


def sentence(start, n):
    return " ".join(f"w{start + i}" for i in range(n))


def odd_rows():
    long = sentence(0, 30_000)
    texts = [
        (1, sentence(0, 40)),
        (2, sentence(0, 40)),
        (2, sentence(0, 40)),
        (3, sentence(1, 40)),
        (4, None),
        (5, ""),
        (6, " \n\t "),
        (None, sentence(0, 40)),
        (None, None),
        (7, long),
        (8, long + " tail"),
        (9, "One two\nÉté àé 😀\none two"),
        (10, "x" * 50_000),
        (11, sentence(500, 3)),
        (12, "\x00 nul"),
    ]
    sources = itertools.cycle(["b", "a", None])
    return [(i, t, "en", s, None if t is None else len(t)) for (i, t), s in zip(texts, sources)]


def odd_docs(spark):
    return clash(spark.createDataFrame(odd_rows(), DOCS))


def no_docs(spark):
    return clash(spark.createDataFrame([], DOCS))

"""Personal data in text: fixed patterns, and a conditional random field that finds other spellings."""

from __future__ import annotations

import json
import random
import re
import zlib
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattline.llm.common import materialize, small_batches
from wattline.llm.crf import BREAK, EDGES, LinearChain, train

# Kinds in the order of reports, and the patterns of each.
KINDS = ("email", "ip", "card", "phone")
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

#: A span is (kind, start, end) in code points, the end exclusive.
Span = tuple[str, int, int]

SPAN = T.StructType(
    [T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]
)
LABELLED = T.StructType([T.StructField("text", T.StringType()), T.StructField("spans", T.ArrayType(SPAN))])
_FOUND = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())]))

_TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
_LINE_OR_TOKEN = re.compile(r"\n|[^\x20\x09-\x0D]+")


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def passes_luhn(digits: str) -> bool:
    """The check digit of payment cards: every second digit from the right counts twice."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        value = int(c) * (1 + i % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    """What the pattern local@domain finds, from one look at each @ and the run of letters before it."""
    done = 0
    for match in DOMAIN.finditer(text):
        before = text[done : match.start()]
        start = done + len(before.rstrip(LOCAL))
        if start < match.start():
            done = match.end()
            yield "email", start, done


def base_spans(text: str) -> list[Span]:
    """Leftmost matches of the patterns, those that do not overlap one of their kind; by kind, then start.

    Matches that fail their check (parts of an address up to 255, 16 to 19 digits with a right
    check digit, 8 to 15 digits of a phone) are dropped and not tried again.
    """
    spans = list(_emails(text)) if "@" in text else []
    for match in IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in match.group().split(".")):
            spans.append(("ip", *match.span()))
    for match in CARD.finditer(text):
        digits = digits_of(match.group()) if match.end() - match.start() < 40 else ""
        if 16 <= len(digits) <= 19 and passes_luhn(digits):
            spans.append(("card", *match.span()))
    if "+" in text:
        for match in PHONE.finditer(text):
            if 8 <= len(digits_of(match.group())) <= 15:
                spans.append(("phone", *match.span()))
    return spans


# Labelled examples


def other_spellings(kind: str, value: str) -> list[str]:
    """Ways in which people write the same that the patterns do not find."""
    digits = digits_of(value)
    if kind == "email":
        at, dot = "@", "."
        name, _, host = value.partition(at)
        return [
            f"{name} at {host.replace(dot, ' dot ')}",
            f"{name.replace(dot, ' dot ')} at {host.replace(dot, ' dot ')}",
            f"{name} [at] {host.replace(dot, ' [dot] ')}",
            f"{name}[at]{host.replace(dot, '[dot]')}",
            f"{name} (at) {host.replace(dot, ' (dot) ')}",
            f"{name}(at){host}",
            f"{name} (at) {host}",
            f"{name} AT {host.replace(dot, ' DOT ')}",
            f"{name} @ {host.replace(dot, ' . ')}",
            f"{name} @ {host}",
        ]
    if kind == "ip":
        return [value.replace(".", s) for s in ("[.]", "(.)", " . ", " dot ", "[dot]")]
    if kind == "card":
        fours = [digits[i : i + 4] for i in range(0, len(digits), 4)]
        return [s.join(fours) for s in (".", "_", "/", " - ", "  ")]
    if len(digits) == 11:
        country, area, first, last = digits[:1], digits[1:4], digits[4:7], digits[7:]
        return [
            f"({area}) {first}-{last}",
            f"{area}-{first}-{last}",
            f"{area}.{first}.{last}",
            f"{country}-{area}-{first}-{last}",
            f"{country} ({area}) {first}-{last}",
            f"00{country} {area} {first} {last}",
            f"{area} {first} {last}",
            f"+{country}/{area}/{first}-{last}",
        ]
    return [f"00{digits}", f"00 {digits[:2]} {digits[2:]}"]


def invented(kind: str, rng: random.Random) -> str:
    """A value of a kind as its pattern finds it, of other shapes than the text at hand may have."""
    number = partial(rng.randrange, 10)
    word = lambda: "".join(rng.choices("abcdefghiklmnoprstuvw", k=rng.randrange(2, 9)))
    if kind == "email":
        name = rng.choice(["{a}", "{a}.{b}", "{a}{n}", "{a}.{n}", "{a}_{b}", "{a}-{b}", "{a}.{b}{n}"])
        host = rng.choice(["{a}.com", "{a}.{b}.org", "mail{n}.{a}.com", "{a}-{b}.net", "{a}.co.uk"])
        name, host = (s.format(a=word(), b=word(), n=rng.randrange(100)) for s in (name, host))
        return f"{name}@{host}"
    if kind == "ip":
        return ".".join(str(rng.randrange(256)) for _ in range(4))
    if kind == "phone":
        return f"+1 ({rng.randrange(200, 1000)}) {rng.randrange(200, 1000)}-{rng.randrange(1000, 10000)}"
    digits = "4" + "".join(str(number()) for _ in range(14))
    return next(digits + str(i) for i in range(10) if passes_luhn(digits + str(i)))


def with_invented(text: str) -> tuple[str, list[Span]]:
    """A line with a value of some kind put between two of its words."""
    rng = random.Random(zlib.crc32(text.encode("utf-8", "replace")))
    gaps = [m.end() for m in _TOKEN.finditer(text)]
    kind = rng.choice(KINDS)
    value, at = invented(kind, rng), rng.choice(gaps)
    return f"{text[:at]} {value}{text[at:]}", [(kind, at + 1, at + 1 + len(value))]


def labelled_lines(text: str) -> Iterator[tuple[str, list[Span]]]:
    """A line with its spans, and with each of them written in other ways in turn.

    A line without any is given once as it is, and then as if a value stood in it.
    """
    spans = sorted(base_spans(text), key=lambda span: span[1])
    if any(a[2] > b[1] for a, b in zip(spans, spans[1:])):
        return
    yield text, spans
    if not spans and _TOKEN.search(text):
        text, spans = with_invented(text)
        yield text, spans
    ways = [other_spellings(kind, text[start:end]) for kind, start, end in spans]
    for turn in range(max((len(w) for w in ways), default=0)):
        parts, new, at, size = [], [], 0, 0
        for (kind, start, end), way in zip(spans, ways, strict=True):
            value = way[turn % len(way)]
            parts += [text[at:start], value]
            size += start - at
            new.append((kind, size, size + len(value)))
            size += len(value)
            at = end
        yield "".join([*parts, text[at:]]), new


def labelled_examples(docs: DataFrame, fit_rows: int = 1_500, longest_line: int = 2_000) -> DataFrame:
    """A small table (text, spans) of lines to learn from: what the patterns find, also in other spellings.

    Lines without personal data teach what is none, and once more with an invented value in them.

    ``fit_rows`` bounds the lines it starts from, of at most ``longest_line`` characters: those with
    the smallest hashes over all lines of all documents, one with a digit or @ counting for 32
    without. The same documents give the same lines, whatever their order.
    """
    lines = docs.select(F.explode(F.split("text", "\n")).alias("line"))
    lines = lines.where((F.length("line") > 0) & (F.length("line") <= longest_line))
    place = F.shiftrightunsigned(F.xxhash64("line"), 8) * F.when(F.col("line").rlike("[0-9@]"), 1).otherwise(32)
    few = lines.select("line", place.alias("place")).orderBy("place", "line").limit(fit_rows)

    def label(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [
                (text, [dict(zip(("kind", "start", "end"), span, strict=True)) for span in spans])
                for line in batch.line.drop_duplicates()
                for text, spans in labelled_lines(line)
            ]
            yield pd.DataFrame(rows, columns=["text", "spans"])

    return few.select("line").mapInPandas(label, LABELLED)


# The model


def token_labels(text: str, spans: list[Span]) -> tuple[list[str], list[int]]:
    """A line's tokens, labelled 0 outside, 1 + kind at the start of a span, 5 + kind inside."""
    tokens, labels = [], []
    order = sorted(spans, key=lambda span: span[1])
    begun = None
    for match in _TOKEN.finditer(text):
        holding = next((s for s in order if s[1] < match.end() and match.start() < s[2]), None)
        tokens.append(match.group())
        if holding is None:
            labels.append(0)
        else:
            number = KINDS.index(holding[0])
            labels.append(1 + number + (len(KINDS) if holding == begun else 0))
        begun = holding
    return tokens, labels


def windows(tokens: list[str], labels: list[int], around: int = 5, longest: int = 24) -> Iterator[tuple[list[str], list[int]]]:
    """Parts of a line: what is near its spans, or its beginning where it has none."""
    at = [i for i, label in enumerate(labels) if label]
    start = 0
    while at:
        begin = max(start, at[0] - around)
        end = min(begin + longest, len(tokens))
        while end > begin and end < len(tokens) and labels[end] > len(KINDS):
            end += 1  # never inside a span
        yield tokens[begin:end], labels[begin:end]
        start, at = end, [i for i in at if i >= end]
    if not start and tokens:
        marks = [i for i, token in enumerate(tokens) if any(c.isdigit() or c == "@" for c in token)]
        begin = max(0, (marks[0] if marks else 0) - around)
        yield tokens[begin : begin + longest], labels[begin : begin + longest]


def train_personal_data(labelled: DataFrame, max_rows: int = 30_000, passes: int = 12) -> LinearChain:
    """A model from labelled lines (text, spans), by one task; it comes back as some hundred kB.

    ``max_rows`` bounds the lines: a larger table is cut to those with the smallest hashes.
    """

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sequences, labels = [], []
        for batch in batches:
            for text, spans in zip(batch.text, batch.spans, strict=True):
                spans = [(s["kind"], s["start"], s["end"]) for s in spans]
                for tokens, marks in windows(*token_labels(text, spans)):
                    sequences.append(tokens)
                    labels.append(marks)
        model = train(sequences, labels, 1 + 2 * len(KINDS), passes=passes)
        weights = [a.astype("<f4").tobytes() for a in (model.weights, model.bias, model.moves)]
        yield pd.DataFrame({"names": [json.dumps(model.names)], "weights": [weights]})

    rows = labelled.select("text", "spans").where(F.col("text").isNotNull() & F.col("spans").isNotNull())
    rows = rows.orderBy(F.xxhash64("text"), "text").limit(max_rows).coalesce(1)
    found = rows.mapInPandas(fit, "names string, weights array<binary>").collect()
    size = 1 + 2 * len(KINDS)
    if not found:
        return LinearChain({}, *(np.zeros(s, dtype=np.float32) for s in ((1, 3, size), (size,), (size, size))))
    row = found[0]
    names = json.loads(row.names)
    shapes = ((len(names) + 1, 3, size), (size,), (size, size))
    arrays = [np.frombuffer(bytes(w), dtype="<f4").reshape(s) for w, s in zip(row.weights, shapes, strict=True)]
    return LinearChain(names, *arrays)


# Finding


_AT = re.compile(r"\s*(?:[\[({<]\s*(?:at|@)\s*[\])}>]|@|(?<=\s)at(?=\s))\s*", re.IGNORECASE)
_DOT = re.compile(r"\s*(?:[\[({<]\s*(?:dot|\.)\s*[\])}>]|\.|(?<=\s)dot(?=\s))\s*", re.IGNORECASE)


def is_plausible(kind: str, text: str) -> bool:
    """Whether a span could be what it is taken for, once it is written plainly."""
    if kind in ("email", "ip"):
        plain = _DOT.sub(".", _AT.sub("@", text) if kind == "email" else text)
        return base_spans(plain) == [(kind, 0, len(plain))]
    digits = digits_of(text)
    if any(c.isalpha() for c in text):
        return False
    return 16 <= len(digits) <= 19 and passes_luhn(digits) if kind == "card" else 8 <= len(digits) <= 15


def _trimmed(text: str, start: int, end: int) -> tuple[int, int]:
    """Without the signs that end sentences and open brackets at the edges."""
    while start < end and text[start] in EDGES:
        start += 1
    while start < end and text[end - 1] in EDGES:
        end -= 1
    inside = text[start:end]
    if inside.startswith("(") and ")" not in inside:
        start += 1
    if inside.endswith(")") and "(" not in inside:
        end -= 1
    return start, end


def method_spans(text: str, labels: list[int]) -> Iterator[Span]:
    """The spans that the labels of a text's tokens and line ends make up, if they are plausible."""
    open_kind, open_at, open_end = -1, 0, 0
    places = [m.span() for m in _LINE_OR_TOKEN.finditer(text)]
    for label, (start, end) in [*zip(labels, places, strict=True), (0, (len(text), len(text)))]:
        kind = (label - 1) % len(KINDS) if label else -1
        if label > len(KINDS) and kind == open_kind:
            open_end = end
            continue
        if open_kind >= 0:
            found = _trimmed(text, open_at, open_end)
            if is_plausible(KINDS[open_kind], text[slice(*found)]):
                yield KINDS[open_kind], *found
        open_kind, open_at, open_end = kind, start, end


def texts_spans(texts: list[str], model: LinearChain) -> list[list[tuple[str, int, int, bool]]]:
    """For each text its spans, (kind, start, end, by pattern); those of the model overlap no other."""
    tokens, ends = [BREAK], []
    for text in texts:
        words = text.encode("utf-8", "replace").replace(b"\n", b" " + BREAK.encode() + b" ").split()
        tokens.extend(w.decode("utf-8") for w in words)
        tokens.append(BREAK)
        ends.append(len(tokens))
    labels = model.label(tokens)
    results, start = [], 1
    for text, end in zip(texts, ends, strict=True):
        spans = [(*span, True) for span in base_spans(text)]
        own = labels[start : end - 1]
        start = end
        if own.any():
            taken = [(s[1], s[2]) for s in spans]
            for kind, first, last in method_spans(text, own.tolist()):
                if all(last <= a or b <= first for a, b in taken):
                    spans.append((kind, first, last, False))
        spans.sort(key=lambda span: (KINDS.index(span[0]), span[1]))
        results.append(spans)
    return results


def find_personal_data(docs: DataFrame, model: LinearChain) -> DataFrame:
    """The rows of ``docs`` with ``spans``: (kind, start, end, base) by kind, then start, in code points.

    Base spans are those of the patterns. The model labels every token of the whole text, line by
    line; what it finds beside them is added if it overlaps none and could be what it is taken for,
    written plainly. No row is shuffled; a text is held by the task that reads it.

    A null or empty text has no span. Equal rows get equal spans. An empty table gives no rows. All
    columns of ``docs`` stay, but a column spans is replaced.
    """
    docs = docs.drop("spans")
    small_batches(docs.sparkSession)
    work: Callable = partial(_add_spans, model=model)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(work, f"{fields}, spans array<struct<kind:string,start:int,end:int,base:boolean>>")


def _add_spans(batches: Iterator[pa.RecordBatch], model: LinearChain) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(batch.schema.names.index("text")).to_pylist()
        found = texts_spans([text or "" for text in texts], model)
        rows = [[dict(zip(("kind", "start", "end", "base"), s, strict=True)) for s in spans] for spans in found]
        columns = [*batch.columns, pa.array(rows, _FOUND)]
        yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "spans"])


def personal_data_report(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """One row per document: how many base spans of each kind, their digest, and all spans as text.

    The model learns from ``labelled``, by default the ``labelled_examples`` of the documents.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    if labelled is None:
        labelled = materialize(labelled_examples(docs), "labelled")
    model = train_personal_data(labelled)
    found = find_personal_data(docs, model)

    def shown(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = F.filter("spans", lambda s: s["base"])
    counts = [
        F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("bigint").alias(f"n_{kind}")
        for kind in KINDS
    ]
    return found.select(
        "doc_id", *counts, F.sha2(shown(base), 256).alias("base_sha256"), shown(F.col("spans")).alias("spans")
    )

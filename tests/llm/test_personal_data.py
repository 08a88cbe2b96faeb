"""Base spans against the plain patterns; the model by held-out labels, paths and gradients by brute force."""

import hashlib
import itertools
import random
import re

import numpy as np
import pytest
from conftest import DATA
from odd import DOCS, clash, no_docs, odd_docs

from wattline.llm import crf
from wattline.llm.crf import BREAK, LinearChain
from wattline.llm.personal_data import (
    KINDS,
    base_spans,
    find_personal_data,
    is_plausible,
    labelled_examples,
    passes_luhn,
    personal_data_report,
    texts_spans,
    token_labels,
    train_personal_data,
)

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def by_pattern(text):
    found = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            good = {
                "email": True,
                "ip": all(int(p) <= 255 for p in m.group().split(".")) if kind == "ip" else False,
                "card": 16 <= len(digits) <= 19 and passes_luhn(digits),
                "phone": 8 <= len(digits) <= 15,
            }
            if good[kind]:
                found.append((kind, *m.span()))
    return found


def test_check_digits():
    assert passes_luhn("4539578763621486") and not passes_luhn("4539578763621487")
    assert passes_luhn("0") and not passes_luhn("1")


def test_base_spans_are_those_of_the_patterns():
    rng = random.Random(3)
    pieces = [
        "a@b.c", "@", ".", "a", "x.y+z@q-r.com", "1.2.3.4", "256.1.1.1", "1.2.3", "+1", " (988) ", "555-2485",
        "4539578763621486", "4539 5787 6362 1486", "4539-5787-6362-1486", " ", "-", "1", "00", "+", "\n", "é", "😀", "@b.c",
    ]
    for _ in range(3000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randrange(1, 9)))
        assert base_spans(text) == by_pattern(text), text


@pytest.mark.parametrize("text", ["1" * 200_000, "a" * 200_000, "+1" + " " * 200_000, "1." * 100_000, "a@" * 100_000, "@b.c" * 50_000, "1 " * 100_000])
def test_long_texts_take_linear_time(text):
    base_spans(text)


def random_model(rng, tokens, n_labels=5):
    names = {f: i + 1 for i, f in enumerate(sorted({f for t in tokens for f in crf.features(t)}))}
    return LinearChain(
        names,
        rng.normal(size=(len(names) + 1, 3, n_labels)) * 2,
        rng.normal(size=n_labels) + np.array([3.0, *[0] * (n_labels - 1)]),
        rng.normal(size=(n_labels, n_labels)),
    )


def path_score(model, tokens, labels):
    score = model.token_scores(tokens)
    total = 0.0
    for t in range(1, len(tokens) - 1):
        y = labels[t]
        total += score[t, 1, y] + model.bias[y] + score[t - 1, 2, y] + score[t + 1, 0, y]
    return total + sum(model.moves[a, b] for a, b in zip(labels, labels[1:]))


def test_labels_are_the_best_path():
    rng = np.random.default_rng(1)
    words = ["ab", "12", "x@y.z", "(1)", "+4", "Ab", "wordlong"]
    for _ in range(150):
        tokens = [BREAK, *rng.choice(words, size=rng.integers(1, 5)).tolist(), BREAK]
        model = random_model(rng, [*words, BREAK])
        inner = len(tokens) - 2
        best = max(itertools.product(range(5), repeat=inner), key=lambda p: path_score(model, tokens, (0, *p, 0)))
        got = model.label(tokens).tolist()
        assert path_score(model, tokens, got) == pytest.approx(path_score(model, tokens, (0, *best, 0)))
    # Many sequences at once get the labels each has alone.
    model = random_model(rng, [*words, BREAK])
    lines = [rng.choice(words, size=rng.integers(1, 30)).tolist() for _ in range(100)]
    together = model.label([BREAK, *itertools.chain.from_iterable([*line, BREAK] for line in lines)]).tolist()
    alone = [0, *itertools.chain.from_iterable([*model.label([BREAK, *line, BREAK]).tolist()[1:-1], 0] for line in lines)]
    assert together == alone


def test_gradients_are_those_of_the_likelihood():
    rng = np.random.default_rng(2)
    values = {"weights": rng.normal(size=(4, 3, 3)), "bias": rng.normal(size=3), "moves": rng.normal(size=(3, 3))}
    x, y = rng.integers(0, 4, size=(2, 4, 2)), rng.integers(0, 3, size=(2, 4))

    def loss():
        total = 0.0
        for i in range(2):
            table = values["weights"][x[i]].sum(axis=1)

            def score(path, table=table):
                s = 0.0
                for t, label in enumerate(path):
                    s += table[t, 1, label] + values["bias"][label]
                    s += table[t - 1, 2, label] if t else 0
                    s += table[t + 1, 0, label] if t + 1 < len(path) else 0
                    s += values["moves"][path[t - 1], label] if t else 0
                return s

            every = [score(p) for p in itertools.product(range(3), repeat=4)]
            total += np.log(np.exp(every).sum()) - score(y[i].tolist())
        return total / 2

    found = crf._gradients(values, x, y)
    for name, value in values.items():
        for at in np.ndindex(value.shape):
            before = value[at]
            value[at] = before + 1e-5
            above = loss()
            value[at] = before - 1e-5
            below = loss()
            value[at] = before
            assert found[name][at] == pytest.approx((above - below) / 2e-5, abs=1e-6)


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    return train_personal_data(labelled_examples(docs))


def test_labelled_lines_agree_with_their_spans(spark):
    rows = labelled_examples(spark.read.parquet(f"{DATA}/documents.parquet")).collect()
    spans = [(r.text[s.start : s.end], s.kind) for r in rows for s in r.spans]
    assert {kind for _, kind in spans} == set(KINDS)
    assert all(value == value.strip() and value for value, _ in spans)
    tokens, labels = token_labels("call +1 (988) 555-2485, a@b.c", [("phone", 5, 22), ("email", 24, 29)])
    assert labels == [0, 4, 8, 8, 1] and len(tokens) == 5


def test_held_out_lines(spark, model):
    """On lines of other documents, the model alone finds what the patterns find, and other spellings."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("doc_id >= 200")
    rows = labelled_examples(docs, fit_rows=400).collect()
    right = found = wanted = 0
    for r in rows:
        spans = {(s.kind, s.start, s.end) for s in r.spans}
        got = {s[:3] for s in texts_spans([r.text], model)[0]}
        right += len(spans & got)
        found += len(got)
        wanted += len(spans)
    assert wanted > 200
    assert right >= 0.95 * wanted and right >= 0.95 * found, (right, found, wanted)


def test_other_spellings_and_clean_text(model):
    texts = [
        "Thaned onsh (988) 555-2485 orthen ndat.",
        "Thaned onsh bosbt.42 [at] mail8 [dot] example [dot] com, er",
        "Thaned onsh bosbt.42 at mail8 dot example dot com er",
        "in 4041.8949.7460.8795 the",
        "The 12 of 2023-10-01, at 5.30 pm, version 2.0 of the dot at it. 3.14159, 1,200 or 9,999",
        "He looked at the dot on the map and at it again.",
    ]
    got = [[(s[0], t[s[1] : s[2]]) for s in spans] for t, spans in zip(texts, texts_spans(texts, model))]
    assert got == [
        [("phone", "(988) 555-2485")],
        [("email", "bosbt.42 [at] mail8 [dot] example [dot] com")],
        [("email", "bosbt.42 at mail8 dot example dot com")],
        [("card", "4041.8949.7460.8795")] if passes_luhn("4041894974608795") else [],
        [],
        [],
    ]


def test_plausible():
    assert is_plausible("email", "a at b dot c") and not is_plausible("email", "a at b")
    assert is_plausible("ip", "1[.]2[.]3[.]4") and not is_plausible("ip", "1[.]2[.]3[.]400")
    assert not is_plausible("phone", "555-2485") and not is_plausible("phone", "a 12345678")


def test_report(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = personal_data_report(docs).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = by_pattern(texts[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in base) for k in KINDS]
        listed = ["{}:{}:{}".format(*s) for s in base]
        assert r.base_sha256 == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert set(listed) <= set(r.spans.split(",")) | {""}
    with_base = {i for i, t in texts.items() if by_pattern(t)}
    extra = [r for r in rows if r.doc_id not in with_base and r.spans]
    assert len(extra) <= 0.01 * len(rows), extra


def test_odd_documents(spark, model):
    rows = find_personal_data(odd_docs(spark), model).collect()
    assert len(rows) == 15 and all(r.spans == [] for r in rows)
    assert personal_data_report(no_docs(spark)).count() == 0
    text = "x 1.2.3.4\n" + "w " * 50_000 + "\ncall +1 (988) 555-2485"
    docs = clash(spark.createDataFrame([(1, text, "en", "s", 1), (1, text, "en", "s", 1)], DOCS))
    for r in personal_data_report(docs, labelled_examples(spark.read.parquet(f"{DATA}/documents.parquet"))).collect():
        assert r.spans == f"ip:2:9,phone:{len(text) - 17}:{len(text)}"

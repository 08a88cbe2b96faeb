"""A linear-chain conditional random field over features of word shapes, in numpy batches."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd

#: Stands between lines and texts; a sequence of tokens begins and ends with it.
BREAK = "\x1f"
OFFSETS = (-1, 0, 1)
EDGES = ".,;:!?\"'<>"

_DIGITS = re.compile(r"[0-9]+")
_LETTERS = re.compile(r"[^\W\d_]+")


def features(token: str) -> tuple[str, ...]:
    """A token's shape with the lengths of its runs of digits, without them, and its letters if few.

    Signs at its edges that end sentences do not count.
    """
    if token == BREAK:
        return ("break",)
    core = token.strip(EDGES) or token
    if core.isalpha():
        short = f"word {core.lower()}" if len(core) <= 6 else "long word"
        return ("letters", short)
    bare = _LETTERS.sub("a", core)
    fine = _DIGITS.sub(lambda m: str(min(len(m.group()), 20)), bare)
    coarse = _DIGITS.sub("0", bare)
    return (f"fine {fine[:40]}", f"coarse {coarse[:40]}", f"word {core.lower()}" if len(core) <= 6 else "long")


@dataclass
class LinearChain:
    """Scores of labels: by feature of a token and its neighbours, and by pair of labels. Label 0 is outside."""

    names: dict[str, int]
    weights: np.ndarray  # feature, offset, label
    bias: np.ndarray
    moves: np.ndarray  # label, next label

    def token_scores(self, tokens: list[str]) -> np.ndarray:
        """What each token adds to the scores of the one after, its own, and those of the one before."""
        known = [[self.names.get(f, 0) for f in features(token)] for token in tokens]
        flat = np.fromiter((i for row in known for i in row), dtype=np.int64)
        ends = np.cumsum([len(row) for row in known])
        return np.add.reduceat(self.weights[flat], ends - [len(row) for row in known], axis=0) if known else self.weights[:0]

    def label(self, tokens: list[str]) -> np.ndarray:
        """The labels of the best path through a sequence that begins and ends with breaks.

        A token is outside on the best path, whatever its neighbours are, if its own score for that
        exceeds the others by more than any two moves can make up. So Viterbi runs on the stretches
        in between alone, all of them side by side, and gives the same path.
        """
        codes, distinct = pd.factorize(np.array([*tokens, ""], dtype=object)[:-1])
        table = self.token_scores(list(distinct))
        score = table[codes, 1] + self.bias
        score[1:] += table[codes[:-1], 2]
        score[:-1] += table[codes[1:], 0]
        through = self.moves[:, :, None] + self.moves[None, :, :]
        most = (through - (self.moves[:, :1] + self.moves[:1, :])[:, None, :])[:, 1:, :].max()
        open_ = score[:, 0] - score[:, 1:].max(axis=1) <= most
        open_[codes == codes[0]] = False  # breaks
        labels = np.zeros(len(tokens), dtype=np.int64)
        edge = np.flatnonzero(np.diff(np.concatenate(([False], open_, [False])).astype(np.int8)))
        starts, ends = edge[::2], edge[1::2]
        if not len(starts):
            return labels
        order = np.argsort(starts - ends, kind="stable")
        starts, lengths = starts[order], (ends - starts)[order]
        total = int(lengths[0])
        best = self.moves[0] + score[starts]
        back = []
        for t in range(1, total):
            going = int(np.searchsorted(-lengths, -t, side="left"))
            ways = best[:going, :, None] + self.moves
            came = ways.argmax(axis=1)
            back.append(came)
            best[:going] = np.take_along_axis(ways, came[:, None, :], axis=1)[:, 0] + score[starts[:going] + t]
        label = (best + self.moves[:, 0]).argmax(axis=1)
        for t in range(total - 1, 0, -1):
            going = len(back[t - 1])
            labels[starts[:going] + t] = label[:going]
            label[:going] = back[t - 1][np.arange(going), label[:going]]
        labels[starts] = label
        return labels


def train(
    sequences: list[list[str]],
    labels: list[list[int]],
    n_labels: int,
    passes: int = 12,
    batch: int = 256,
    rate: float = 0.1,
    decay: float = 1e-4,
    seed: int = 7,
) -> LinearChain:
    """Fits by the likelihood of whole sequences (Adam, forward and backward sums).

    Sequences are padded with breaks to one length, and begin and end with one. Features that occur
    once are left out. The same input gives the same weights.
    """
    width = max((len(s) for s in sequences), default=0) + 2
    padded = [[BREAK, *s, *[BREAK] * (width - 1 - len(s))] for s in sequences]
    known: dict[str, tuple[str, ...]] = {t: features(t) for t in {BREAK, *(t for s in padded for t in s)}}
    counts = pd.Series([f for s in sequences for t in s for f in known[t]], dtype=object).value_counts()
    kept = sorted([*counts.index[counts > 1], "break"])
    names = {f: i + 1 for i, f in enumerate(kept)}
    most = 3
    ids = {t: ([names.get(f, 0) for f in fs] + [0] * most)[:most] for t, fs in known.items()}
    x = np.array([[ids[t] for t in s] for s in padded], dtype=np.int64).reshape(len(padded), width, most)
    y = np.array([[0, *l, *[0] * (width - 1 - len(l))] for l in labels], dtype=np.int64).reshape(len(padded), width)
    shapes = {"weights": (len(names) + 1, 3, n_labels), "bias": (n_labels,), "moves": (n_labels, n_labels)}
    values = {k: np.zeros(s) for k, s in shapes.items()}
    first = {k: np.zeros(s) for k, s in shapes.items()}
    second = {k: np.zeros(s) for k, s in shapes.items()}
    rng = np.random.default_rng(seed)
    turn = 0
    for _ in range(passes):
        order = rng.permutation(len(x))
        for begin in range(0, len(x), batch):
            rows = order[begin : begin + batch]
            gradients = _gradients(values, x[rows], y[rows])
            turn += 1
            for k, gradient in gradients.items():
                gradient += decay * values[k]
                first[k] += 0.1 * (gradient - first[k])
                second[k] += 0.01 * (gradient**2 - second[k])
                step = first[k] / (1 - 0.9**turn) / (np.sqrt(second[k] / (1 - 0.99**turn)) + 1e-8)
                values[k] -= rate * step
            values["weights"][0] = 0
    # Kept as they are scored, so that a score and the bound on moves are of one kind.
    return LinearChain(names, values["weights"], values["bias"], values["moves"])


def _gradients(values: dict[str, np.ndarray], x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
    """Of the mean negative log likelihood of sequences, by scaled forward and backward sums."""
    n, width, _ = x.shape
    weights, moves = values["weights"], values["moves"]
    table = weights[x].sum(axis=2)  # sequence, token, offset, label
    score = table[:, :, 1] + values["bias"]
    score[:, 1:] += table[:, :-1, 2]
    score[:, :-1] += table[:, 1:, 0]
    emit = np.exp(score - score.max(axis=2, keepdims=True))
    go = np.exp(moves)
    ahead = np.empty_like(emit)
    ahead[:, 0] = emit[:, 0]
    ahead[:, 0] /= ahead[:, 0].sum(axis=1, keepdims=True)
    for t in range(1, width):
        ahead[:, t] = (ahead[:, t - 1] @ go) * emit[:, t]
        ahead[:, t] /= ahead[:, t].sum(axis=1, keepdims=True)
    behind = np.ones_like(emit)
    for t in range(width - 2, -1, -1):
        behind[:, t] = (emit[:, t + 1] * behind[:, t + 1]) @ go.T
        behind[:, t] /= behind[:, t].sum(axis=1, keepdims=True)
    chance = ahead * behind
    chance /= chance.sum(axis=2, keepdims=True)
    off = chance.copy()
    np.put_along_axis(off, y[:, :, None], np.take_along_axis(off, y[:, :, None], 2) - 1, 2)
    pair = ahead[:, :-1, :, None] * go * (emit * behind)[:, 1:, None, :]
    pair /= pair.sum(axis=(2, 3), keepdims=True)
    of_moves = pair.sum(axis=(0, 1))
    np.add.at(of_moves, (y[:, :-1].ravel(), y[:, 1:].ravel()), -1)
    # A token's weights at offset 0 score its neighbour before, at 2 its neighbour after.
    felt = np.zeros((n, width, 3, off.shape[2]))
    felt[:, :, 1] = off
    felt[:, :-1, 2] = off[:, 1:]
    felt[:, 1:, 0] = off[:, :-1]
    of_weights = np.zeros_like(weights)
    for i in range(x.shape[2]):
        np.add.at(of_weights, x[:, :, i].ravel(), felt.reshape(-1, *felt.shape[2:]))
    return {"weights": of_weights / n, "bias": off.sum(axis=(0, 1)) / n, "moves": of_moves / n}

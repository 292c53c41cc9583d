"""Document quality from a linear-chain conditional random field over lines.

Every line of a text is labelled good or bad.  A line's evidence comes from its own
features and those of the lines before and after it; transitions couple neighbouring
labels.  Forward-backward gives each line's probability of being good, and a document's
quality is their mean weighted by line length.

Training: the labels mark documents, so every line of a document carries its label.
The model is fitted by Adam on the exact likelihood, on a bounded sample of labelled
documents (``SAMPLE``); in training, a document of more than ``PIECE`` lines is a row of chains
of that length, which share its weight.  Only features leave the executors.  The threshold that separates the training documents best is mapped to 0.7
by a piecewise linear, increasing function.

Defined results: null and empty texts score 0 (no line is good); repeated rows each get
their score; rows without a label, or with a null one, are not learned from; without
any label, or with only one class, every text that is not empty scores that class's
share (0.5 without labels); an empty table gives an empty result; further columns are
kept.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowframe.llm.common import map_text

#: Labelled documents of each class to learn from, and most lines of a chain in training.
SAMPLE = 2500
PIECE = 400
KEEP = 0.7
#: Classes of ASCII bytes that are counted in a line.
CLASSES = [b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"!?", b"|", b".,;:'\"()-", b"#$%&*@^~=+<>{}[]\\/_`", b" \t\r\x0b\x0c"]
FEATURES = 10


def _line_starts(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    split = pc.split_pattern(texts.fill_null(""), "\n")
    return split.flatten(), split.offsets.to_numpy() - split.offsets[0].as_py()


def line_features(lines: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(features, code points) of every line."""
    lines = pa.concat_arrays([lines])  # offsets from zero
    n = len(lines)
    _, offsets, data = lines.buffers()
    at = np.frombuffer(offsets, np.int32, n + 1, lines.offset * 4).astype(np.int64) if n else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    kind = np.zeros(256, np.uint8)
    for k, chars in enumerate(CLASSES, 1):
        kind[np.frombuffer(chars, np.uint8)] = k
    kinds = kind[raw[at[0]:at[-1]]]
    at = at - at[0]

    def per_line(flags: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))[at])

    upper, digit, bang, pipe, stop, symbol, space = (per_line(kinds == k) for k in range(1, len(CLASSES) + 1))
    size = pc.utf8_length(lines).to_numpy().astype(np.int64)
    words = pc.ascii_split_whitespace(lines)
    codes = words.flatten().dictionary_encode()
    empty = np.array([not w for w in codes.dictionary.to_pylist()] + [False])
    ids = codes.indices.to_numpy(zero_copy_only=False)
    cut = words.offsets.to_numpy() - words.offsets[0].as_py()
    twice = np.zeros(len(ids), bool)
    twice[1:] = (ids[1:] == ids[:-1]) & ~empty[ids[1:]]
    twice[cut[:-1][cut[:-1] < len(ids)]] = False  # the first word of a line follows none
    segment = lambda x: np.diff(np.concatenate(([0], np.cumsum(x, dtype=np.int64)))[cut])
    count = segment(~empty[ids])
    some, letters = np.maximum(size, 1), np.maximum(size - digit - bang - pipe - stop - symbol - space, 1)
    per_word = np.maximum(count, 1)
    found = [np.log1p(size) / 8, upper / letters, np.minimum(1, symbol / per_word), np.minimum(1, bang / per_word), np.minimum(1, pipe / per_word),
             digit / some, segment(twice) / per_word, np.minimum(1, stop / per_word), np.minimum(1, size / per_word / 20), (count == 0).astype(float)]
    return np.stack(found, axis=1).astype(np.float32), size


def with_neighbours(x: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Features of a line, of the one before and of the one after, and a constant."""
    before, after = np.zeros_like(x), np.zeros_like(x)
    before[1:], after[:-1] = x[:-1], x[1:]
    before[first], after[last] = 0, 0
    return np.concatenate([x, before, after, np.ones((len(x), 1), x.dtype)], axis=1)


@dataclass
class Chain:
    """Weights of the evidence for good, transitions and start scores (states: bad, good)."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    moves: np.ndarray
    start: np.ndarray
    cut: float = 0.5
    constant: float | None = None

    def evidence(self, x: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        x = (x - self.mean) / self.scale
        full = with_neighbours(x, offsets[:-1][np.diff(offsets) > 0], offsets[1:][np.diff(offsets) > 0] - 1)
        return full @ self.weights


def forward_backward(good: np.ndarray, offsets: np.ndarray, moves: np.ndarray, start: np.ndarray):
    """Log forward and backward scores (lines x 2) of all documents at once, and logZ.

    Documents are ordered by length, so step t works on those with more than t lines.
    """
    lens = np.diff(offsets)
    order = np.argsort(-lens, kind="stable")
    first, sizes = offsets[:-1][order], lens[order]
    unary = np.stack([np.zeros_like(good), good], axis=1)
    ahead, back = np.empty_like(unary), np.zeros_like(unary)
    live = np.searchsorted(-sizes, -np.arange(1, (sizes[0] if len(sizes) else 0) + 1), side="right")
    for t, n in enumerate(live):
        at = first[:n] + t
        if t == 0:
            ahead[at] = unary[at] + start
        else:
            a = ahead[at - 1]
            ahead[at, 0] = unary[at, 0] + np.logaddexp(a[:, 0] + moves[0, 0], a[:, 1] + moves[1, 0])
            ahead[at, 1] = unary[at, 1] + np.logaddexp(a[:, 0] + moves[0, 1], a[:, 1] + moves[1, 1])
    for t in range(len(live) - 2, -1, -1):
        at = first[:live[t + 1]] + t
        b = back[at + 1] + unary[at + 1]
        back[at, 0] = np.logaddexp(moves[0, 0] + b[:, 0], moves[0, 1] + b[:, 1])
        back[at, 1] = np.logaddexp(moves[1, 0] + b[:, 0], moves[1, 1] + b[:, 1])
    some = lens > 0
    z = np.zeros(len(lens))
    z[some] = np.logaddexp(*ahead[offsets[1:][some] - 1].T)
    return unary, ahead, back, z


def line_marginals(good: np.ndarray, offsets: np.ndarray, moves: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Probability of good for every line."""
    _, ahead, back, z = forward_backward(good, offsets, moves, start)
    return np.exp(ahead[:, 1] + back[:, 1] - np.repeat(z, np.diff(offsets)))


def pieces(offsets: np.ndarray, most: int = PIECE) -> np.ndarray:
    """``offsets`` with further cuts after every ``most`` lines of a document."""
    cuts = [np.arange(a, b, most) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()) if b - a > most]
    return np.unique(np.concatenate([offsets, *cuts])) if cuts else offsets


def fit(x: np.ndarray, offsets: np.ndarray, labels: np.ndarray, sizes: np.ndarray, rounds: int = 200, rate: float = 0.05,
        ridge: float = 1e-3) -> Chain:
    """Maximum likelihood with every line of a document under the document's label.

    Documents count alike whatever their number of lines, and so do the two classes.
    """
    known = set(labels.tolist())
    if len(known) < 2:
        return Chain(np.zeros(FEATURES), np.ones(FEATURES), np.zeros(3 * FEATURES + 1), np.zeros((2, 2)), np.zeros(2),
                     constant=float(labels.mean()) if len(labels) else 0.5)
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-3
    lens = np.diff(offsets)
    model = Chain(mean, scale, np.zeros(3 * FEATURES + 1), np.zeros((2, 2)), np.zeros(2))
    full = with_neighbours((x - mean) / scale, offsets[:-1][lens > 0], offsets[1:][lens > 0] - 1).astype(float)
    share = np.where(labels == 1, 0.5 / (labels == 1).sum(), 0.5 / (labels == 0).sum())
    weight = share / np.maximum(lens, 1)
    line_weight, line_label = np.repeat(weight, lens), np.repeat(labels, lens)
    chains = pieces(offsets)
    chain_lens = np.diff(chains)
    heads = chains[:-1][chain_lens > 0]
    later = np.ones(len(full), bool)
    later[heads] = False
    theta = np.zeros(len(model.weights) + 6)
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, rounds + 1):
        w, moves, start = theta[:-6], theta[-6:-2].reshape(2, 2), theta[-2:]
        good = full @ w
        unary, ahead, back, z = forward_backward(good, chains, moves, start)
        each = np.repeat(z, chain_lens)
        p = np.exp(ahead[:, 1] + back[:, 1] - each)
        slope = full.T @ (line_weight * (p - line_label))
        at = np.flatnonzero(later)
        move_slope = np.zeros((2, 2))
        for i in (0, 1):
            for j in (0, 1):
                both = np.exp(ahead[at - 1, i] + moves[i, j] + unary[at, j] + back[at, j] - each[at])
                move_slope[i, j] = (line_weight[at] * (both - ((line_label[at] == i) & (i == j)))).sum()
        head_p, head_w, head_y = p[heads], line_weight[heads], line_label[heads]
        start_slope = np.array([(head_w * ((1 - head_p) - (head_y == 0))).sum(), (head_w * (head_p - head_y)).sum()])
        g = np.concatenate([slope, move_slope.ravel(), start_slope]) + ridge * theta
        first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
        theta = theta - rate * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
    model.weights, model.moves, model.start = theta[:-6].copy(), theta[-6:-2].reshape(2, 2).copy(), theta[-2:].copy()
    raw = raw_scores(model, x, offsets, sizes)
    model.cut = best_cut(raw[lens > 0], labels[lens > 0])
    return model


def best_cut(raw: np.ndarray, labels: np.ndarray, spare: float = 1.0) -> float:
    """The middle of the widest gap at which the two classes are told apart best.

    ``spare`` weighs the share of class 0 told rightly against that of class 1.
    """
    order = np.argsort(raw, kind="stable")
    s, y = raw[order], labels[order]
    bad = spare * np.concatenate(([0], np.cumsum(y == 0))) / max(1, (y == 0).sum())
    good = 1 - np.concatenate(([0], np.cumsum(y == 1))) / max(1, (y == 1).sum())
    edges = np.concatenate(([0.0], s, [1.0]))
    right, gap = bad + good, edges[1:] - edges[:-1]
    best = np.flatnonzero(right >= right.max() - 1e-9)
    k = best[np.argmax(gap[best])]
    return float(np.clip((edges[k] + edges[k + 1]) / 2, 1e-6, 1 - 1e-6))


def raw_scores(model: Chain, x: np.ndarray, offsets: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Mean probability of good, weighted by line length; 0 without any character."""
    p = line_marginals(model.evidence(x, offsets), offsets, model.moves, model.start)
    good, total = np.zeros(len(offsets) - 1), np.zeros(len(offsets) - 1)
    some = np.diff(offsets) > 0
    if some.any():  # sums within each document, so that equal texts have equal sums
        good[some] = np.add.reduceat(p * sizes, offsets[:-1][some])
        total[some] = np.add.reduceat(sizes, offsets[:-1][some])
    return np.where(total > 0, good / np.maximum(total, 1), 0.0).clip(0, 1).round(9)


def scores(model: Chain, texts: pa.Array) -> np.ndarray:
    lines, offsets = _line_starts(texts)
    x, sizes = line_features(lines)
    if model.constant is not None:
        total = np.diff(np.concatenate(([0], np.cumsum(sizes)))[offsets])
        return np.where(total > 0, model.constant, 0.0)
    raw = raw_scores(model, x, offsets, sizes)
    return np.where(raw < model.cut, raw / model.cut * KEEP, KEEP + (raw - model.cut) / (1 - model.cut) * (1 - KEEP))


def sampled_ids(labels: DataFrame, column: str, doc_id: str, most: int) -> DataFrame:
    """(__id, __label) of at most ``most`` labelled documents of each class, chosen by a hash of
    the id.  ``labels`` holds (doc_id, label) rows to learn from."""
    known = labels.select(F.col(doc_id).alias("__id"), F.col(column).cast("int").alias("__label")).where(
        "__id is not null and __label in (0, 1)")
    chosen = None
    for value in (0, 1):
        part = known.where(F.col("__label") == value).orderBy(F.xxhash64(F.lit(5), "__id"), "__id").limit(most)
        chosen = part if chosen is None else chosen.unionByName(part)
    return chosen


def sample(documents: DataFrame, labels: DataFrame, column: str, doc_id: str, text: str, most: int) -> DataFrame:
    """(label, text) of the documents of :func:`sampled_ids`."""
    # at most 2 * most rows of two numbers
    chosen = F.broadcast(sampled_ids(labels, column, doc_id, most))
    return documents.join(chosen, documents[doc_id] == F.col("__id")).select(
        F.col("__label").alias("label"), F.col(text).cast("string").alias("text"))


def train(documents: DataFrame, labels: DataFrame, column: str = "quality", doc_id: str = "doc_id",
          text: str = "text", most: int = SAMPLE) -> Chain:
    """Fit the chain on ``documents`` that have a row in ``labels``."""
    rows = sample(documents, labels, column, doc_id, text, most).where(F.col("text").isNotNull())

    def step(texts: pa.Array) -> list[pa.Array]:
        parts, offsets = _line_starts(texts)
        x, sizes = line_features(parts)
        at = pa.array(offsets.astype(np.int32))
        flat = pa.ListArray.from_arrays(pa.array((offsets * FEATURES).astype(np.int32)), pa.array(x.ravel()))
        return [flat, pa.ListArray.from_arrays(at, pa.array(sizes))]

    found = map_text(rows, "text", "x array<float>, sizes array<bigint>", step).select("label", "x", "sizes").toPandas()
    found = found.assign(key=[(int(y), len(s), float(np.sum(v))) for y, s, v in zip(found["label"], found["sizes"], found["x"])]).sort_values("key")
    x = np.concatenate([np.zeros(0, np.float32), *found["x"]]).reshape(-1, FEATURES)
    sizes = np.concatenate([np.zeros(0, np.int64), *found["sizes"]]).astype(np.int64)
    offsets = np.concatenate(([0], np.cumsum([len(s) for s in found["sizes"]]))).astype(np.int64)
    return fit(x, offsets, found["label"].to_numpy(np.int64), sizes)


def score(documents: DataFrame, model: Chain, text: str = "text", out: str = "score") -> DataFrame:
    """``documents`` with the quality of each whole text, 0 to 1."""
    shared = documents.sparkSession.sparkContext.broadcast(model)  # some dozen numbers
    return map_text(documents, text, f"`{out}` double", lambda texts: [pa.array(scores(shared.value, texts))])

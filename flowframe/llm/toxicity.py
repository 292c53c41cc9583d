"""Toxicity from a convolutional text classifier trained in numpy.

A word's vector is the sum of hashed embeddings of the word and its prefixes.  Filters
of several widths run over the word vectors; their responses are max-pooled over short
stretches of the text, and the stretches give a document's features: the largest
response, and the mean over the stretches (so that one chance match in a long text does
not look like many).  A logistic layer makes the score.

At scoring time a filter's response to a word depends on the word alone, so every
distinct word is projected once and positions only gather and add.

Thresholds are calibrated by language on all labelled documents that the net did not learn from:
those outside the sample are scored in Spark and counted by language, label and rounded score;
every ``ASIDE``-th of the sample is left out of training for it.
The language is read off the text (function words; a text without any is a language of its
own), never from a column.  Every language has its own threshold: its counts are smoothed
with ``PRIOR`` documents of each class that are spread like those of all languages.  It is mapped
to 0.7 by a piecewise linear, increasing function.

Training takes a bounded sample of labelled documents (``SAMPLE`` of each class), whole
texts; scoring takes whole texts of any length.

Defined results: null and empty texts have no word and score 0; repeated rows each get
their score; rows without a label, or with a null one, are not learned from; without
labels, or with only one class, every text scores 0 and ``Net.trained`` is false; if calibration
lacks a class, the learned texts count there too; an empty table gives an empty result;
further columns are kept.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowframe.llm.common import map_text, stored
from flowframe.llm.quality import sample, sampled_ids

SAMPLE = 2500
TOXIC = 0.7
BUCKETS = 1 << 15
DIMS = 16
WIDTHS = (1, 2, 3)
FILTERS = 8
PREFIXES = (3, 4, 5, 6, 7)
#: Words in a stretch that is max-pooled.
STRETCH = 32
#: Stretches whose positions are in memory together.
BLOCK = 1024
#: Part of the sample that calibration uses, documents of each class that smooth a language's
#: counts, and the steps of rounded scores.
ASIDE = 4
PRIOR = 20.0
GRADES = 1000
#: Calibration weighs clean documents kept this many times as much as toxic ones caught.
SPARE = 3.0
#: Words whose projections a worker remembers.
CACHED_WORDS = 100_000

#: Frequent function words by language.
FUNCTION_WORDS = {
    "en": "the of and to in is that was for with as by on at be this from".split(),
    "de": "der die das und von zu ist mit den im ein eine für auf nicht dem des".split(),
    "fr": "le la les et des est un une dans pour que qui sur au par du avec".split(),
    "es": "el los y del que las por con para es en se lo una como su al".split(),
}
#: The last one is the language of texts without function words.
LANGUAGES = [*FUNCTION_WORDS, "none"]
TAPS = [(w, j) for w in WIDTHS for j in range(w)]


def word_features(word: str) -> list[int]:
    """Buckets of a word and its prefixes."""
    word = word.strip(".,;:!?()[]{}\"'«»“”…-_*#$%&|")
    raw = [word] + [word[:n] + "-" for n in PREFIXES if n < len(word)]
    return [zlib.crc32(x.encode()) % BUCKETS for x in raw]


def texts_to_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """(word number per position, document offsets, distinct words)."""
    split = pc.ascii_split_whitespace(pc.utf8_lower(texts.fill_null("")))
    coded = split.flatten().dictionary_encode()
    ids = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    words = coded.dictionary.to_pylist()
    at = split.offsets.to_numpy().astype(np.int64) - split.offsets[0].as_py()
    real = np.array([bool(w) for w in words] + [False])[ids]  # white space at an end gives an empty word
    return ids[real], np.concatenate(([0], np.cumsum(real)))[at], words


def stretches(offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every stretch, and the first stretch of each document (and the end)."""
    n = -(-np.diff(offsets) // STRETCH)
    first = np.concatenate(([0], np.cumsum(n)))
    doc = np.repeat(np.arange(len(n)), n)
    start = offsets[doc] + (np.arange(first[-1]) - first[doc]) * STRETCH
    return start, np.minimum(start + STRETCH, offsets[doc + 1]), first


@dataclass
class Net:
    table: np.ndarray
    taps: np.ndarray  # DIMS x (TAPS * FILTERS)
    bias: np.ndarray  # WIDTHS * FILTERS
    out: np.ndarray  # 2 * WIDTHS * FILTERS
    shift: float = 0.0
    cuts: dict[str, float] = field(default_factory=dict)
    trained: bool = True

    def vectors(self, features: list[list[int]]) -> np.ndarray:
        sizes = np.array([len(f) for f in features])
        flat = np.fromiter((i for f in features for i in f), np.int64, int(sizes.sum()))
        starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        return np.add.reduceat(self.table[flat], starts, axis=0) if len(features) else np.zeros((0, DIMS), np.float32)


def responses(projected: np.ndarray, words: np.ndarray, ends: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """Filter responses (positions x filters); ``ends`` is each position's document end,
    ``words`` may reach beyond the positions asked for."""
    n = len(ends)
    out = np.tile(bias, (n, 1))
    at = np.arange(n)
    for t, (width, j) in enumerate(TAPS):
        k = WIDTHS.index(width)
        column = slice(k * FILTERS, (k + 1) * FILTERS)
        part = projected[:, t * FILTERS:(t + 1) * FILTERS]
        if j == 0:
            out[:, column] += part[words[:n]]
        else:
            inside = at[at + j < ends]
            out[inside, column] += part[words[inside + j]]
    return out


def pooled(net: Net, projected: np.ndarray, words: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Document features, block by block of stretches."""
    start, end, first = stretches(offsets)
    lasts = np.repeat(offsets[1:], np.diff(offsets))
    best = np.zeros((len(start), len(net.bias)), np.float32)
    for a in range(0, len(start), BLOCK):
        b = min(a + BLOCK, len(start))
        lo, hi = start[a], end[b - 1]
        r = responses(projected, words[lo:hi + max(WIDTHS)], lasts[lo:hi] - lo, net.bias)
        best[a:b] = np.maximum(np.maximum.reduceat(r, start[a:b] - lo, axis=0), 0)
    n = np.diff(first)
    some = n > 0
    top, mean = (np.zeros((len(n), best.shape[1]), np.float32) for _ in range(2))
    if len(best):
        top[some] = np.maximum.reduceat(best, first[:-1][some], axis=0)
        mean[some] = np.add.reduceat(best, first[:-1][some], axis=0) / n[some, None]
    return np.concatenate([top, mean], axis=1)


def train_net(words: np.ndarray, offsets: np.ndarray, names: list[str], labels: np.ndarray, epochs: int = 8,
              batch: int = 64, rate: float = 0.01, seed: int = 3) -> Net:
    """Adam on the weighted logistic loss; gradients flow through the pooled positions."""
    rng = np.random.default_rng(seed)
    filters = len(WIDTHS) * FILTERS
    net = Net((rng.standard_normal((BUCKETS, DIMS)) * 0.1).astype(np.float32),
              (rng.standard_normal((DIMS, len(TAPS) * FILTERS)) * 0.3).astype(np.float32),
              np.zeros(filters, np.float32), (rng.standard_normal(2 * filters) * 0.1).astype(np.float32))
    features = [word_features(w) for w in names]
    params = [net.table, net.taps, net.bias, net.out, np.zeros(1, np.float32)]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    share = np.where(labels == 1, 0.5 / max(1, (labels == 1).sum()), 0.5 / max(1, (labels == 0).sum())) * len(labels)
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(labels))
        for at in range(0, len(order), batch):
            docs = order[at:at + batch]
            sizes = offsets[docs + 1] - offsets[docs]
            where = np.concatenate([np.arange(offsets[d], offsets[d + 1]) for d in docs])
            used, own = np.unique(words[where], return_inverse=True)
            at_doc = np.concatenate(([0], np.cumsum(sizes)))
            start, end, first = stretches(at_doc)
            x = net.vectors([features[i] for i in used])
            projected = x @ net.taps
            r = responses(projected, own, np.repeat(at_doc[1:], sizes), net.bias)
            place = np.minimum(start[:, None] + np.arange(STRETCH), end[:, None] - 1)
            window = r[place] if len(start) else np.zeros((0, STRETCH, filters), np.float32)
            arg = window.argmax(axis=1)
            best = np.take_along_axis(window, arg[:, None], 1)[:, 0]
            spot = np.take_along_axis(place, arg, 1)
            live = best > 0
            best = np.where(live, best, 0)
            n = np.diff(first)
            some = n > 0
            top, mean = np.zeros((len(docs), filters), np.float32), np.zeros((len(docs), filters), np.float32)
            if len(best):
                top[some] = np.maximum.reduceat(best, first[:-1][some], axis=0)
                mean[some] = np.add.reduceat(best, first[:-1][some], axis=0) / n[some, None]
            doc_features = np.concatenate([top, mean], axis=1)
            logit = doc_features @ net.out + params[4][0]
            p = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
            d_logit = ((p - labels[docs]) * share[docs] / len(docs)).astype(np.float32)
            d_features = d_logit[:, None] * net.out
            owner = np.repeat(np.arange(len(docs)), n)
            d_best = d_features[owner, filters:] / np.maximum(n, 1)[owner, None]
            d_best = d_best + d_features[owner, :filters] * (best == top[owner])
            d_best = np.where(live, d_best, 0).astype(np.float32)
            d_projected = np.zeros_like(projected)
            lasts = at_doc[1:][owner]
            for t, (width, j) in enumerate(TAPS):
                k = WIDTHS.index(width)
                g, pos = d_best[:, k * FILTERS:(k + 1) * FILTERS], spot[:, k * FILTERS:(k + 1) * FILTERS] + j
                ok = (pos < lasts[:, None]) & (g != 0)
                rows, cols = np.nonzero(ok)
                np.add.at(d_projected, (own[pos[rows, cols]], t * FILTERS + cols), g[rows, cols])
            d_x = d_projected @ net.taps.T
            d_table = np.zeros_like(net.table)
            np.add.at(d_table, np.concatenate([features[i] for i in used]).astype(np.int64), np.repeat(d_x, [len(features[i]) for i in used], axis=0))
            grads = [d_table, x.T @ d_projected, d_best.sum(axis=0), doc_features.T @ d_logit + 1e-4 * net.out, d_logit.sum(keepdims=True)]
            step += 1
            for param, grad, (m, v) in zip(params, grads, moments):
                m += 0.1 * (grad - m)
                v += 0.001 * (grad * grad - v)
                param -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    net.shift = float(params[4][0])
    return net


def language_counts(words: np.ndarray, offsets: np.ndarray, names: list[str]) -> np.ndarray:
    """The language of each document: a number in LANGUAGES."""
    known = len(LANGUAGES) - 1
    marks = np.zeros((len(names) + 1, known), np.int64)
    where = {w: i for i, w in enumerate(names)}
    for k, lang in enumerate(LANGUAGES[:known]):
        for w in FUNCTION_WORDS[lang]:
            if w in where:
                marks[where[w], k] = 1
    counts = np.stack([np.diff(np.concatenate(([0], np.cumsum(marks[words, k])))[offsets]) for k in range(known)], axis=1)
    return np.where(counts.any(axis=1), counts.argmax(axis=1), known)


class Scorer:
    """A net with the projections of the words a worker has met."""

    def __init__(self, net: Net) -> None:
        self.net, self.rows, self.held = net, {}, np.zeros((0, len(TAPS) * FILTERS), np.float32)

    def projected(self, names: list[str]) -> np.ndarray:
        if len(self.rows) > CACHED_WORDS:
            self.rows, self.held = {}, self.held[:0]
        fresh = [w for w in names if w not in self.rows]
        if fresh:
            new = self.net.vectors([word_features(w) for w in fresh]) @ self.net.taps
            self.rows.update(zip(fresh, range(len(self.held), len(self.held) + len(fresh))))
            self.held = np.concatenate([self.held, new])
        return self.held[[self.rows[w] for w in names]] if names else self.held[:0]

    def raw(self, words: np.ndarray, offsets: np.ndarray, names: list[str]) -> np.ndarray:
        logit = pooled(self.net, self.projected(names), words, offsets) @ self.net.out + self.net.shift
        return np.where(np.diff(offsets) > 0, 1 / (1 + np.exp(-np.clip(logit, -30, 30))), 0.0).round(6)

    def scores(self, texts: pa.Array) -> np.ndarray:
        if not self.net.trained:
            return np.zeros(len(texts))
        words, offsets, names = texts_to_words(texts)
        raw = self.raw(words, offsets, names)
        cut = np.array([self.net.cuts[x] for x in LANGUAGES])[language_counts(words, offsets, names)]
        return np.where(raw < cut, raw / cut * TOXIC, TOXIC + (raw - cut) / (1 - cut) * (1 - TOXIC))


def graded(scorer: Scorer, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Language number and rounded uncalibrated score of each text."""
    words, offsets, names = texts_to_words(texts)
    return language_counts(words, offsets, names), np.rint(scorer.raw(words, offsets, names) * GRADES).astype(np.int64)


def cut_of(clean: np.ndarray, toxic: np.ndarray) -> float:
    """The threshold between two grades that best parts the two distributions over grades, clean
    documents weighing ``SPARE`` times as much; of equal ones, the middle of the widest gap."""
    both = np.flatnonzero(clean + toxic)
    kept = SPARE * np.concatenate(([0], np.cumsum(clean[both]))) / max(clean.sum(), 1e-9)
    caught = 1 - np.concatenate(([0], np.cumsum(toxic[both]))) / max(toxic.sum(), 1e-9)
    edges = np.concatenate(([0], both, [GRADES]))
    right, gap = kept + caught, edges[1:] - edges[:-1]
    best = np.flatnonzero(right >= right.max() - 1e-9)
    k = best[np.argmax(gap[best])]
    return float(np.clip((edges[k] + edges[k + 1]) / 2 / GRADES, 1e-6, 1 - 1e-6))


def calibrate(net: Net, counts: np.ndarray) -> None:
    """Set a threshold for every language from ``counts`` (language, label, grade)."""
    every = counts.sum(axis=0).astype(float)
    spread = every / np.maximum(every.sum(axis=1, keepdims=True), 1)
    for k, lang in enumerate(LANGUAGES):
        smooth = counts[k] + PRIOR * spread
        net.cuts[lang] = cut_of(smooth[0], smooth[1])


def fit(texts: list[str], labels: np.ndarray, others: Callable[[Net], np.ndarray] | None = None) -> Net:
    """Train on most texts; calibrate on the scores of the rest (every ``ASIDE``-th by a hash of the whole
    text, so equal texts stay together) and on the counts that ``others`` gives of further
    labelled documents scored by the net.  If these lack a class, the texts learned from count too."""
    if len(set(labels.tolist())) < 2:
        return Net(np.zeros((1, DIMS)), np.zeros((DIMS, 1)), np.zeros(1), np.zeros(1), trained=False)
    aside = np.array([zlib.crc32(t.encode()) % ASIDE == 0 for t in texts])
    if len(set(labels[~aside].tolist())) < 2:
        aside[:] = False
    net = train_net(*texts_to_words(pa.array([t for t, a in zip(texts, aside) if not a], pa.string())), labels[~aside])
    counts = others(net) if others else np.zeros((len(LANGUAGES), 2, GRADES + 1), np.int64)

    def add(some: np.ndarray) -> None:
        langs, grades = graded(Scorer(net), pa.array([t for t, x in zip(texts, some) if x], pa.string()))
        np.add.at(counts, (langs, labels[some], grades), 1)

    add(aside)
    if not counts.sum(axis=(0, 2)).all():
        add(~aside)
    calibrate(net, counts)
    return net


def graded_documents(documents: DataFrame, net: Net, doc_id: str, text: str) -> DataFrame:
    """(__id, lang, raw) of every document: language number and uncalibrated score; texts stay where they are."""
    shared = documents.sparkSession.sparkContext.broadcast(net)  # a table of BUCKETS x DIMS floats: 2 MB

    def step(scorer: Scorer, part: pa.Array) -> list[pa.Array]:
        words, offsets, names = texts_to_words(part)
        return [pa.array(language_counts(words, offsets, names)), pa.array(scorer.raw(words, offsets, names).astype(np.float64))]

    rows = documents.select(F.col(f"`{doc_id}`").alias("__id"), F.col(f"`{text}`").alias("text"))
    return map_text(rows, "text", "lang bigint, raw double", step, lambda: Scorer(shared.value)).select("__id", "lang", "raw")


def counted(scored: DataFrame, labels: DataFrame, column: str, doc_id: str, most: int) -> np.ndarray:
    """Counts (language, label, grade) of the labelled documents outside the sample."""
    known = labels.select(F.col(doc_id).alias("__id"), F.col(column).cast("int").alias("label")).where("__id is not null and label in (0, 1)")
    left = known.join(F.broadcast(sampled_ids(labels, column, doc_id, most)), "__id", "left_anti")  # 2 * most ids
    rows = scored.select("__id", "lang", F.rint(F.col("raw") * GRADES).cast("bigint").alias("grade")).join(left, "__id")
    out = np.zeros((len(LANGUAGES), 2, GRADES + 1), np.int64)
    for r in rows.groupBy("lang", "label", "grade").count().toLocalIterator():  # at most languages x 2 x grades rows
        out[r["lang"], r["label"], r["grade"]] = r["count"]
    return out


def _fitted(documents: DataFrame, labels: DataFrame, column: str, doc_id: str, text: str, most: int,
            others: Callable[[Net], np.ndarray]) -> Net:
    rows = sample(documents, labels, column, doc_id, text, most).toPandas()
    rows = rows.assign(text=rows["text"].fillna("")).sort_values(["text", "label"])
    return fit(rows["text"].tolist(), rows["label"].to_numpy(np.int64), others)


def train(documents: DataFrame, labels: DataFrame, column: str = "toxic", doc_id: str = "doc_id",
          text: str = "text", most: int = SAMPLE) -> Net:
    """Fit the classifier on ``documents`` that have a row in ``labels``."""
    return _fitted(documents, labels, column, doc_id, text, most,
                   lambda net: counted(graded_documents(documents, net, doc_id, text), labels, column, doc_id, most))


def train_and_score(documents: DataFrame, labels: DataFrame, column: str = "toxic", doc_id: str = "doc_id",
                    text: str = "text", out: str = "score", most: int = SAMPLE) -> DataFrame:
    """(``doc_id``, ``out``) of every row of ``documents`` by a classifier fitted on those with a label:
    :func:`train` and :func:`score` with one pass over the texts for calibration and result."""
    scored: list[DataFrame] = []

    def others(net: Net) -> np.ndarray:
        scored.append(stored(graded_documents(documents, net, doc_id, text)))
        return counted(scored[0], labels, column, doc_id, most)

    net = _fitted(documents, labels, column, doc_id, text, most, others)
    if not net.trained:
        return documents.select(F.col(f"`{doc_id}`").alias(doc_id), F.lit(0.0).alias(out))
    raw, cut = F.col("raw"), F.element_at(F.array(*[F.lit(net.cuts[x]) for x in LANGUAGES]), (F.col("lang") + 1).cast("int"))
    value = F.when(raw < cut, raw / cut * TOXIC).otherwise(TOXIC + (raw - cut) / (1 - cut) * (1 - TOXIC))
    return scored[0].select(F.col("__id").alias(doc_id), value.alias(out))


def score(documents: DataFrame, net: Net, text: str = "text", out: str = "score") -> DataFrame:
    """``documents`` with the toxicity of each whole text, 0 to 1."""
    shared = documents.sparkSession.sparkContext.broadcast(net)
    return map_text(documents, text, f"`{out}` double", lambda scorer, texts: [pa.array(scorer.scores(texts))],
                    lambda: Scorer(shared.value))

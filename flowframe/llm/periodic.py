"""Periodic runs of words by suffix-tree longest common extensions.

A run is a stretch of words with smallest period q, at least ``least`` words and
``repeats`` * q long, that no neighbouring word extends with that period.

Method: Ukkonen suffix trees of the words and of their reversal; an Euler tour of each
tree and range minima over its depths answer any longest common extension in constant
time (the depth of the lowest common ancestor of two leaves).  Every run holds, for the
order of words in which the word after it is the smaller one, a Lyndon root that is the
longest Lyndon word at its place; so the longest Lyndon words of every position in
both orders (next smaller and next greater suffix, read off the order of the leaves) are
all candidates, and each is extended both ways.

Trees are built only over stretches that can hold a run.  A run has length >= max(24, 3q)
(in general: ``least`` and ``repeats`` * q, with ``repeats`` >= 3), so each of its words lies
in a gram of ``least`` * 2 / 3 words that occurs again q words away within the run.
Grams of equal hash are a superset of these, so nothing is lost, and a run never
leaves the stretch of words that such grams cover.

Defined results: a null, empty or blank text has no words and no runs, and collapses to the
empty text; rows are independent, so repeated rows repeat and an empty table stays
empty; other columns are kept whatever their names.  One text is held by one task;
trees take about 1 kB for each word of the longest stretch that repeats.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from flowframe.llm.common import steps

#: Shortest run and least number of periods in it.
LEAST, REPEATS = 24, 3
#: Tour entries in one block of the range minima.
BLOCK = 32
#: Odd multipliers that combine the hashes of two halves of a gram.
MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)


class SuffixTree:
    """Ukkonen's tree of ``word`` (whole numbers >= 0) and a closing symbol that sorts first."""

    def __init__(self, word: list[int]) -> None:
        self.word = [*word, -1]
        self._build()
        self._tour()

    def _build(self) -> None:
        word, n = self.word, len(self.word)
        first, last, link, kids, leaf = [0], [0], [0], [{}], [-1]
        node = edge = length = waiting = 0
        for i, c in enumerate(word):
            waiting += 1
            unlinked = -1
            while waiting:
                if not length:
                    edge = i
                child = kids[node].get(word[edge])
                if child is None:
                    kids[node][word[edge]] = len(first)
                    first.append(i), last.append(n), link.append(0), kids.append(None), leaf.append(i - waiting + 1)
                    if unlinked >= 0:
                        link[unlinked], unlinked = node, -1
                else:
                    size = last[child] - first[child]
                    if length >= size:
                        edge, length, node = edge + size, length - size, child
                        continue
                    at = first[child] + length
                    if word[at] == c:
                        length += 1
                        if unlinked >= 0:
                            link[unlinked] = node
                        break
                    split = len(first)
                    first.append(first[child]), last.append(at), link.append(0), leaf.append(-1)
                    kids.append({word[at]: child, c: split + 1})
                    kids[node][word[edge]] = split
                    first[child] = at
                    first.append(i), last.append(n), link.append(0), kids.append(None), leaf.append(i - waiting + 1)
                    if unlinked >= 0:
                        link[unlinked] = split
                    unlinked = split
                waiting -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    edge = i - waiting + 1
        self.first, self.last, self.kids, self.leaf = first, last, kids, leaf

    def _tour(self) -> None:
        """Depths along the Euler tour, the place of every leaf in it, and the leaves in order."""
        first, last, kids, leaf, n = self.first, self.last, self.kids, self.leaf, len(self.word)
        depth, tour, order, place, stack = [0] * len(first), [], [], [0] * n, [0]
        while stack:
            x = stack.pop()
            if x < 0:  # back at a node of this depth
                tour.append(~x)
            elif leaf[x] >= 0:
                place[leaf[x]] = len(tour)
                order.append(leaf[x])
                tour.append(n - leaf[x])
            else:
                d = depth[x]
                tour.append(d)
                for _, k in sorted(kids[x].items(), reverse=True):
                    depth[k] = d + last[k] - first[k]
                    stack.append(~d)
                    stack.append(k)
        del self.first, self.last, self.kids, self.leaf
        self.order, self.place = order, np.array(place, np.int64)
        size = -len(tour) % BLOCK
        depths = np.array(tour + [0] * size, np.int32)
        blocks = depths.reshape(-1, BLOCK)
        self.left = np.minimum.accumulate(blocks, axis=1).ravel()
        self.right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        self.near = _minima(depths, BLOCK)
        self.far = _minima(blocks.min(axis=1), len(blocks))

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the longest common extension of positions ``i`` and ``j`` (unequal)."""
        a, b = self.place[i], self.place[j]
        a, b = np.minimum(a, b), np.maximum(a, b)
        out = np.minimum(self.right[a], self.left[b])
        p, q = a // BLOCK, b // BLOCK
        same, wide = p == q, q - p > 1
        out[same] = _minimum(self.near, a[same], b[same])
        out[wide] = np.minimum(out[wide], _minimum(self.far, p[wide] + 1, q[wide] - 1))
        return out


def _minima(values: np.ndarray, span: int) -> list[np.ndarray]:
    """Minima of 1, 2, 4, ... values from each place on, for ranges of up to ``span`` values."""
    levels, width = [values], 1
    while width * 2 <= min(span, len(values)):
        levels.append(np.minimum(levels[-1][:-width], levels[-1][width:]))
        width *= 2
    return levels


def _minimum(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least value of each range a to b, both included."""
    out = np.empty(len(a), np.int32)
    level = np.frexp((b - a + 1).astype(np.float64))[1] - 1
    for k in np.unique(level):
        at = level == k
        out[at] = np.minimum(levels[k][a[at]], levels[k][b[at] - (1 << int(k)) + 1])
    return out


def lyndon_candidates(order: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of the longest Lyndon word at every position, for the order of the
    symbols and for the opposite one; ``order`` lists the suffixes from the smallest."""
    n = len(order)
    rank = [0] * n
    for r, i in enumerate(order):
        rank[i] = r
    starts, ends = [], []
    smaller, greater = [], []
    for i in range(n - 1, -1, -1):
        r = rank[i]
        while smaller and rank[smaller[-1]] > r:
            smaller.pop()
        if smaller:
            starts.append(i)
            ends.append(smaller[-1])
        smaller.append(i)
        while greater and rank[greater[-1]] < r:
            greater.pop()
        if greater:
            starts.append(i)
            ends.append(greater[-1])
        greater.append(i)
    return np.array(starts, np.int64), np.array(ends, np.int64)


def runs_of(word: list[int], least: int = LEAST, repeats: int = REPEATS) -> set[tuple[int, int, int]]:
    """(start, length, period) of every run of ``word``."""
    n = len(word)
    if n < max(least, repeats):
        return set()
    tree = SuffixTree(word)
    i, j = lyndon_candidates(tree.order)
    ahead = tree.common(i, j)
    del tree
    back = SuffixTree(word[::-1])
    behind = np.zeros(len(i), np.int64)
    inner = i > 0
    behind[inner] = back.common(n - i[inner], n - j[inner])
    period = j - i
    start, length = i - behind, behind + period + ahead
    held = (length >= repeats * period) & (length >= least)
    return set(zip(start[held].tolist(), length[held].tolist(), period[held].tolist()))


def gram_hashes(words: list[bytes], size: int) -> np.ndarray:
    """A 64-bit hash of the ``size`` (a power of two) words from each place on."""
    h, width = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64), 1
    while width < size:
        a, b = MULTIPLIERS[width.bit_length() % 4], MULTIPLIERS[(width.bit_length() + 1) % 4]
        h = h[:-width] * np.uint64(a) + (h[width:] ^ (h[width:] >> np.uint64(29))) * np.uint64(b)
        width *= 2
    return h


def stretches(words: list[bytes], least: int = LEAST, repeats: int = REPEATS) -> list[tuple[int, int]]:
    """Spans of ``words`` outside of which there is no run."""
    n = len(words)
    if n < max(least, repeats):
        return []
    gram = 1 << max(0, (least * 2 // 3).bit_length() - 1)
    grams = gram_hashes(words, gram)
    ordered = np.sort(grams)
    if not (ordered[1:] == ordered[:-1]).any():
        return []
    spans = [(0, n)]
    while True:
        found = []
        for a, b in spans:
            found += _covered(grams[a:b - gram + 1], a, gram, (b - a) // repeats)
        found = [(a, b) for a, b in found if b - a >= max(least, repeats)]
        if found == spans:
            return spans
        spans = found


def _covered(grams: np.ndarray, first: int, gram: int, reach: int) -> list[tuple[int, int]]:
    """Spans covered by grams whose nearest equal gram is at most ``reach`` places away."""
    order = np.argsort(grams, kind="stable")
    hashes = grams[order]
    near = np.flatnonzero((hashes[1:] == hashes[:-1]) & (order[1:] - order[:-1] <= reach))
    held = np.unique(np.concatenate((order[near], order[near + 1])))
    if not len(held):
        return []
    gaps = np.flatnonzero(np.diff(held) > gram)
    starts = held[np.concatenate(([0], gaps + 1))] + first
    ends = held[np.concatenate((gaps, [len(held) - 1]))] + gram + first
    return list(zip(starts.tolist(), ends.tolist()))


def periodic_runs(words: list[bytes], least: int = LEAST, repeats: int = REPEATS) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start, then period."""
    found = []
    for a, b in stretches(words, least, repeats):
        codes: dict[bytes, int] = {}
        word = [codes.setdefault(w, len(codes)) for w in words[a:b]]
        found += [(a + s, length, q) for s, length, q in runs_of(word, least, repeats)]
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words outside every run's second and later periods."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    kept = np.cumsum(change[:-1]) == 0
    return [w for w, k in zip(words, kept.tolist()) if k]


def find_runs(docs: DataFrame, text: str = "text", runs: str = "runs", collapse: str = "collapsed",
              least: int = LEAST, repeats: int = REPEATS) -> DataFrame:
    """``docs`` without ``text``, with its ``runs`` (array of start, length, period in words, by start,
    then period) and the text left when each run is reduced to its first period, its words
    joined by one space."""
    if repeats < 3 or least < 3:
        raise ValueError("runs of fewer than 3 periods or words are not searched")
    kept = [c for c in docs.columns if c != text]
    fields = docs.select(F.col(f"`{text}`").cast("string").alias(text), *[F.col(f"`{c}`") for c in kept])
    added = StructType.fromDDL(f"`{runs}` array<struct<start: bigint, length: bigint, period: bigint>>, `{collapse}` string")
    schema = StructType([*fields.schema.fields[1:], *added.fields])
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch):
                found, left = [], []
                for value in part.column(0).cast(pa.binary()):
                    words = (value.as_py() or b"").split()
                    one = periodic_runs(words, least, repeats)
                    found.append([dict(zip(("start", "length", "period"), r)) for r in one])
                    left.append(b" ".join(collapsed(words, one)))
                yield pa.RecordBatch.from_arrays([*part.columns[1:], pa.array(found, kind), pa.array(left, pa.binary()).cast(pa.string())],
                                                 names=schema.names)

    return fields.mapInArrow(run, schema)


def longest(runs: Column) -> Column:
    """The run of greatest exact length / period; ties to the smallest start, then period."""
    def better(best: Column, r: Column) -> Column:
        own, other = r["length"] * best["period"], best["length"] * r["period"]
        earlier = (r["start"] < best["start"]) | ((r["start"] == best["start"]) & (r["period"] < best["period"]))
        return F.when(best.isNull() | (own > other) | ((own == other) & earlier), r).otherwise(best)

    kind = "struct<start: bigint, length: bigint, period: bigint>"
    return F.reduce(runs, F.lit(None).cast(kind), better)


def words_column(text: Column) -> Column:
    """The words of a text: maximal runs of other characters than ASCII white space."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def repeat_tail(doc_id: Column, text: Column) -> Column:
    """``text`` whose words from a place on are made periodic, for a tenth of the ids: with
    h = crc32 of the decimal id divisible by 10 and g = h // 10, word i >= a = g % n becomes
    word a + (i - a) % p, p = 1 + (n - a) // (3 + g % 8).  A null id changes nothing."""
    h = F.crc32(F.encode(doc_id.cast("string"), "UTF-8"))
    g = F.floor(h / 10)

    def edited(words: Column) -> Column:
        n = F.size(words).cast("bigint")
        a = F.pmod(g, n)
        p = 1 + F.floor((n - a) / (3 + g % 8))
        return F.transform(F.sequence(F.lit(0).cast("bigint"), n - 1),
                           lambda i: F.get(words, F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")))

    words = words_column(text)
    # an array of one value: its words are split once, not once for every use
    joined = F.get(F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, F.array_join(edited(w), " "))), 0)
    return F.when(h % 10 == 0, joined).otherwise(text)

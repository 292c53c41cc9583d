"""Histogram gradient boosting for squared error (K5, histogram form).

Features are cut into at most ``max_bins`` bins at approximate quantiles (one mergeable
sketch a column), plus a bin for missing values, and the rows are written once as bin
numbers.  A tree grows leaf by leaf, the leaf of greatest gain first.  Which leaves those
are is replayed from a queue of known gains; every leaf that the replay splits without knowing
its children is split in one common job, so a tree takes about as many jobs as it is
deep.  A job sums gradients and counts by (leaf, feature, bin) in each task, merges them on
the executors, and only for the smaller child: its sibling is the parent less that.
The driver holds histograms of one tree: leaves x features x bins, whatever the rows.

Missing values go to the side where they gain more (right, if none were seen in training).
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from flowframe.operators.trees import LeafTable, leaf_table
from flowframe.session import checkpoint

#: Trees after which the rows' predictions are written anew.
REBASE = 10


@dataclass
class Node:
    """A leaf or split of a growing tree; a split sends bins <= ``bin`` left."""

    sums: np.ndarray            # (features, bins, 2): gradient and count
    total: tuple[float, float]  # gradient and count of the node
    depth: int
    gain: float = -np.inf
    feature: int = -1
    bin: int = -1
    missing_left: bool = False
    children: tuple[int, int] | None = None


@dataclass
class HistogramModel:
    """Fitted trees over binned features."""

    features: list[str]
    edges: list[np.ndarray]               # ascending upper edges of each feature's bins but the last
    start: float
    trees: list[list[tuple]] = field(default_factory=list)  # (left, right, feature, bin, count, value, missing_left)

    def binned(self, x: np.ndarray) -> np.ndarray:
        """Bin numbers of ``x`` (rows, features); the bin after a feature's last one is for missing values."""
        out = np.empty(x.shape, np.uint16)
        for j, e in enumerate(self.edges):
            out[:, j] = np.where(np.isnan(x[:, j]), len(e) + 1, np.searchsorted(e, x[:, j], side="left"))
        return out

    def add(self, bins: np.ndarray, trees: Sequence[list[tuple]]) -> np.ndarray:
        """The sum of ``trees`` for binned rows."""
        total = np.zeros(len(bins))
        for tree in trees:
            total += np.array([n[5] for n in tree])[leaves_of(tree, bins, self.edges)]
        return total

    def leaves(self) -> LeafTable:
        """The same model over unbinned values, for attribution."""
        trees = [{i: (left, right, f, float(self.edges[f][b]) if left >= 0 else 0.0, n, value, missing)
                  for i, (left, right, f, b, n, value, missing) in enumerate(tree)} for tree in self.trees]
        table = leaf_table(trees)
        table.constant += self.start
        return table

    def transform(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        """``df`` with the model's prediction of every row."""
        shared = df.sparkSession.sparkContext.broadcast(self)
        n = len(self.features)
        wide = df.select(*[F.col(f"`{f}`").cast("double").alias(f"_x{i}") for i, f in enumerate(self.features)], *[F.col(f"`{c}`") for c in df.columns])
        schema = StructType([*df.schema.fields, StructField(out, DoubleType())])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            model = shared.value
            for batch in batches:
                value = model.start + model.add(model.binned(_matrix(batch, n)), model.trees)
                yield pa.RecordBatch.from_arrays([*batch.columns[n:], pa.array(value)], names=schema.names)

        return wide.mapInArrow(run, schema)


def _matrix(batch: pa.RecordBatch, n: int) -> np.ndarray:
    if not batch.num_rows:
        return np.empty((0, n))
    return np.column_stack([batch.column(i).to_numpy(zero_copy_only=False).astype(float) for i in range(n)])


def leaves_of(tree: list[tuple], bins: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """The number of each row's leaf in a (growing) tree."""
    left, right, feature, cut, missing_left = (np.array([n[i] for n in tree], np.int64) for i in (0, 1, 2, 3, 6))
    holes = np.array([len(e) + 1 for e in edges])
    at = np.zeros(len(bins), np.int64)
    moving = np.arange(len(bins))
    while len(moving):
        moving = moving[left[at[moving]] >= 0]
        node = at[moving]
        b = bins[moving, feature[node]]
        lost = b == holes[feature[node]]
        goes_left = np.where(lost, missing_left[node] > 0, b <= cut[node])
        at[moving] = np.where(goes_left, left[node], right[node])
    return at


def bin_edges(df: DataFrame, features: Sequence[str], max_bins: int = 255) -> list[np.ndarray]:
    """Middles between neighbouring approximate quantiles of each column."""
    shares = [i / max_bins for i in range(max_bins + 1)]
    value = lambda f: F.when(~F.isnan(F.col(f"`{f}`").cast("double")), F.col(f"`{f}`").cast("double"))
    row = df.agg(*[F.percentile_approx(value(f), shares, 10_000).alias(f"q{i}") for i, f in enumerate(features)]).first()
    found = []
    for picks in row:
        distinct = np.unique(np.array(picks or [], float))
        found.append(((distinct[1:] + distinct[:-1]) / 2)[:max_bins - 1])
    return found


def best_split(node: Node, edges: list[np.ndarray], min_leaf: int, l2: float) -> None:
    """Find the split of greatest gain; ties to the first feature, the lowest bin, missing values right."""
    g, n = node.total
    own = g * g / (n + l2) if n + l2 else 0.0
    for j, e in enumerate(edges):
        if not len(e):
            continue
        sums = node.sums[j]
        lost = sums[len(e) + 1]
        left = np.cumsum(sums[:len(e)], axis=0)
        for missing_left in ((False, True) if lost[1] else (False,)):
            gl, nl = (left + lost if missing_left else left).T
            gr, nr = g - gl, n - nl
            fits = (nl >= max(min_leaf, 1)) & (nr >= max(min_leaf, 1))
            if not fits.any():
                continue
            gain = np.full(len(e), -np.inf)
            gain[fits] = gl[fits] ** 2 / (nl[fits] + l2) + gr[fits] ** 2 / (nr[fits] + l2) - own
            k = int(np.argmax(gain))
            if gain[k] > max(node.gain, 1e-12 * abs(own)):
                node.gain, node.feature, node.bin, node.missing_left = float(gain[k]), j, k, missing_left


def _listed(nodes: list[Node], values: Sequence[float] | None = None) -> list[tuple]:
    return [(*(n.children or (-1, -1)), n.feature if n.children else -1, n.bin if n.children else -1, n.total[1],
             values[i] if values else 0.0, n.missing_left) for i, n in enumerate(nodes)]


def fit_histogram(df: DataFrame, features: Sequence[str], label: str, n_iter: int = 100, learning_rate: float = 0.1,
                  max_leaves: int = 31, min_leaf: int = 20, max_bins: int = 255, l2: float = 0.0,
                  max_depth: int | None = None) -> HistogramModel:
    """K5: ``HistGradientBoostingRegressor``: squared error, rows without a label left out.

    An empty table gives a model that predicts 0.
    """
    names = list(features)
    rows = df.where(F.col(f"`{label}`").isNotNull())
    mean = rows.agg(F.avg(f"`{label}`")).first()[0]
    model = HistogramModel(names, bin_edges(rows, names, max_bins), float(mean or 0.0))
    if mean is None:
        return model
    shared = df.sparkSession.sparkContext.broadcast(model.edges)
    wide = rows.select(*[F.col(f"`{f}`").cast("double").alias(f"_x{i}") for i, f in enumerate(names)], F.col(f"`{label}`").cast("double").alias("y"))
    start = model.start

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blank = HistogramModel(names, shared.value, start)
        for batch in batches:
            bins = blank.binned(_matrix(batch, len(names)))
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in bins], pa.binary()), batch.column(len(names)),
                                              pa.array(np.full(len(bins), start))], names=["bins", "y", "p"])

    data = checkpoint(wide.mapInArrow(number, "bins binary, y double, p double"))
    pending: list[list[tuple]] = []
    for _ in range(n_iter):
        tree = _grow(data, model, pending, learning_rate, max_leaves, min_leaf, l2, max_depth)
        model.trees.append(tree)
        pending.append(tree)
        if len(pending) == REBASE:
            data, pending = _rebased(data, model, pending), []
    return model


def _rows_of(batch: pa.RecordBatch, n: int) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint16).reshape(-1, n)


def _rebased(data: DataFrame, model: HistogramModel, pending: list[list[tuple]]) -> DataFrame:
    """The binned rows with the pending trees added to their predictions, written."""
    shared = data.sparkSession.sparkContext.broadcast((model, pending))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, trees = shared.value
        for batch in batches:
            p = batch.column(2).to_numpy() + own.add(_rows_of(batch, len(own.edges)), trees)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(p)], names=["bins", "y", "p"])

    return checkpoint(data.mapInArrow(run, "bins binary, y double, p double"))


def _histograms(data: DataFrame, model: HistogramModel, pending: list[list[tuple]], tree: list[tuple], wanted: list[int]) -> dict[int, np.ndarray]:
    """(features, bins, 2) of gradient and count of the rows in each wanted leaf of ``tree``."""
    width = max((len(e) for e in model.edges), default=0) + 2
    d = len(model.edges)
    shared = data.sparkSession.sparkContext.broadcast((model.edges, pending, tree, wanted))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges, trees, growing, leaves = shared.value
        own = HistogramModel([], edges, 0.0)
        place = np.full(len(growing), -1)
        place[leaves] = np.arange(len(leaves))
        sums = np.zeros((2, len(leaves) * d * width))
        for batch in batches:
            bins = _rows_of(batch, d)
            slot = place[leaves_of(growing, bins, edges)]
            held = slot >= 0
            bins, slot = bins[held], slot[held]
            gap = batch.column(1).to_numpy()[held] - batch.column(2).to_numpy()[held] - own.add(bins, trees)
            cell = ((slot[:, None] * d + np.arange(d)) * width + bins).ravel()
            sums[0] += np.bincount(cell, np.repeat(gap, d), minlength=sums.shape[1])
            sums[1] += np.bincount(cell, minlength=sums.shape[1])
        at = np.flatnonzero(sums[1])
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums[0][at]), pa.array(sums[1][at])], names=["cell", "g", "n"])

    merged = data.mapInArrow(run, "cell bigint, g double, n double").groupBy("cell").agg(F.sum("g").alias("g"), F.sum("n").alias("n")).toArrow()
    flat = np.zeros((len(wanted) * d * width, 2))
    flat[merged.column("cell").to_numpy()] = np.column_stack([merged.column("g").to_numpy(), merged.column("n").to_numpy()])
    return dict(zip(wanted, flat.reshape(len(wanted), d, width, 2)))


def _grow(data: DataFrame, model: HistogramModel, pending: list[list[tuple]], learning_rate: float, max_leaves: int,
          min_leaf: int, l2: float, max_depth: int | None) -> list[tuple]:
    """One tree: the leaf of greatest gain is split first, until there are ``max_leaves``."""
    edges = model.edges

    def made(sums: np.ndarray, depth: int) -> Node:
        total = tuple(sums[0].sum(axis=0)) if len(edges) else (0.0, 0.0)
        node = Node(sums, total, depth)
        if max_depth is None or depth < max_depth:
            best_split(node, edges, min_leaf, l2)
        return node

    nodes = [made(_histograms(data, model, pending, [(-1, -1, -1, -1, 0, 0.0, False)], [0])[0], 0)]
    while True:
        # replay: greatest gain first (ties to the older leaf), among splits whose children are known
        kept, unknown, leaves = set(), [], 1
        queue = [(-nodes[0].gain, 0)] if nodes[0].gain > 0 else []
        while queue and leaves < max_leaves:
            _, i = heapq.heappop(queue)
            leaves += 1
            if nodes[i].children is None:
                unknown.append(i)
            else:
                kept.add(i)
                for c in nodes[i].children:
                    if nodes[c].gain > 0:
                        heapq.heappush(queue, (-nodes[c].gain, c))
        if not unknown:
            break
        small = {}
        for i in unknown:
            node = nodes[i]
            node.children = (len(nodes), len(nodes) + 1)
            lost = node.sums[node.feature, len(edges[node.feature]) + 1, 1] if node.missing_left else 0.0
            left = node.sums[node.feature, :node.bin + 1, 1].sum() + lost
            small[i] = node.children[0 if left * 2 <= node.total[1] else 1]
            nodes += [Node(node.sums, (0.0, 0.0), node.depth + 1), Node(node.sums, (0.0, 0.0), node.depth + 1)]
        found = _histograms(data, model, pending, _listed(nodes), sorted(small.values()))
        for i in unknown:
            a, b = nodes[i].children
            other = b if small[i] == a else a
            nodes[small[i]] = made(found[small[i]], nodes[i].depth + 1)
            nodes[other] = made(nodes[i].sums - found[small[i]], nodes[i].depth + 1)
    return _finished(nodes, kept, learning_rate, l2)


def _finished(nodes: list[Node], kept: set[int], learning_rate: float, l2: float) -> list[tuple]:
    """The tree of the kept splits, numbered from its root, with the values of its leaves."""
    out: list[tuple] = []
    stack = [(0, -1, 0)]
    while stack:
        i, parent, side = stack.pop()
        node, at = nodes[i], len(out)
        g, n = node.total
        value = learning_rate * g / (n + l2) if n + l2 else 0.0
        split = i in kept
        out.append((-1, -1, node.feature if split else -1, node.bin if split else -1, float(n), 0.0 if split else float(value), node.missing_left))
        if parent >= 0:
            up = list(out[parent])
            up[side] = at
            out[parent] = tuple(up)
        if split:
            stack += [(node.children[1], at, 1), (node.children[0], at, 0)]
    return out

"""Regression forests of small training sets: whole trees in a task, a level of many trees at a time.

Spark ML grows a forest by one job a level, and its driver plans, sends and keeps every node.  That
suits rows that fill a cluster; for a few thousand rows and 36 forests of depth 30 the driver is
all that works.  Here the rows go to the tasks (``CELLS`` numbers at most) and each
task grows some trees by Spark ML's own rules: thresholds at most ``maxBins - 1`` a feature, the split of
the highest variance gain (of equal ones the first feature's first), no child under
``minInstancesPerNode`` rows, leaves without a gain, Poisson weights for the bootstrap.  Without the bootstrap the trees are
Spark's; the draws themselves come from (seed, number of the tree) and not from Spark's generator, so they don't
depend on how the rows are dealt out.

A tree of depth d is the top of the same tree grown deeper, and a forest's first trees are those of the
smaller forest of the same seed.  So settings that differ in ``maxDepth`` and ``numTrees`` only read
their predictions off the same trees.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowframe.operators.models import FEATURES

#: Most numbers (rows x columns) of a training set that is sent to tasks; most trees of a task.
CELLS = 1 << 20
TASK_TREES = 20
#: Most cells (nodes x features x bins) of a step.
STEP_CELLS = 1 << 19

NODES = "tree int, node int, left int, right int, feature int, threshold double, value double, rows double"


@dataclass(frozen=True)
class Growth:
    """What trees are grown by; forests of equal growth share their trees."""

    bins: int
    min_rows: int
    min_gain: float
    rate: float
    seed: int
    bootstrap: bool = True

    @classmethod
    def of(cls, est: RandomForestRegressor) -> Growth:
        return cls(est.getMaxBins(), est.getMinInstancesPerNode(), est.getMinInfoGain(), est.getSubsamplingRate(), est.getSeed(), est.getBootstrap())


def fits(est, rows: DataFrame, count: int) -> bool:
    """Whether ``est`` over the assembled ``rows`` is a forest that is grown here."""
    if type(est) is not RandomForestRegressor or (est.isDefined(est.weightCol) and est.getWeightCol()):
        return False
    attributes = rows.schema[FEATURES].metadata.get("ml_attr", {})
    return (est.getFeatureSubsetStrategy() == "all" and est.getMinWeightFractionPerNode() == 0 and (est.getBootstrap() or est.getSubsamplingRate() == 1)
            and not {"nominal", "binary"} & set(attributes.get("attrs", {})) and count * (attributes.get("num_attrs", CELLS) + 2) <= CELLS)


def packed(rows: DataFrame, id_cols: Sequence[str], label: str) -> DataFrame:
    """The assembled rows in the order of their ids, as one row of three arrays: y, x, fold."""
    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(list(id_cols), kind="stable")
        y = pdf["_y"].to_numpy(float)
        if np.isnan(y).any():
            raise ValueError("a forest takes no missing labels")
        x = np.array(pdf["_x"].tolist(), float)
        return pd.DataFrame({"y": [y.tobytes()], "x": [x.tobytes()], "fold": [pdf["_fold"].to_numpy(np.int64).tobytes()]})
    return (rows.select(*id_cols, F.col(label).cast("double").alias("_y"), vector_to_array(FEATURES).alias("_x"), "_fold")
            .groupBy().applyInPandas(pack, "y binary, x binary, fold binary"))


def thresholds(v: np.ndarray, bins: int) -> np.ndarray:
    """Spark ML's thresholds of a feature: between all distinct values, or else near equal counts.
    Missing values are one more value, above all."""
    values, counts = np.unique(v, return_counts=True)
    middles = (values[:-1] + values[1:]) / 2
    if np.isnan(middles[-1:]).any():
        middles[-1] = values[-2]
    most = min(bins, len(v)) - 1
    if len(middles) <= most:
        return middles
    stride = len(v) / (most + 1)
    found, seen, target = [], counts[0], stride
    for i, c in enumerate(counts[1:]):
        if abs(seen - target) < abs(seen + c - target):
            found.append(middles[i])
            target += stride
        seen += c
    return np.array(found)


def binned(x: np.ndarray, limits: list[np.ndarray]) -> np.ndarray:
    """The number of thresholds below each value; missing values are above all."""
    return np.column_stack([np.searchsorted(t, x[:, f], "left") for f, t in enumerate(limits)])


def _share(part: np.ndarray, of: np.ndarray) -> np.ndarray:
    return np.divide(part, of, out=np.zeros_like(part), where=of > 0)


def _impurity(n: np.ndarray, s: np.ndarray, q: np.ndarray) -> np.ndarray:
    return _share(q - _share(s * s, n), n)


def _best(at: np.ndarray, place: np.ndarray, weights: tuple, own: list[np.ndarray], splits: np.ndarray, wide: int, growth: Growth,
          roots: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The best split of each node: gain, feature, bin and (side, statistic, node) of its children; ``own``: the nodes' statistics."""
    active, features = len(own[0]), len(splits)
    key = ((at * features)[:, None] * wide + place + np.arange(features) * wide).ravel()
    total = [np.bincount(key, np.repeat(v, features), active * features * wide).reshape(active, features, wide).cumsum(axis=2) for v in weights]
    left = [v[:, :, :-1] for v in total]
    right = [v[:, :, -1:] - v[:, :, :-1] for v in total]
    if roots:  # as Spark has it: the two sides of the first split together
        f = int(np.argmax(splits > 0))
        own = [a[:, f, 0] + b[:, f, 0] for a, b in zip(left, right)]
    both = left[0] + right[0]
    gain = _impurity(*own)[:, None, None] - _share(left[0], both) * _impurity(*left) - _share(right[0], both) * _impurity(*right)
    able = (left[0] >= growth.min_rows) & (right[0] >= growth.min_rows) & (gain >= growth.min_gain) & (np.arange(wide - 1) < splits[:, None])
    gain = np.where(able, gain, -np.inf).reshape(active, -1)
    best, each = gain.argmax(axis=1), np.arange(active)
    sides = np.array([[v.reshape(active, -1)[each, best] for v in side] for side in (left, right)])
    return gain[each, best], *np.divmod(best, wide - 1), sides


def grow(x: np.ndarray, y: np.ndarray, growth: Growth, trees: range, depth: int, unseen: np.ndarray,
         depths: Sequence[int] = ()) -> tuple[dict[int, np.ndarray], list[np.ndarray]]:
    """The trees numbered ``trees`` over the rows (x, y): for each of ``depths`` the (trees, rows of ``unseen``)
    predictions of the trees cut there, and the nodes as columns (see ``NODES``)."""
    limits = [thresholds(v, growth.bins) for v in x.T]
    place, other = binned(x, limits), binned(unseen, limits)
    splits = np.array([len(t) for t in limits])
    wide, features, many = int(splits.max(initial=0)) + 1, x.shape[1], len(trees)
    if growth.bootstrap:
        w = np.array([np.random.default_rng([growth.seed % (1 << 64), t]).poisson(growth.rate, len(y)) for t in trees]).reshape(many, -1)
    else:
        w = np.ones((many, len(y)), np.int64)
    # rows in the bag by tree, then by row; the node of each, among those of this level that may be split
    at, row = np.nonzero(w)
    w = w[at, row].astype(float)
    wy = w * y[row]
    wyy = wy * y[row]
    n, s, q = (np.bincount(at, v, many) for v in (w, wy, wyy))
    tree, number, size = np.arange(many), np.zeros(many, np.int64), np.ones(many, np.int64)
    mean = _share(s, n)
    # where the unseen rows are (-1: in a leaf) and what that node predicts
    stand, value = np.repeat(np.arange(many)[:, None], len(unseen), axis=1), np.repeat(mean[:, None], len(unseen), axis=1)
    cut = {0: value.copy()} if 0 in depths else {}
    nodes = [[tree, number, mean, n]]
    split: list[list[np.ndarray]] = []
    level = 0
    while level < depth and len(tree) and wide > 1:
        active = len(tree)
        # rows by node, in their order; nodes in steps of bounded memory
        by = np.argsort(at, kind="stable")
        at, row, w, wy, wyy = at[by], row[by], w[by], wy[by], wyy[by]
        step = max(1, STEP_CELLS // (features * wide))
        found = [_best(at[a:b] - lo, place[row[a:b]], (w[a:b], wy[a:b], wyy[a:b]), [v[lo:lo + step] for v in (n, s, q)], splits, wide, growth, level == 0)
                 for lo in range(0, active, step) for a, b in [np.searchsorted(at, [lo, lo + step])]]
        gain, feature, bin_, sides = (np.concatenate(v, axis=-1) for v in zip(*found))
        goes = np.flatnonzero(gain > 0)
        if not len(goes):
            break
        # two children of each node that is split, the left one first
        n, s, q = (sides[:, k, goes].T.ravel() for k in range(3))
        child_tree = np.repeat(tree[goes], 2)
        first = np.searchsorted(child_tree, tree[goes])
        child = size[child_tree] + np.arange(len(child_tree)) - np.repeat(first, 2)
        split.append([tree[goes], number[goes], child[::2], child[1::2], feature[goes],
                      np.array([limits[f][b] for f, b in zip(feature[goes], bin_[goes])], float)])
        size = size + np.bincount(child_tree, minlength=many)
        mean = _share(s, n)
        nodes.append([child_tree, child, mean, n])
        level += 1
        # of the children, those that may be split go on
        on = np.abs(_impurity(n, s, q)) >= np.finfo(float).eps
        kept = np.where(on, np.cumsum(on) - 1, -1)
        into = np.full(active, -1)
        into[goes] = 2 * np.arange(len(goes))

        def down(where: np.ndarray, bins: np.ndarray) -> np.ndarray:
            """The child that rows in the nodes ``where`` go to, or -1."""
            return np.where(into[where] < 0, -1, into[where] + (bins > bin_[where]))

        to = down(at, place[row, feature[at]])
        stays = (to >= 0) & (kept[to] >= 0)
        at, row, w, wy, wyy = kept[to[stays]], row[stays], w[stays], wy[stays], wyy[stays]
        i, j = np.nonzero(stand >= 0)
        to = down(stand[i, j], other[j, feature[stand[i, j]]])
        moved = to >= 0
        value[i[moved], j[moved]] = mean[to[moved]]
        stand[i, j] = np.where(moved, kept[to] if len(kept) else -1, -1)
        tree, number, n, s, q = child_tree[on], child[on], n[on], s[on], q[on]
        if level in depths:
            cut[level] = value.copy()
    for d in depths:
        cut.setdefault(d, value)
    return cut, _columns(nodes, split, trees)


def _columns(nodes: list, split: list, trees: range) -> list[np.ndarray]:
    tree, node, mean, n = (np.concatenate(v) for v in zip(*nodes))
    order = np.lexsort((node, tree))
    tree, node, mean, n = tree[order], node[order], mean[order], n[order]
    left, right, feature, limit = (np.full(len(tree), v) for v in (-1, -1, -1, np.nan))
    if split:
        t, k, a, b, f, v = (np.concatenate(c) for c in zip(*split))
        here = np.searchsorted(tree, t) + k
        left[here], right[here], feature[here], limit[here] = a, b, f, v
    return [tree + trees.start, node, left, right, feature, limit, mean, n]


def _tasks(data: DataFrame, tasks: Sequence, run, schema: str) -> DataFrame:
    """``run`` of each of ``tasks`` and the packed rows, a Spark task each."""
    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                y, fold = np.frombuffer(r.y), np.frombuffer(r.fold, np.int64)
                yield run(tasks[r.task], np.frombuffer(r.x).reshape(len(y), -1), y, fold)
    numbers = data.sparkSession.range(0, len(tasks), 1, max(1, len(tasks))).withColumnRenamed("id", "task")
    return numbers.join(F.broadcast(data)).mapInPandas(each, schema)


def _parts(counts: Sequence[int]) -> list[range]:
    """The trees up to the largest count, cut at every count and after ``TASK_TREES`` at most."""
    ends = sorted({0, *counts, *range(0, max(counts), TASK_TREES)})
    return [range(a, b) for a, b in zip(ends, ends[1:])]


def fold_errors(data: DataFrame, estimators: Sequence[RandomForestRegressor], folds: int) -> DataFrame:
    """(setting, fold, rmse): each of ``estimators`` fitted to the packed rows of all other folds and scored on the fold."""
    shared: dict[Growth, list[int]] = {}
    for i, est in enumerate(estimators):
        shared.setdefault(Growth.of(est), []).append(i)
    tasks, reads = [], []
    for g, (growth, members) in enumerate(shared.items()):
        parts = _parts([estimators[i].getNumTrees() for i in members])
        depths = sorted({estimators[i].getMaxDepth() for i in members})
        tasks += [(g, growth, k, p, part, depths) for p, part in enumerate(parts) for k in range(folds)]
        reads += [(i, g, p, estimators[i].getMaxDepth(), estimators[i].getNumTrees()) for i in members
                  for p, part in enumerate(parts) if part.stop <= estimators[i].getNumTrees()]

    def run(task, x: np.ndarray, y: np.ndarray, fold: np.ndarray) -> pd.DataFrame:
        g, growth, k, p, part, depths = task
        test = fold == k
        cut, _ = grow(x[~test], y[~test], growth, part, depths[-1], x[test], depths)
        return pd.concat([pd.DataFrame({"grown": g, "part": p, "depth": d, "fold": k, "row": np.flatnonzero(test), "y": y[test], "total": cut[d].sum(axis=0)})
                          for d in depths])

    sums = _tasks(data, tasks, run, "grown int, part int, depth int, fold int, row long, y double, total double")
    settings = data.sparkSession.createDataFrame(reads, "setting int, grown int, part int, depth int, trees int")
    one = (sums.join(F.broadcast(settings), ["grown", "part", "depth"]).groupBy("setting", "fold", "row")
           .agg((F.first("y") - F.sum("total") / F.first("trees")).alias("e")))
    return one.groupBy("setting", "fold").agg(F.sqrt(F.avg(F.col("e") * F.col("e"))).alias("rmse"))


def fitted(data: DataFrame, est: RandomForestRegressor) -> DataFrame:
    """The forest of all packed rows as a table of its nodes (``NODES``; the root is 0, ``left`` of a leaf is -1)."""
    growth, depth = Growth.of(est), est.getMaxDepth()

    def run(part: range, x: np.ndarray, y: np.ndarray, fold: np.ndarray) -> pd.DataFrame:
        names = [c.split()[0] for c in NODES.split(", ")]
        return pd.DataFrame(dict(zip(names, grow(x, y, growth, part, depth, x[:0])[1])))

    return _tasks(data, _parts([est.getNumTrees()]), run, NODES)

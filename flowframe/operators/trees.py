"""Fitted tree ensembles as leaf tables, and their exact Shapley attribution.

A leaf adds its value to a row's prediction if every feature on its path is inside the
leaf's interval.  As a game over features, a leaf is a product: a feature that the coalition
holds counts 1 if the row is inside its interval and 0 otherwise; one that it does not hold counts the share of
training rows that the path keeps at the feature's splits (``background="cover"``, the
path-dependent attribution of the tree explainers), or whether the mean row is inside
(``background="means"``, the game of :func:`flowframe.operators.explain.exact_shap`).

The Shapley value of such a product is an integral: with o_i and z_i the two factors of path
feature i, ``phi_j = value * (o_j - z_j) * integral over t in [0, 1] of the product over i != j of
(z_i (1 - t) + o_i t)``, since the weight of a coalition of k of m - 1 features is the integral of
``t^k (1 - t)^(m - 1 - k)``.  The integrand is a polynomial of degree m - 1, so a Gauss-Legendre
rule with m // 2 + 1 nodes gives it without error: polynomial time, for any number of features.

The node table of a model is read from its saved form; its leaf table has the model's own size,
is broadcast like the model itself, and rows are attributed where they are, in Arrow batches.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from flowframe.sources.io import scratch_path

#: Cells of rows x leaves x path features that one attribution step holds.
STEP_CELLS = 1 << 21


@dataclass
class Paths:
    """Leaves with the same number of path features: an array row each."""

    feature: np.ndarray   # (leaves, m)
    low: np.ndarray       # the row's value must be > low
    high: np.ndarray      # and <= high
    share: np.ndarray     # training rows kept at the feature's splits
    missing: np.ndarray   # whether a missing value (NaN) of the row stays on the path
    value: np.ndarray     # (leaves,)

    def inside(self, x: np.ndarray) -> np.ndarray:
        """(rows, leaves, m): which values of ``x`` (rows, features) lie in the intervals."""
        v = x[:, self.feature]
        return (v > self.low) & (v <= self.high) | np.isnan(v) & self.missing


@dataclass
class LeafTable:
    """Leaves of all trees by path length, and the value of leaves without a path."""

    paths: list[Paths]
    constant: float

    def predict(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.constant)
        for p in self.paths:
            total += p.inside(x).all(axis=2) @ p.value
        return total

    def base(self, shares: list[np.ndarray]) -> float:
        """Value of the empty coalition."""
        return self.constant + sum(float((p.value * s.prod(axis=1)).sum()) for p, s in zip(self.paths, shares))

    def shares(self, background: np.ndarray | None) -> list[np.ndarray]:
        """What each path feature counts outside the coalition."""
        if background is None:
            return [p.share for p in self.paths]
        return [p.inside(background[None, :])[0].astype(float) for p in self.paths]

    def attribute(self, x: np.ndarray, shares: list[np.ndarray]) -> np.ndarray:
        """(rows, features) Shapley values of a block of rows."""
        phi = np.zeros(x.shape)
        for p, z in zip(self.paths, shares):
            leaves, m = p.feature.shape
            nodes, weights = np.polynomial.legendre.leggauss(m // 2 + 1)
            order = np.argsort(p.feature.ravel(), kind="stable")
            owner = p.feature.ravel()[order]
            first = np.flatnonzero(np.diff(owner, prepend=-1))
            step = max(1, STEP_CELLS // (leaves * m))
            for at in range(0, len(x), step):
                o = p.inside(x[at:at + step]).astype(float)
                mean = np.zeros(o.shape)
                for t, w in zip((nodes + 1) / 2, weights / 2):
                    mean += w * _products_without(z * (1 - t) + o * t)
                part = (mean * (o - z) * p.value[:, None]).reshape(len(o), -1)[:, order]
                phi[at:at + step, owner[first]] += np.add.reduceat(part, first, axis=1)
        return phi


def _products_without(f: np.ndarray) -> np.ndarray:
    """Along the last axis, the product of all other entries (zeros included)."""
    m = f.shape[-1]
    before, after = np.ones(f.shape), np.ones(f.shape)
    for i in range(1, m):
        before[..., i] = before[..., i - 1] * f[..., i - 1]
        after[..., m - 1 - i] = after[..., m - i] * f[..., m - i]
    return before * after


def leaf_table(trees: Sequence[dict[int, tuple]]) -> LeafTable:
    """Leaves of ``trees``: node id -> (left, right, feature, threshold, cover, value, and whether
    missing values go left: not, if left out), the root at 0."""
    found: dict[int, list] = {}
    constant = 0.0
    for nodes in trees:
        stack = [(0, {})]
        while stack:
            at, path = stack.pop()
            left, right, feature, threshold, cover, value, *missing_left = nodes[at]
            if left < 0:
                if path:
                    found.setdefault(len(path), []).append((path, value))
                else:
                    constant += value
                continue
            low, high, share, stays = path.get(feature, (-np.inf, np.inf, 1.0, 1.0))
            goes_left = any(missing_left)
            for child, limits, missing in ((left, (low, min(high, threshold)), goes_left), (right, (max(low, threshold), high), not goes_left)):
                kept = nodes[child][4] / cover if cover else 0.0
                stack.append((child, {**path, feature: (*limits, share * kept, stays * missing)}))
    paths = []
    for m, leaves in sorted(found.items()):
        feature = np.array([list(p) for p, _ in leaves], np.int64).reshape(-1, m)
        low, high, share, missing = (np.array([[q[i] for q in p.values()] for p, _ in leaves], float).reshape(-1, m) for i in range(4))
        paths.append(Paths(feature, low, high, share, missing > 0, np.array([v for _, v in leaves], float)))
    return LeafTable(paths, constant)


def model_leaves(model, output: int = 1) -> LeafTable:
    """The leaf table of a fitted Spark tree, forest or boosted model.

    Regression leaves add to the prediction, boosted classifiers' to the margin, and the
    leaves of classification trees and forests to the probability of class ``output``.
    """
    spark = SparkSession.getActiveSession()
    path = scratch_path(spark, "model")
    model.write().overwrite().save(path)
    data = spark.read.parquet(f"{path}/data")
    if "treeID" not in data.columns:
        data = data.select(F.lit(0).alias("treeID"), F.struct("*").alias("nodeData"))
    node = F.col("nodeData")
    rows = data.select("treeID", *[node[c].alias(c) for c in ("id", "leftChild", "rightChild", "prediction", "impurityStats")],
                       node["split"]["featureIndex"].alias("feature"), node["split"]["numCategories"].alias("categories"),
                       node["split"]["leftCategoriesOrThreshold"].alias("threshold"))
    kind = type(model).__name__
    forest = kind.startswith("RandomForest")
    weights = list(model.treeWeights) if hasattr(model, "treeWeights") else [1.0]
    trees: dict[int, dict[int, tuple]] = {}
    for r in rows.toLocalIterator():  # as many rows as the model has nodes
        if r["leftChild"] >= 0 and r["categories"] >= 0:
            raise ValueError("attribution takes trees over ordered features; use exact_shap or sampling_shap for categorical splits")
        stats = r["impurityStats"]
        classes = kind.startswith(("RandomForestClass", "DecisionTreeClass"))
        cover = sum(stats) if classes else stats[0]
        value = stats[output] / cover if classes and cover else r["prediction"]
        scale = 1.0 / len(weights) if forest else weights[r["treeID"]]
        threshold = r["threshold"][0] if r["leftChild"] >= 0 else 0.0
        trees.setdefault(r["treeID"], {})[r["id"]] = (r["leftChild"], r["rightChild"], r["feature"], threshold, cover, value * scale)
    return leaf_table([trees[k] for k in sorted(trees)])


def tree_shap(model, df: DataFrame, id_col, features: Sequence[str], background: str = "cover", output: int = 1) -> DataFrame:
    """K23 of tree models: one row per row and feature: (ids..., feature, value, phi, base).

    ``model`` is a fitted Spark tree model or a :class:`LeafTable`.  For every row the phi
    sum to its prediction less ``base``.  ``background``: ``cover`` (shares of training rows
    along the path) or ``means`` (the mean row of ``df``).
    """
    ids = [id_col] if isinstance(id_col, str) else list(id_col)
    names = list(features)
    table = model if isinstance(model, LeafTable) else model_leaves(model, output)
    means = None
    if background == "means":
        row = df.agg(*[F.avg(f).alias(f"m{i}") for i, f in enumerate(names)]).first()
        means = np.array([np.nan if v is None else float(v) for v in row])
    elif background != "cover":
        raise ValueError(background)
    shares = table.shares(means)
    base = table.base(shares)
    shared = df.sparkSession.sparkContext.broadcast((table, shares))
    wide = df.select(*[F.col(f"`{c}`") for c in ids], *[F.col(f"`{f}`").cast("double").alias(f"_x{i}") for i, f in enumerate(names)])
    schema = StructType([*wide.schema.fields[:len(ids)], *StructType.fromDDL("feature string, value double, phi double").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leaves, outside = shared.value
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            x = np.column_stack([batch.column(len(ids) + i).to_numpy(zero_copy_only=False).astype(float) for i in range(len(names))])
            phi = leaves.attribute(x, outside)
            again = pa.array(np.repeat(np.arange(n), len(names)))
            value = pa.array(x.ravel(), mask=np.isnan(x.ravel()))
            yield pa.RecordBatch.from_arrays([*[batch.column(i).take(again) for i in range(len(ids))], pa.array(names * n),
                                              value, pa.array(phi.ravel())], names=schema.names)

    return wide.mapInArrow(run, schema).withColumn("base", F.lit(base))

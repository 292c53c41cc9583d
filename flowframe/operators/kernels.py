"""RBF kernel machines over landmarks (K3, K7).

A bounded sample of rows is the landmarks; ``z(x) = K^-1/2 k(x)``, with the kernel between landmarks
K and of a row to them k, is a map whose products equal the kernel wherever rows are landmarks
(the Nystroem map; exact when every row is one).  On it the machine is linear:
``|w|^2 / 2 + C sum loss(w z + b)`` with the epsilon-insensitive loss (regression) or the hinge
(classification).

The losses are rounded off over a width that shrinks from step to step, and each step is Newton's:
one pass sums gradient and Hessian of all rows in each task and merges them on the
executors, one pass weighs a row of step lengths at once.  What reaches the driver has the
size of the map, whatever the rows.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from flowframe.operators.models import assemble
from flowframe.session import checkpoint

#: Landmarks, and the widths of the rounded losses in units of the loss's scale.
LANDMARKS = 200
WIDTHS = tuple(4 * 0.4 ** k for k in range(8))
#: Newton steps at a width, and the step lengths that one pass weighs.
STEPS = 30
LENGTHS = tuple(0.5 ** k for k in range(12))


@dataclass
class KernelMachine:
    """A fitted machine: scaling, landmarks, map and weights (the last one is the constant)."""

    features: list[str]
    mean: np.ndarray
    scale: np.ndarray
    gamma: float
    landmarks: np.ndarray
    root: np.ndarray
    weights: np.ndarray
    width: float = 0.0

    def mapped(self, x: np.ndarray) -> np.ndarray:
        """(rows, map + 1): the map of raw rows and a constant 1."""
        z = (x - self.mean) / self.scale
        gap = (z ** 2).sum(axis=1)[:, None] + (self.landmarks ** 2).sum(axis=1) - 2 * z @ self.landmarks.T
        return np.column_stack([np.exp(-self.gamma * np.maximum(gap, 0.0)) @ self.root, np.ones(len(x))])

    def transform(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        """``df`` with the machine's value of every row; NULL where a feature is missing."""
        shared = df.sparkSession.sparkContext.broadcast(self)
        n = len(self.features)
        wide = df.select(*_inputs(self.features), *[F.col(f"`{c}`") for c in df.columns])
        schema = StructType([*df.schema.fields, StructField(out, DoubleType())])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            machine = shared.value
            for batch in batches:
                x = _matrix(batch, n)
                value = machine.mapped(x) @ machine.weights
                yield pa.RecordBatch.from_arrays([*batch.columns[n:], pa.array(value, mask=np.isnan(value))], names=schema.names)

        return wide.mapInArrow(run, schema)


def _inputs(features: Sequence[str]) -> list:
    return [F.col(f"`{f}`").cast("double").alias(f"_x{i}") for i, f in enumerate(features)]


def _matrix(batch: pa.RecordBatch, n: int) -> np.ndarray:
    return np.column_stack([batch.column(i).to_numpy(zero_copy_only=False).astype(float) for i in range(n)])


def rounded(t: np.ndarray, width: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """max(t, 0) rounded off over ``width``, its slope and its curvature."""
    slope = np.clip(t / width, 0.0, 1.0)
    return np.where(t < width, 0.5 * t * slope, t - width / 2), slope, ((t > 0) & (t < width)) / width


def losses(kind: str, f: np.ndarray, y: np.ndarray, epsilon: float, width: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Loss of values ``f``, its slope and its curvature in ``f``."""
    if kind == "hinge":
        value, slope, curve = rounded(1 - y * f, width)
        return value, -y * slope, curve
    above, below = rounded(f - y - epsilon, width), rounded(y - f - epsilon, width)
    return above[0] + below[0], above[1] - below[1], above[2] + below[2]


def _summed(rows: DataFrame, n: int, part, size: int) -> np.ndarray:
    """The sum over all rows of ``part(x, y)``, an array of ``size`` numbers: summed in each
    task, then place by place on the executors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                some = batch.slice(at, 4096)
                total += part(_matrix(some, n), some.column(n).to_numpy())
        yield pa.RecordBatch.from_arrays([pa.array([total])], names=["total"])

    merged = rows.mapInArrow(run, "total array<double>").select(F.posexplode("total").alias("at", "v")).groupBy("at").agg(F.sum("v").alias("v")).toArrow()
    out = np.zeros(size)
    out[merged.column("at").to_numpy()] = merged.column("v").to_numpy()
    return out


def fit_kernel(df: DataFrame, features: Sequence[str], label: str, kind: str = "epsilon", C: float = 1.0, epsilon: float = 0.1,
               gamma: float | None = None, landmarks: int = LANDMARKS) -> KernelMachine:
    """K3: ``SVR(C, epsilon)`` (``kind="epsilon"``); K7: ``SVC(C)`` on labels 0 and 1 (``kind="hinge"``).

    Features are scaled to unit spread; ``gamma`` defaults to 1 / features then ('scale').
    Rows with a missing feature or label are left out; without rows the machine's value is 0.
    """
    names = list(features)
    n = len(names)
    y = F.col(f"`{label}`").cast("double")
    rows = df.select(*_inputs(names), (F.when(y > 0, 1.0).when(y <= 0, -1.0) if kind == "hinge" else y).alias("y"))
    whole = functools.reduce(lambda a, c: a & ~F.isnan(c), rows.columns, F.lit(True))
    rows = checkpoint(rows.dropna().where(whole))
    stats = rows.agg(*[x.alias(f"{k}{i}") for i in range(n) for k, x in (("m", F.avg(f"_x{i}")), ("s", F.stddev_pop(f"_x{i}")))], F.stddev_pop("y").alias("spread"), F.avg("y").alias("middle")).first()
    mean = np.array([stats[f"m{i}"] or 0.0 for i in range(n)])
    scale = np.array([stats[f"s{i}"] or 1.0 for i in range(n)])
    chosen = rows.select(*[f"_x{i}" for i in range(n)]).distinct().orderBy(F.xxhash64(*[f"_x{i}" for i in range(n)])).limit(landmarks).collect()
    marks = (np.array([list(r) for r in chosen], float).reshape(-1, n) - mean) / scale
    gamma = 1.0 / n if gamma is None else gamma
    gap = ((marks[:, None] - marks) ** 2).sum(axis=2)
    eigen, vectors = np.linalg.eigh(np.exp(-gamma * gap))
    held = eigen > (eigen.max() if len(eigen) else 0.0) * 1e-10
    machine = KernelMachine(names, mean, scale, gamma, marks, vectors[:, held] / np.sqrt(eigen[held]), np.zeros(int(held.sum()) + 1))
    size = len(machine.weights)
    if size == 1:
        return machine
    ridge = np.ones(size)
    ridge[-1] = 0.0  # the constant is free
    if kind != "hinge":
        machine.weights[-1] = stats["middle"]  # from where the first, wide losses curve at most rows
    unit = 1.0 if kind == "hinge" else max(float(stats["spread"] or 0.0), epsilon, 1e-12)
    upper = np.triu_indices(size)
    sc = df.sparkSession.sparkContext
    for width in (w * unit for w in WIDTHS):
        for _ in range(STEPS):
            machine.width = width
            shared = sc.broadcast(machine)

            def curves(x: np.ndarray, y: np.ndarray, shared=shared, width=width) -> np.ndarray:
                m = shared.value
                z = m.mapped(x)
                value, slope, curve = losses(kind, z @ m.weights, y, epsilon, width)
                return np.concatenate([[value.sum()], z.T @ slope, ((z.T * curve) @ z)[upper]])

            total = _summed(rows, n, curves, 1 + size + len(upper[0]))
            w = machine.weights
            gradient = ridge * w + C * total[1:1 + size]
            hessian = np.zeros((size, size))
            hessian[upper] = C * total[1 + size:]
            hessian = hessian + np.triu(hessian, 1).T + np.diag(ridge) + 1e-9 * np.eye(size)
            direction = -np.linalg.solve(hessian, gradient)
            now = 0.5 * (ridge * w * w).sum() + C * total[0]
            shared = sc.broadcast((machine, direction))

            def lengths(x: np.ndarray, y: np.ndarray, shared=shared, width=width) -> np.ndarray:
                m, step = shared.value
                z = m.mapped(x)
                f, along = z @ m.weights, z @ step
                return np.array([losses(kind, f + s * along, y, epsilon, width)[0].sum() for s in LENGTHS])

            ahead = _summed(rows, n, lengths, len(LENGTHS))
            after = [0.5 * (ridge * (w + s * direction) ** 2).sum() + C * v for s, v in zip(LENGTHS, ahead)]
            best = int(np.argmin(after))
            if after[best] >= now * (1 - 1e-9):
                if after[best] < now:
                    machine.weights = w + LENGTHS[best] * direction
                break
            machine.weights = w + LENGTHS[best] * direction
    return machine


def rbf_regression(train: DataFrame, test: DataFrame, features: Sequence[str], label: str, C: float = 1.0, epsilon: float = 0.1,
                   landmarks: int = LANDMARKS) -> DataFrame:
    """K3: ``test`` with the ``prediction`` of a machine fitted on ``train``."""
    return fit_kernel(train, features, label, "epsilon", C, epsilon, landmarks=landmarks).transform(test)


def rbf_classifier(train: DataFrame, test: DataFrame, features: Sequence[str], label: str, C: float = 1.0,
                   landmarks: int = LANDMARKS) -> DataFrame:
    """K7: ``SVC(kernel='rbf', probability=True)``: ``test`` with ``prediction`` (0 or 1) and ``prob_1``, the
    margin calibrated by a one-feature logistic fit on ``train`` (Platt scaling)."""
    machine = fit_kernel(train, features, label, "hinge", C, landmarks=landmarks)
    margins = machine.transform(train, "_m").where(F.col("_m").isNotNull() & F.col(label).isNotNull())
    scaled = LogisticRegression(labelCol=label, featuresCol="_mv").fit(assemble(margins.select(F.col(label).cast("double").alias(label), "_m"), ["_m"], "_mv"))
    out = scaled.transform(assemble(machine.transform(test, "_m"), ["_m"], "_mv"))
    return (out.withColumn("prob_1", F.when(F.col("_m").isNotNull(), vector_to_array("probability")[1]))
            .withColumn("prediction", F.when(F.col("_m").isNotNull(), (F.col("_m") >= 0).cast("double")))
            .drop("_mv", "_m", "rawPrediction", "probability"))

"""Iterative imputation from sufficient statistics.

While imputing, a row's missing cells are an affine function of its observed ones: they start
at the column means, and every regression puts an affine function of the other columns in
their place.  The function is the same for all rows with the same cells missing.  So one pass
over the rows gathers, for each missingness pattern, the cross products of its observed
columns; every regression of every round is solved from those matrices; and one pass a
round measures the largest change of a cell, whatever the number of columns.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from flowframe.session import checkpoint

#: Bytes of cross products that the driver holds; tables with more patterns go column by column.
PATTERN_BYTES = 256 << 20


@dataclass
class Pattern:
    """Rows with the same observed columns."""

    seen: np.ndarray     # (columns,) which are observed
    moments: np.ndarray  # (1 + columns, 1 + columns) cross products of 1 and the scaled columns, missing ones 0
    affine: np.ndarray   # (1 + columns, 1 + columns) full row from (1, observed columns)


def _codes(seen: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """The distinct patterns of rows of flags, and each row's number among them."""
    packed = np.packbits(seen, axis=1)
    found, own = np.unique(packed, axis=0, return_inverse=True)
    return [r.tobytes() for r in found], own.ravel()


def _flags(code: bytes, d: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(code, np.uint8))[:d].astype(bool)


def _matrix(batch: pa.RecordBatch, d: int, first: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Values (missing ones 0) and observed flags of the ``d`` columns from ``first`` on."""
    columns = [batch.column(first + i) for i in range(d)]
    seen = np.column_stack([c.is_valid().to_numpy(zero_copy_only=False) for c in columns])
    return np.column_stack([c.fill_null(0.0).to_numpy(zero_copy_only=False) for c in columns]), seen


def _patterns(wide: DataFrame, mean: np.ndarray, scale: np.ndarray) -> DataFrame:
    """(pattern, moments) of all rows: summed in each task, then by pattern."""
    d = len(mean)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[bytes, np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            x, seen = _matrix(batch, d)
            z = np.column_stack([np.ones(len(x)), np.where(seen, (x - mean) / scale, 0.0)])
            codes, own = _codes(seen)
            for k, code in enumerate(codes):
                part = z[own == k]
                total[code] = total.get(code, 0.0) + part.T @ part
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.binary()), pa.array([m.tobytes() for m in total.values()], pa.binary())],
                                         names=["pattern", "moments"])

    def final(group: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(m.as_py()) for m in group.column("moments"))
        return pa.table({"pattern": group.column("pattern").slice(0, 1), "moments": pa.array([total.tobytes()], pa.binary())})

    return wide.mapInArrow(partial, "pattern binary, moments binary").groupBy("pattern").applyInArrow(final, "pattern binary, moments binary")


def least_squares(gram: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Coefficients of the normal equations; the shortest solution if columns depend on each other."""
    return np.linalg.lstsq(gram, target, rcond=1e-12)[0]


def bayesian_ridge(gram: np.ndarray, target: np.ndarray, yy: float, rounds: int = 300, tol: float = 1e-3) -> np.ndarray:
    """Ridge whose noise and weight precisions are re-estimated (MacKay's updates, Gamma priors of
    1e-6), from the cross products of (1, x): the first row and column are the constant's."""
    n = gram[0, 0]
    middle, y_mean = gram[0, 1:] / n, target[0] / n
    xx, xy = gram[1:, 1:] - n * np.outer(middle, middle), target[1:] - n * middle * y_mean
    yy = yy - n * y_mean ** 2
    eigen, vectors = np.linalg.eigh(xx)
    eigen, along = np.maximum(eigen, 0.0), vectors.T @ xy
    prior, noise, weight = 1e-6, 1.0 / (yy / n + np.finfo(float).eps), 1.0

    def solve() -> np.ndarray:
        return vectors @ (along / (eigen + weight / noise))

    old = None
    for _ in range(rounds):
        coef = solve()
        error = yy - 2 * coef @ xy + coef @ xx @ coef
        used = (noise * eigen / (weight + noise * eigen)).sum()
        weight = (used + 2 * prior) / (coef @ coef + 2 * prior)
        noise = (n - used + 2 * prior) / (max(error, 0.0) + 2 * prior)
        if old is not None and np.abs(old - coef).sum() < tol:
            break
        old = coef
    coef = solve()
    return np.concatenate([[y_mean - coef @ middle], coef])


def _round(patterns: list[Pattern], order: Sequence[int], bayesian: bool) -> None:
    """Regress each incomplete column on all others and put the result into the patterns."""
    d = len(patterns[0].seen)
    for c in order:
        others = np.array([0, *[1 + j for j in range(d) if j != c]])
        total = sum(p.affine @ p.moments @ p.affine.T for p in patterns if p.seen[c])
        gram, target = total[np.ix_(others, others)], total[others, 1 + c]
        w = bayesian_ridge(gram, target, total[1 + c, 1 + c]) if bayesian else least_squares(gram, target)
        for p in patterns:
            if not p.seen[c]:
                p.affine[1 + c] = w @ p.affine[others]


def _filled(x: np.ndarray, seen: np.ndarray, maps: dict[bytes, np.ndarray], mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Rows with their missing cells in place."""
    z = np.column_stack([np.ones(len(x)), np.where(seen, (x - mean) / scale, 0.0)])
    out = x.copy()
    codes, own = _codes(seen)
    for k, code in enumerate(codes):
        at = np.flatnonzero(own == k)
        lost = np.flatnonzero(~_flags(code, x.shape[1]))
        if len(lost):
            out[np.ix_(at, lost)] = z[at] @ maps[code][1 + lost].T * scale[lost] + mean[lost]
    return out


def iterative_impute(df: DataFrame, id_col: str, cols: Sequence[str], max_iter: int = 10, tol: float = 1e-3,
                     bayesian: bool = False) -> DataFrame:
    """``IterativeImputer``: start from column means, then in ascending order of missing
    count regress each incomplete column on all the others (rows where it is observed) and
    predict its missing cells; repeat up to ``max_iter`` rounds until the largest change is
    below ``tol`` times the largest absolute value.  Least squares, or with ``bayesian`` the
    library's default, Bayesian ridge (on columns scaled to unit spread).

    A column without any value stays as it is and predicts nothing.  Stopping at ``max_iter``
    without convergence warns, as the library does.
    """
    row = df.agg(*[x.alias(f"{n}{i}") for i, c in enumerate(cols) for n, x in (
        ("n", F.count(c)), ("m", F.avg(c)), ("s", F.stddev_pop(c)), ("b", F.max(F.abs(c))))], F.count(F.lit(1)).alias("rows")).first()
    at = [i for i in range(len(cols)) if row[f"n{i}"]]
    names = [cols[i] for i in at]
    lost = [row["rows"] - row[f"n{i}"] for i in at]
    order = sorted((k for k in range(len(names)) if lost[k]), key=lambda k: (lost[k], names[k]))
    if not order:
        return df
    mean = np.array([float(row[f"m{i}"]) for i in at])
    scale = np.array([float(row[f"s{i}"]) or 1.0 for i in at])
    largest = max(float(row[f"b{i}"]) for i in at)
    d = len(names)
    wide = df.select(*[F.col(f"`{c}`").cast("double").alias(f"_x{k}") for k, c in enumerate(names)], *[F.col(f"`{c}`") for c in df.columns])
    wide = checkpoint(wide)
    values = wide.select(*[f"_x{k}" for k in range(d)])
    table = checkpoint(_patterns(values, mean, scale))
    if table.count() * (1 + d) ** 2 * 8 > PATTERN_BYTES:
        return by_columns(df, id_col, names, max_iter, tol, bayesian)
    patterns, codes = [], []
    for r in table.collect():
        codes.append(bytes(r["pattern"]))
        seen = _flags(codes[-1], d)
        start = np.diag(np.concatenate([[1.0], seen.astype(float)]))
        patterns.append(Pattern(seen, np.frombuffer(bytes(r["moments"])).reshape(1 + d, 1 + d).copy(), start))
    spark = df.sparkSession
    before = {c: p.affine.copy() for c, p in zip(codes, patterns)}
    for _ in range(max_iter):
        _round(patterns, order, bayesian)
        now = {c: p.affine.copy() for c, p in zip(codes, patterns)}
        shared = spark.sparkContext.broadcast((before, now))

        def changed(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            old, new = shared.value
            for batch in batches:
                if batch.num_rows:
                    x, seen = _matrix(batch, d)
                    gap = np.abs(_filled(x, seen, new, mean, scale) - _filled(x, seen, old, mean, scale)).max()
                    yield pa.RecordBatch.from_arrays([pa.array([gap])], names=["gap"])

        change = values.mapInArrow(changed, "gap double").agg(F.max("gap")).first()[0]
        before = now
        if (change or 0.0) < tol * largest:
            break
    else:
        warnings.warn(f"iterative_impute: no convergence after {max_iter} rounds", RuntimeWarning, stacklevel=2)
    shared = spark.sparkContext.broadcast(before)
    todo = {names[k] for k in order}
    schema = StructType([StructField(f.name, DoubleType()) if f.name in todo else f for f in df.schema.fields])

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, seen = _matrix(batch, d)
                whole = _filled(x, seen, shared.value, mean, scale)
                yield pa.RecordBatch.from_arrays([pa.array(whole[:, names.index(f.name)]) if f.name in todo else batch.column(d + i)
                                                  for i, f in enumerate(schema.fields)], names=schema.names)

    return wide.mapInArrow(fill, schema)


def by_columns(df: DataFrame, id_col: str, cols: Sequence[str], max_iter: int = 10, tol: float = 1e-3, bayesian: bool = False) -> DataFrame:
    """The same column by column: one pass for the cross products of each regression and one
    write a round, for tables with more patterns than the driver should hold."""
    cols = list(cols)
    row = df.agg(*[x.alias(f"{n}{i}") for i, c in enumerate(cols) for n, x in (
        ("n", F.sum(F.col(c).isNull().cast("long"))), ("m", F.avg(c)), ("s", F.stddev_pop(c)), ("b", F.max(F.abs(c))))]).first()
    mean, scale = ({c: float(row[f"{n}{i}"] or 0.0) for i, c in enumerate(cols)} for n in "ms")
    scale = {c: v or 1.0 for c, v in scale.items()}
    todo = sorted([c for i, c in enumerate(cols) if row[f"n{i}"]], key=lambda c: (row[f"n{cols.index(c)}"], c))
    if not todo:
        return df
    d = df.withColumns({f"_obs_{c}": F.col(c).isNotNull() for c in todo})
    d = checkpoint(d.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(mean[c])) for c in todo}))
    largest = max(abs(row[f"b{i}"] or 0.0) for i in range(len(cols))) or 1.0
    scaled = {c: (F.col(c) - F.lit(mean[c])) / F.lit(scale[c]) for c in cols}
    for _ in range(max_iter):
        prev = d
        for c in todo:
            terms = [F.lit(1.0), *[scaled[o] for o in cols if o != c], scaled[c]]
            pairs = [(i, j) for i in range(len(terms)) for j in range(i, len(terms))]
            sums = d.where(F.col(f"_obs_{c}")).agg(*[F.sum(terms[i] * terms[j]).alias(f"p{k}") for k, (i, j) in enumerate(pairs)]).first()
            total = np.zeros((len(terms), len(terms)))
            for k, (i, j) in enumerate(pairs):
                total[i, j] = total[j, i] = sums[k]
            gram, target = total[:-1, :-1], total[:-1, -1]
            w = bayesian_ridge(gram, target, total[-1, -1]) if bayesian else least_squares(gram, target)
            value = F.lit(float(w[0]))
            for t, v in zip(terms[1:-1], w[1:]):
                value = value + F.lit(float(v)) * t
            d = d.withColumn(c, F.when(F.col(f"_obs_{c}"), F.col(c)).otherwise(value * F.lit(scale[c]) + F.lit(mean[c])))
        d = checkpoint(d)
        j = prev.select(id_col, *[F.col(c).alias(f"_p_{c}") for c in todo]).join(d.select(id_col, *todo), id_col)
        change = j.agg(F.greatest(F.lit(0.0), *[F.max(F.abs(F.col(c) - F.col(f"_p_{c}"))) for c in todo])).first()[0]
        if (change or 0.0) < tol * largest:
            break
    else:
        warnings.warn(f"iterative_impute: no convergence after {max_iter} rounds", RuntimeWarning, stacklevel=2)
    return d.drop(*[f"_obs_{c}" for c in todo])

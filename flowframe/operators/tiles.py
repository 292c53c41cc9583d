"""Pairs of tiles: all-pairs distances in bounded memory.

Rows are packed into tiles, one Spark row each; tiles meet in pairs by a join on the pair, so a
task holds a few tiles at a time and a table of n rows makes (n / tile)^2 pairs, dealt over many
tasks.  Inside a pair, squared distances are a matrix product, ``|x|^2 + |y|^2 - 2 x.y`` about a
common centre, with a known bound on its rounding; where that bound matters the caller
takes the differences themselves (:func:`exact_squares`).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Most rows and most numbers of a tile; fewest rows that small tables are cut down to, for the sake of parallel tasks.
TILE_ROWS = 16384
TILE_CELLS = 1 << 21
LEAST_ROWS = 1024
#: Cells of a slice of distances, and most tasks for the pairs.
SLICE_CELLS = 1 << 20
PAIR_TASKS = 2000


def rows_per_tile(rows: int, width: int, most: int = TILE_ROWS) -> int:
    """Rows of a tile: at least 8 tiles where the table allows it, at most ``TILE_CELLS`` numbers."""
    return max(1, min(most, max(LEAST_ROWS, -(-rows // 8)), TILE_CELLS // max(1, width)))


def tiles_of(rows: int, per_tile: int) -> int:
    return max(1, -(-rows // per_tile))


def tile_pairs(left: DataFrame, right: DataFrame, l_tiles: int, r_tiles: int, half: bool = False) -> DataFrame:
    """Every row of ``left`` (one per ``l`` from 0 to ``l_tiles`` - 1) beside every row of ``right`` (one per ``r``);
    ``half``: only l <= r, for two copies of the same tiles."""
    def upto(n):
        return F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))
    to_r = F.sequence(F.col("l"), F.lit(r_tiles - 1).cast("long")) if half else upto(r_tiles)
    to_l = F.sequence(F.lit(0).cast("long"), F.col("r")) if half else upto(l_tiles)
    tasks = min(l_tiles * r_tiles, PAIR_TASKS)
    return (left.withColumn("r", F.explode(to_r)).repartition(tasks, "l", "r")
            .join(right.withColumn("l", F.explode(to_l)).repartition(tasks, "l", "r"), ["l", "r"]))


def matrix(values: pd.Series, dtype: str = "float64") -> np.ndarray:
    return np.array(values.tolist(), dtype=dtype).reshape(len(values), -1)


def centre(y: np.ndarray) -> np.ndarray:
    """The mean of the finite rows: near it, products lose the least."""
    fine = y[np.isfinite(y).all(axis=1)]
    return fine.mean(axis=0) if len(fine) else np.zeros(y.shape[1])


def augmented(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``left``, ``right`` with ``left @ right.T`` the squared distances, and the squared norms about the
    centre.  A product is off by at most ``rounding(dims)`` times the sum of its two norms."""
    mid = centre(y)
    x, y = x - mid, y - mid
    p, q = (x * x).sum(axis=1), (y * y).sum(axis=1)
    return np.column_stack([-2 * x, p, np.ones(len(x))]), np.column_stack([y, np.ones(len(y)), q]), p, q


def rounding(dims: int) -> float:
    return 4 * (dims + 8) * np.finfo(float).eps


def exact_squares(x: np.ndarray, y: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """|x_i - y_j|^2 of a list of pairs."""
    found = np.empty(len(i))
    step = max(1, SLICE_CELLS // max(1, x.shape[1]))
    for at in range(0, len(i), step):
        gap = x[i[at:at + step]] - y[j[at:at + step]]
        found[at:at + step] = (gap * gap).sum(axis=1)
    return found

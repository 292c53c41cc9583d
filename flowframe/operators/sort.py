"""Sort, limit, top-k (inventory H1-H3)."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowframe.operators import order as O


def sort_keys(by: Sequence[str], ascending: bool | Sequence[bool] = True) -> list[Column]:
    """Missing values last in both directions."""
    asc = [ascending] * len(by) if isinstance(ascending, bool) else list(ascending)
    return [F.col(c).asc_nulls_last() if a else F.col(c).desc_nulls_last() for c, a in zip(by, asc)]


def sort_values(df: DataFrame, by: Sequence[str], ascending: bool | Sequence[bool] = True,
                rank_col: str | None = None) -> DataFrame:
    """H1: ``sort_values(by, ascending)``.  A result that leaves Spark as a set
    carries the sort as ``rank_col`` (0-based, from the scalable row index)."""
    if rank_col:
        asc = [ascending] * len(by) if isinstance(ascending, bool) else list(ascending)
        spec = [(c, "asc" if a else "desc") for c, a in zip(by, asc)]
        return O.positions(df, [], spec, rank_col)
    return df.orderBy(*sort_keys(by, ascending))


def nlargest(df: DataFrame, n: int, col: str, order: Sequence[str] = ()) -> DataFrame:
    """H2: ``nlargest(n, col)``: missing excluded, ties by the original order.
    Spark plans a per-task top-n followed by a merge (TakeOrderedAndProject)."""
    return (df.where(F.col(col).isNotNull())
              .orderBy(F.col(col).desc(), *[F.col(o).asc() for o in order]).limit(n))


def head(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """H3: ``head(n)`` in an explicit order."""
    return df.orderBy(*[F.col(o).asc_nulls_last() for o in order]).limit(n)

"""Query registry: ``name -> (spark builder, oracle SQL or None)``.

Names follow ``<inventory id>_<short name>`` (e.g. ``g08_rolling_7d``).  A query
builder takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the driver's
tables.  ``sql`` is the equivalent DuckDB query over the same tables; it is None
for rows whose check is a property test (fitted models, seeded shuffles).
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    build: Builder
    sql: str | None
    check: str  # E exact, T rounded, R rows only + property test


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None, check: str = "E"):
    def deco(fn: Builder) -> Builder:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql, check if sql else "R")
        return fn
    return deco


def rnd(c, digits: int):
    """Round like the oracle: ``round(x * 10^d) / 10^d`` on the double value, so a
    product landing on .5 rounds the same way on both sides."""
    from pyspark.sql import functions as F
    col = F.col(c) if isinstance(c, str) else c
    k = float(10 ** digits)
    return F.round(col * F.lit(k)) / F.lit(k)

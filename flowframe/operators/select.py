"""Projection, selection and predicates (inventory C1-C14).

Label/position access (``loc``/``iloc``) needs a row order; it goes through
:func:`flowframe.operators.order.positions`, never a global single-task window.
"""

from __future__ import annotations

import re
from typing import Any, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BooleanType, DateType, MapType, NumericType, StringType, StructType,
                               TimestampNTZType, TimestampType)

from flowframe.operators import order as O


def project(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``df[[cols]]``."""
    return df.select(*[F.col(f"`{c}`") for c in cols])


def drop(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``drop(columns=)``."""
    return df.drop(*cols)


def filter_columns(df: DataFrame, regex: str) -> DataFrame:
    """``filter(regex=)``: columns whose name *contains* a match."""
    rx = re.compile(regex)
    return df.select(*[F.col(f"`{c}`") for c in df.columns if rx.search(c)])


#: Kinds of columns by the type names of pandas.
DTYPES = {
    "number": lambda t: isinstance(t, NumericType),
    "bool": lambda t: isinstance(t, BooleanType),
    "object": lambda t: isinstance(t, (StringType, ArrayType, MapType, StructType)),
    "datetime": lambda t: isinstance(t, (DateType, TimestampType, TimestampNTZType)),
}


def select_dtypes(df: DataFrame, include: str | Sequence[str] | None = None, exclude: str | Sequence[str] = ()) -> DataFrame:
    """``select_dtypes(include=, exclude=)`` by ``number`` (the default, without
    booleans), ``bool``, ``object`` (text and nested values) and ``datetime``."""
    names = lambda x: [x] if isinstance(x, str) else list(x)
    inside = names(include) if include is not None else ([] if exclude else ["number"])
    outside = names(exclude)
    unknown = set(inside + outside) - set(DTYPES)
    if unknown:
        raise ValueError(f"unknown kinds of columns: {sorted(unknown)}")

    def kept(t) -> bool:
        return (not inside or any(DTYPES[k](t) for k in inside)) and not any(DTYPES[k](t) for k in outside)

    return df.select(*[F.col(f"`{f.name}`") for f in df.schema.fields if kept(f.dataType)])


def _narrow(df: DataFrame, order, keys, cols: Sequence[str] | None) -> DataFrame:
    """Only the columns that are asked for or that place a row, before rows are moved."""
    by = [o[0] if isinstance(o, tuple) else o for o in O.as_list(order)]
    if not cols or not all(isinstance(c, str) for c in [*by, *O.as_list(keys)]):
        return df
    return df.select(*dict.fromkeys([*cols, *by, *O.as_list(keys)]))


def loc_range(df: DataFrame, order, start: int, stop: int, keys=None,
              cols: Sequence[str] | None = None) -> DataFrame:
    """C4: ``loc[start:stop, cols]`` over the default 0..n-1 labels: the end is
    included."""
    d = O.positions(_narrow(df, order, keys, cols), keys, order, "_pos").where(F.col("_pos").between(start, stop))
    return d.select(*(cols or df.columns))


def iloc_range(df: DataFrame, order, start: int | None, stop: int | None, keys=None,
               cols: Sequence[str] | None = None) -> DataFrame:
    """``iloc[start:stop, cols]`` with the end excluded; negative bounds count
    from the series end (``iloc[-30:]``)."""
    keys = O.as_list(keys)
    d = O.positions(_narrow(df, order, keys, cols), keys, order, "_pos")
    if (start is not None and start < 0) or (stop is not None and stop < 0):
        n = d.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")) if keys else None
        if keys:
            d = O.join_on_keys(d, n, keys)
            nn = F.col("_n")
        else:
            nn = d.agg(F.count(F.lit(1))).scalar()
        lo = F.lit(0) if start is None else (nn + start if start < 0 else F.lit(start))
        hi = nn if stop is None else (nn + stop if stop < 0 else F.lit(stop))
    else:
        lo = F.lit(start or 0)
        hi = F.lit(stop) if stop is not None else None
    cond = F.col("_pos") >= lo
    if hi is not None:
        cond = cond & (F.col("_pos") < hi)
    return d.where(cond).select(*(cols or df.columns))


def at(df: DataFrame, key_col: str, key_value: Any, col: str) -> DataFrame:
    """``df.at[key, col]`` as a point filter returning one column."""
    return df.where(F.col(key_col) == F.lit(key_value)).select(col)


def where_rows(df: DataFrame, cond: Column | str) -> DataFrame:
    """Boolean filter or SQL predicate string (``df.query``)."""
    return df.filter(cond)


def isin(df: DataFrame, col: str, values) -> DataFrame:
    """``s.isin(values)``: a literal list, or a DataFrame of values (semi join,
    so a large list never passes through the driver)."""
    if isinstance(values, DataFrame):
        v = values.select(F.col(values.columns[0]).alias("_v")).distinct()
        return df.join(v, F.col(col) == F.col("_v"), "left_semi")
    return df.where(F.col(col).isin(list(values)))


def contains_rows(df: DataFrame, col: str, pattern: str, regex: bool = True,
                  case: bool = True) -> DataFrame:
    """``df[s.str.contains(p)]``; missing text is dropped."""
    from flowframe.functions.text import contains
    return df.where(contains(F.col(col), pattern, regex=regex, case=case))


def where_values(df: DataFrame, cond: Column, cols: Sequence[str], other=None,
                 mask: bool = False) -> DataFrame:
    """C11: ``df.where(cond, other)`` (keep where true) or ``mask`` (replace where
    true); a NULL condition counts as false."""
    c = F.coalesce(cond, F.lit(False))
    keep = ~c if mask else c
    val = other if isinstance(other, Column) else F.lit(other)
    return df.withColumns({x: F.when(keep, F.col(x)).otherwise(val) for x in cols})


def assign(df: DataFrame, **exprs) -> DataFrame:
    """``assign(new=...)`` / ``eval('c = a + b')``: Column or SQL string."""
    return df.withColumns({k: (F.expr(v) if isinstance(v, str) else v) for k, v in exprs.items()})


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """``rename(columns={})``."""
    return df.withColumnsRenamed(mapping)


def case_rule(branches: Sequence[tuple[Column, Any]], default: Any = None) -> Column:
    """C14: a row-wise business rule as one CASE expression (no UDF)."""
    out = None
    for cond, val in branches:
        v = val if isinstance(val, Column) else F.lit(val)
        out = F.when(cond, v) if out is None else out.when(cond, v)
    d = default if isinstance(default, Column) else F.lit(default)
    return out.otherwise(d)

"""Aggregation and reshaping (inventory F1-F10) and group user functions.

Aggregations are single ``groupBy().agg()`` calls: Spark aggregates partially on
the map side, so a hot group is reduced before the shuffle.  Group keys with
NULL are dropped first, as pandas ``groupby(dropna=True)`` does (S2).
"""

from __future__ import annotations

import pickle
from typing import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from flowframe.operators.order import as_list, join_on_keys

AGG = {
    "mean": F.avg, "sum": F.sum, "min": F.min, "max": F.max, "count": F.count,
    "std": F.stddev_samp, "var": F.var_samp, "nunique": F.count_distinct,
    "first": lambda c: F.first(c, ignorenulls=True),
}


def _keyed(df: DataFrame, keys, dropna: bool) -> DataFrame:
    keys = as_list(keys)
    return df.dropna(subset=keys) if (dropna and keys) else df


def agg(df: DataFrame, keys, spec: dict[str, str | Sequence[str]], dropna: bool = True) -> DataFrame:
    """``groupby(k).agg({'v': ['mean', 'std'], 'w': 'sum'})`` with flat
    output names ``v_mean``, ``v_std``, ``w_sum``."""
    keys = as_list(keys)
    exprs = []
    for c, fs in spec.items():
        for f in ([fs] if isinstance(fs, str) else fs):
            exprs.append(AGG[f](c).alias(f"{c}_{f}"))
    return _keyed(df, keys, dropna).groupBy(*keys).agg(*exprs)


def named_agg(df: DataFrame, keys, dropna: bool = True, **named: tuple[str, str]) -> DataFrame:
    """``agg(avg_val=('value', 'mean'), ...)``."""
    keys = as_list(keys)
    return _keyed(df, keys, dropna).groupBy(*keys).agg(
        *[AGG[f](c).alias(n) for n, (c, f) in named.items()])


def filter_groups(df: DataFrame, keys, predicate: Callable[[], Column] | Column | None = None,
                  min_rows: int | None = None) -> DataFrame:
    """``groupby(k).filter(lambda g: ...)``: keep every row of the groups
    whose aggregate predicate holds (e.g. ``F.count('*') >= 30``).  A grouped
    aggregate plus a semi join: no group is ever gathered in one place."""
    keys = as_list(keys)
    if min_rows is not None:
        predicate = F.count(F.lit(1)) >= F.lit(min_rows)
    cond = predicate() if callable(predicate) else predicate
    ok = _keyed(df, keys, True).groupBy(*keys).agg(cond.alias("_ok")).where("_ok").drop("_ok")
    return df.join(ok, keys, "left_semi")


def pivot_table(df: DataFrame, index, columns: str, values: str, aggfunc: str = "mean",
                levels: Sequence | None = None, fill_value=None) -> DataFrame:
    """``pivot_table(index, columns, values, aggfunc)``.  Pass ``levels`` to
    skip the extra job that discovers the pivot values.  Columns that are
    entirely missing are dropped, as pandas does."""
    index = as_list(index)
    src = df.dropna(subset=[*index, columns]).where(F.col(values).isNotNull())
    g = src.groupBy(*index)
    p = (g.pivot(columns, list(levels)) if levels is not None else g.pivot(columns)).agg(AGG[aggfunc](values))
    # pandas drops value columns that are missing everywhere: given levels without any row
    # (an aggregate by pivot value; levels found in the data have rows by construction)
    if levels is not None:
        present = {r[0] for r in src.where(F.col(columns).isin(list(levels))).select(columns).distinct().collect()}
        p = p.drop(*[str(v) for v in levels if v not in present])
    if fill_value is not None:
        p = p.na.fill(fill_value)
    return p


def crosstab(df: DataFrame, a: str, b: str, levels: Sequence | None = None) -> DataFrame:
    """``pd.crosstab(a, b)``: counts with empty cells 0."""
    src = df.dropna(subset=[a, b])
    g = src.groupBy(a)
    p = (g.pivot(b, list(levels)) if levels is not None else g.pivot(b)).count()
    return p.na.fill(0)


def melt(df: DataFrame, id_vars: Sequence[str], value_vars: Sequence[str],
         var_name: str = "variable", value_name: str = "value") -> DataFrame:
    """F8: ``melt``: wide to long, missing values kept."""
    return df.unpivot(list(id_vars), list(value_vars), var_name, value_name)


def stack(df: DataFrame, id_vars: Sequence[str], value_vars: Sequence[str],
          var_name: str = "variable", value_name: str = "value") -> DataFrame:
    """``stack()``: like melt but missing cells dropped."""
    return melt(df, id_vars, value_vars, var_name, value_name).where(F.col(value_name).isNotNull())


def unstack(df: DataFrame, index, var_col: str, value_col: str, levels: Sequence | None = None) -> DataFrame:
    """``unstack()``: long to wide with one value per cell."""
    index = as_list(index)
    g = df.groupBy(*index)
    return (g.pivot(var_col, list(levels)) if levels is not None else g.pivot(var_col)).agg(F.first(value_col))


def explode_list(df: DataFrame, col: str, name: str | None = None) -> DataFrame:
    """``explode``: one row per element; empty or NULL lists keep one NULL row."""
    return df.withColumn(name or col, F.explode_outer(col))


def group_apply(df: DataFrame, keys, fn, schema: str) -> DataFrame:
    """An opaque pandas function per group (``groupby.transform/filter``
    with a lambda) through ``applyInPandas``, for functions that have no native form.

    ``applyInPandas`` hands each whole group to one task; window and aggregate forms
    (G1, G2, F4) and functions in parts (:func:`group_fold`) have no such limit."""
    return df.groupBy(*as_list(keys)).applyInPandas(fn, schema)


#: Groups whose states a task holds before it hands them on.
HELD_GROUPS = 1 << 16
#: A group with more than this share (1 / HOT_SHARE) of all rows is folded where its rows lie.
HOT_SHARE = 64


def group_fold(df: DataFrame, keys, init: Callable, update: Callable, merge: Callable, finish: Callable, schema: str,
               join: bool = True) -> DataFrame:
    """An opaque group function in parts, so that a hot group is the work of many tasks.

    ``init()`` makes a state, ``update(state, rows)`` adds a pandas frame of a group's rows (a part of
    an Arrow batch), ``merge(a, b)`` joins two states and ``finish(state)`` gives the group's
    values, a dict with the columns of ``schema``.  A call costs far more than a row, so the rows of
    a group are brought together first, and ``update`` is called once a group and batch; the
    few hot groups have many rows in every batch and are folded in place.  States (pickled) are
    merged by key - one state a task, whatever the rows - and the values are joined back
    to the rows (``join``; else one row per group).  Groups of a NULL key are groups of their own.
    """
    keys = as_list(keys)
    fields = df.select(*keys).schema
    state_schema = StructType([*fields.fields, StructField("_state", BinaryType())])
    out_schema = StructType([*fields.fields, *StructType.fromDDL(schema).fields])
    values = [f.name for f in StructType.fromDDL(schema).fields]

    def key_of(row: tuple) -> tuple:
        return tuple(None if pd.isna(v) else v for v in row)

    def rows_of(states: dict) -> pd.DataFrame:
        frame = pd.DataFrame(list(states), columns=keys, dtype=object)
        return frame.assign(_state=[pickle.dumps(s) for s in states.values()])

    def partial(batches):
        states: dict = {}
        for pdf in batches:
            code = pdf.groupby(keys, dropna=False, sort=False).ngroup().to_numpy()
            order = np.argsort(code, kind="stable")
            pdf, starts = pdf.take(order), np.flatnonzero(np.diff(code[order], prepend=-1))
            names = pdf[keys].iloc[starts].itertuples(index=False, name=None)
            for key, at, end in zip(map(key_of, names), starts, [*starts[1:], len(pdf)]):
                states[key] = update(states[key] if key in states else init(), pdf.iloc[at:end])
            if len(states) > HELD_GROUPS:
                yield rows_of(states)
                states = {}
        if states:
            yield rows_of(states)

    def finished(done: list) -> pd.DataFrame:
        frame = pd.DataFrame([k for k, _ in done], columns=keys, dtype=object)
        return frame.assign(**{v: pd.Series([found[v] for _, found in done], dtype=object) for v in values})

    def final(batches):
        """States in the order of their keys."""
        held = None
        for pdf in batches:
            done = []
            for *row, state in pdf[[*keys, "_state"]].itertuples(index=False, name=None):
                key, state = key_of(row), pickle.loads(state)
                if held and held[0] == key:
                    held = key, merge(held[1], state)
                else:
                    if held:
                        done.append((held[0], finish(held[1])))
                    held = key, state
            if done:
                yield finished(done)
        if held:
            yield finished([(held[0], finish(held[1]))])

    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    # fewer than HOT_SHARE rows whatever the input
    hot = sizes.where(F.col("_n") * HOT_SHARE > df.agg(F.count(F.lit(1))).scalar()).select(*keys, F.lit(True).alias("_hot"))
    marked = join_on_keys(df, F.broadcast(hot), keys, "left")
    cold = marked.where(F.col("_hot").isNull()).drop("_hot").repartition(*keys).sortWithinPartitions(*keys)
    states = (marked.where("_hot").drop("_hot").mapInPandas(partial, state_schema)
              .unionByName(cold.mapInPandas(partial, state_schema)))
    groups = states.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(final, out_schema)
    return join_on_keys(df, groups, keys, "left") if join else groups


def row_apply(fn, return_type: str) -> Callable:
    """An opaque row function as a vectorised pandas UDF (Arrow batches);
    prefer Column expressions (C14)."""
    return F.pandas_udf(fn, return_type)

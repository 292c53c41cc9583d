"""Cleaning and imputation (inventory D1-D15).

Global statistics (mean, median, quantiles, min/max edges) are uncorrelated
scalar subqueries over one aggregate: evaluated once, shipped to the tasks as a
literal, the data never leaves the executors.  Per-group statistics are grouped
aggregates joined back on the group keys.
"""

from __future__ import annotations

from typing import Any, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowframe.operators import order as O
from flowframe.operators.order import as_list, join_on_keys
from flowframe.operators.stats import quantile_array, quantile_scalar, quantiles


def dropna(df: DataFrame, subset: Sequence[str] | None = None, how: str = "any") -> DataFrame:
    """``dropna(subset=, how=)``."""
    return df.dropna(how=how, subset=list(subset) if subset else None)


def fillna(df: DataFrame, value: Any) -> DataFrame:
    """``fillna(0)`` or ``fillna({col: value})``; a value only fills columns of
    a compatible type, as ``na.fill`` does."""
    if isinstance(value, dict):
        return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in value.items()})
    return df.na.fill(value)




def impute(df: DataFrame, cols: Sequence[str], strategy: str = "mean", keys=None,
           suffix: str = "") -> DataFrame:
    """D3: ``fillna(s.mean()/median())`` / ``SimpleImputer(strategy)``.

    ``most_frequent`` takes the most common value, ties to the smallest.  With
    ``keys`` the statistic is per group (``groupby.transform``).
    """
    keys = as_list(keys)

    def stat_table(c: str) -> DataFrame:
        if strategy == "most_frequent":
            vc = df.where(F.col(c).isNotNull()).groupBy(*keys, c).agg(F.count(F.lit(1)).alias("_f"))
            return vc.groupBy(*keys).agg(F.min_by(c, F.struct(F.negative("_f"), F.col(c))).alias(f"_fill_{c}"))
        if strategy == "median":
            return quantiles(df, c, [0.5], keys, [f"_fill_{c}"])
        if strategy == "mean":
            return df.groupBy(*keys).agg(F.avg(c).alias(f"_fill_{c}"))
        raise ValueError(strategy)

    if not keys:
        return df.withColumns({f"{c}{suffix}": F.coalesce(F.col(c), stat_table(c).scalar()) for c in cols})
    out = df
    for c in cols:
        out = join_on_keys(out, stat_table(c), keys, "left")
    return out.withColumns({f"{c}{suffix}": F.coalesce(F.col(c), F.col(f"_fill_{c}")) for c in cols}) \
              .drop(*[f"_fill_{c}" for c in cols])


def fill_both(df: DataFrame, keys, order, ffill_cols: Sequence[str] = (),
              bfill_cols: Sequence[str] = ()) -> DataFrame:
    """Forward fill some columns and backward fill others in one pass."""
    d = O.positions(df, keys, order, "_fpos")
    out = O.prefixes(d, keys, "_fpos", forward=[(f"_ff_{c}", "last", c) for c in ffill_cols],
                     backward=[(f"_bf_{c}", "first", c) for c in bfill_cols])
    ren = {**{c: F.col(f"_ff_{c}") for c in ffill_cols}, **{c: F.col(f"_bf_{c}") for c in bfill_cols}}
    return out.withColumns(ren).drop(*[f"_ff_{c}" for c in ffill_cols], *[f"_bf_{c}" for c in bfill_cols], "_fpos")


def ffill(df: DataFrame, keys, order, cols: Sequence[str], suffix: str = "") -> DataFrame:
    """``ffill()``: last non-NULL value up to the row, per series."""
    d = O.positions(df, keys, order, "_ffpos")
    out = O.forward_prefix(d, keys, "_ffpos", [(f"{c}{suffix}" if suffix else f"_ff_{c}", "last", c) for c in cols])
    if not suffix:
        out = out.withColumns({c: F.col(f"_ff_{c}") for c in cols}).drop(*[f"_ff_{c}" for c in cols])
    return out.drop("_ffpos")


def bfill(df: DataFrame, keys, order, cols: Sequence[str], suffix: str = "") -> DataFrame:
    """``bfill()``: next non-NULL value from the row on, per series."""
    d = O.positions(df, keys, order, "_bfpos")
    out = O.backward_prefix(d, keys, "_bfpos", [(f"{c}{suffix}" if suffix else f"_bf_{c}", "first", c) for c in cols])
    if not suffix:
        out = out.withColumns({c: F.col(f"_bf_{c}") for c in cols}).drop(*[f"_bf_{c}" for c in cols])
    return out.drop("_bfpos")


def interpolate(df: DataFrame, keys, order, col: str, name: str | None = None) -> DataFrame:
    """``interpolate(method='linear')`` by row position: between the previous
    value a (position p) and the next b (q): ``a + (b-a)(pos-p)/(q-p)``; before the
    first value NULL, after the last value the last value."""
    name = name or col
    d = O.positions(df, keys, order, "_ipos")
    pv = F.when(F.col(col).isNotNull(), F.struct(F.col("_ipos").alias("p"), F.col(col).cast("double").alias("v")))
    d = d.withColumn("_pv", pv)
    d = O.prefixes(d, keys, "_ipos", forward=[("_prev", "last", "_pv")], backward=[("_next", "first", "_pv")])
    a, p, b, q = F.col("_prev.v"), F.col("_prev.p"), F.col("_next.v"), F.col("_next.p")
    val = (F.when(F.col(col).isNotNull(), F.col(col).cast("double"))
            .when(F.col("_prev").isNull(), F.lit(None))
            .when(F.col("_next").isNull(), a)
            .otherwise(a + (b - a) * (F.col("_ipos") - p) / (q - p)))
    return d.withColumn(name, val).drop("_pv", "_prev", "_next", "_ipos")


def drop_duplicates(df: DataFrame, subset: Sequence[str], order) -> DataFrame:
    """``drop_duplicates(subset)`` keeping the first row in ``order``.

    One grouped ``min_by`` per subset value: partial aggregation keeps a very
    frequent duplicate group from landing in one task."""
    order = O.as_order(order)
    rest = [c for c in df.columns if c not in subset]
    key = F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)])
    row = F.struct(*[F.col(f"`{c}`") for c in rest])
    g = df.groupBy(*[F.col(f"`{c}`") for c in subset]).agg(F.min_by(row, key).alias("_row"))
    return g.select(*[F.col(f"`{c}`") for c in subset], *[F.col("_row")[c].alias(c) for c in rest]) \
            .select(*[F.col(f"`{c}`") for c in df.columns])


def cast_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """``astype``: 'double', 'int' (booleans to 0/1), 'string'; dates to
    ISO text."""
    out = {}
    dtypes = dict(df.dtypes)
    for c, t in types.items():
        if t == "string" and dtypes[c] in ("date", "timestamp", "timestamp_ntz"):
            fmt = "yyyy-MM-dd" if dtypes[c] == "date" else "yyyy-MM-dd HH:mm:ss"
            out[c] = F.date_format(F.col(c), fmt)
        else:
            out[c] = F.col(c).cast(t)
    return df.withColumns(out)


def to_numeric(c: Column) -> Column:
    """``pd.to_numeric(errors='coerce')``: unparsable text -> NULL."""
    return c.try_cast("double")


def to_datetime(c: Column, fmt: str | None = None) -> Column:
    """``pd.to_datetime``: text to TIMESTAMP_NTZ, unparsable -> NULL."""
    if fmt:
        return F.try_to_timestamp(c, F.lit(fmt)).cast("timestamp_ntz")
    return c.try_cast("timestamp_ntz")


def category_codes(df: DataFrame, col: str, name: str | None = None) -> DataFrame:
    """``astype('category').cat.codes``: code = rank of the value among the
    sorted distinct values, NULL -> -1.  The level table is positioned with the
    scalable row index and joined back (broadcast by AQE when small)."""
    name = name or f"{col}_code"
    levels = df.where(F.col(col).isNotNull()).select(col).distinct()
    levels = O.positions(levels, [], [col], "_code")
    out = join_on_keys(df, levels, [col], "left")
    return out.withColumn(name, F.coalesce(F.col("_code"), F.lit(-1)).cast("int")).drop("_code")


def clip(c: Column, lower: Column | float | None = None, upper: Column | float | None = None) -> Column:
    """``clip`` keeping NULL."""
    out = c
    if lower is not None:
        out = F.greatest(out, lower if isinstance(lower, Column) else F.lit(lower))
    if upper is not None:
        out = F.least(out, upper if isinstance(upper, Column) else F.lit(upper))
    return F.when(c.isNotNull(), out)


def cap_outliers(df: DataFrame, col: str, q: float = 0.99, name: str | None = None) -> DataFrame:
    """``s.clip(upper=s.quantile(q))``."""
    return df.withColumn(name or col, clip(F.col(col), upper=quantile_scalar(df, col, q)))


def cut(df: DataFrame, col: str, bins: int, labels: Sequence[str] | None = None,
        name: str | None = None) -> DataFrame:
    """``pd.cut(s, bins=n, labels)``: equal width on [min, max], right-closed,
    the minimum goes to the first bin (S17)."""
    name = name or f"{col}_bin"
    x = F.col(col).cast("double")
    one = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi"))
    lo, hi = one.select("lo").scalar(), one.select("hi").scalar()
    labels = list(labels) if labels else list(range(bins))
    expr = None
    for k in range(bins):
        edge = lo + (hi - lo) * F.lit((k + 1) / bins) if k < bins - 1 else hi
        cond = x <= edge
        expr = F.when(cond, F.lit(labels[k])) if expr is None else expr.when(cond, F.lit(labels[k]))
    return df.withColumn(name, F.when(x.isNotNull(), expr))


def qcut(df: DataFrame, col: str, q: int, labels: Sequence[str] | None = None,
         name: str | None = None) -> DataFrame:
    """``pd.qcut(s, q, labels)``: edges at interpolated quantiles k/q,
    right-closed, lowest edge included (S18)."""
    name = name or f"{col}_qbin"
    x = F.col(col).cast("double")
    edges = quantile_array(df, x, [k / q for k in range(1, q)])
    labels = list(labels) if labels else list(range(q))
    expr = None
    for k in range(q):
        if k < q - 1:
            cond = x <= edges[k]
            expr = F.when(cond, F.lit(labels[k])) if expr is None else expr.when(cond, F.lit(labels[k]))
        else:
            expr = expr.otherwise(F.lit(labels[k])) if expr is not None else F.lit(labels[k])
    return df.withColumn(name, F.when(x.isNotNull(), expr))

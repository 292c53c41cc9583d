"""Window and time-series operators (inventory G1-G12).

All take ``keys`` (series identity, may be empty) and ``order``.  Group statistics
are computed with a grouped aggregate (partial aggregation before the shuffle, so a
hot group costs nothing extra) and attached back by a join on the group keys: at
run time AQE broadcasts the statistics table when it is small and splits skewed
partitions when it is not.  Row-order operators go through
:mod:`flowframe.operators.order` so no task ever holds a whole series.
"""

from __future__ import annotations

import math
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowframe.operators import order as O
from flowframe.operators.order import POS, as_list, join_on_keys

DAY_US = 86_400_000_000


def _stat(kind: str, c: str) -> Column:
    return {
        "mean": F.avg(c), "sum": F.sum(c), "min": F.min(c), "max": F.max(c),
        "std": F.stddev_samp(c), "count": F.count(c),
    }[kind]


# ---------------------------------------------------------------- G1, G2 group statistics

def group_stats(df: DataFrame, keys, cols_stats: dict[str, Sequence[str]],
                dropna_keys: bool = True) -> DataFrame:
    """One row per group with ``{col}_{stat}`` columns (flat names, F2 style)."""
    keys = as_list(keys)
    src = df.dropna(subset=keys) if (dropna_keys and keys) else df
    aggs = [_stat(s, c).alias(f"{c}_{s}") for c, stats in cols_stats.items() for s in stats]
    return src.groupBy(*keys).agg(*aggs)


def group_transform(df: DataFrame, keys, col: str, stat: str = "mean",
                    name: str | None = None) -> DataFrame:
    """G1: group statistic of ``col`` broadcast to every row of the group
    (``groupby(k)[c].transform(stat)``).  Rows with a NULL key get NULL."""
    keys = as_list(keys)
    name = name or f"{col}_{stat}"
    stats = df.groupBy(*keys).agg(_stat(stat, col).alias(name))
    return join_on_keys(df, stats, keys, "left").withColumn(
        name, F.when(_keys_present(keys), F.col(name)))


def _keys_present(keys) -> Column:
    c = F.lit(True)
    for k in keys:
        c = c & F.col(k).isNotNull()
    return c


def group_demean(df: DataFrame, keys, col: str, name: str | None = None) -> DataFrame:
    """``x - mean(x)`` within the group."""
    name = name or f"{col}_demeaned"
    t = group_transform(df, keys, col, "mean", "_gmean")
    return t.withColumn(name, F.col(col) - F.col("_gmean")).drop("_gmean")


def group_zscore(df: DataFrame, keys, col: str, name: str | None = None) -> DataFrame:
    """``(x - mean) / std`` with sample std; one-row or constant group -> NULL."""
    keys = as_list(keys)
    name = name or f"{col}_z"
    stats = df.groupBy(*keys).agg(F.avg(col).alias("_gm"), F.stddev_samp(col).alias("_gs"))
    t = join_on_keys(df, stats, keys, "left")
    z = F.try_divide(F.col(col) - F.col("_gm"), F.col("_gs"))
    return t.withColumn(name, F.when(_keys_present(keys), z)).drop("_gm", "_gs")


# ---------------------------------------------------------------- G3-G7 bounded row frames

def _with_pos(df: DataFrame, keys, order, pos: str | None):
    if pos and pos in df.columns:
        return df, pos, False
    return O.positions(df, keys, order, POS), POS, True


def lags(df: DataFrame, keys, order, col: str, periods: Sequence[int],
         names: Sequence[str] | None = None, pos: str | None = None) -> DataFrame:
    """``shift(n)`` for each n (negative n looks ahead, like ``shift(-1)``)."""
    names = list(names or [f"{col}_lag_{n}" if n >= 0 else f"{col}_lead_{-n}" for n in periods])
    d, p, drop = _with_pos(df, keys, order, pos)
    before = max([n for n in periods if n > 0], default=0)
    after = max([-n for n in periods if n < 0], default=0)

    def build(w):
        return {nm: (F.lag(col, n).over(w) if n >= 0 else F.lead(col, -n).over(w))
                for nm, n in zip(names, periods)}

    out = O.bounded(d, keys, p, before, after, build)
    return out.drop(p) if drop else out


def diff(df: DataFrame, keys, order, col: str, periods: int = 1,
         name: str | None = None, pos: str | None = None) -> DataFrame:
    """``x - x.shift(periods)``."""
    name = name or f"{col}_diff"
    out = lags(df, keys, order, col, [periods], ["_lagd"], pos)
    return out.withColumn(name, F.col(col) - F.col("_lagd")).drop("_lagd")


def pct_change(df: DataFrame, keys, order, col: str, name: str | None = None,
               pad: bool = True, pos: str | None = None) -> DataFrame:
    """Relative change to the previous row; missing values are padded first
    (pandas 2.x ``fill_method='pad'``).  Division by zero gives NULL (S10)."""
    name = name or f"{col}_pct_change"
    d, p, drop = _with_pos(df, keys, order, pos)
    base = col
    if pad:
        d = O.forward_prefix(d, keys, p, [("_padded", "last", col)])
        base = "_padded"
    d = lags(d, keys, order, base, [1], ["_prev"], p)
    d = d.withColumn(name, F.try_divide(F.col(base), F.col("_prev")) - F.lit(1.0))
    d = d.drop("_prev", "_padded") if pad else d.drop("_prev")
    return d.drop(p) if drop else d


def rolling_rows(df: DataFrame, keys, order, col: str, window: int,
                 stats: Sequence[str] = ("mean",), center: bool = False,
                 min_periods: int | None = None, prefix: str | None = None,
                 pos: str | None = None) -> DataFrame:
    """``rolling(window, center=).stat()``; a result needs ``min_periods``
    (default: ``window``) non-NULL values in the frame, as in pandas."""
    prefix = prefix or f"{col}_roll{window}"
    minp = window if min_periods is None else min_periods
    if center:
        after = (window - 1) // 2
        before = window - 1 - after
    else:
        before, after = window - 1, 0
    d, p, drop = _with_pos(df, keys, order, pos)

    def build(w):
        f = w.rowsBetween(-before, after)
        n = F.count(col).over(f)
        return {f"{prefix}_{s}": F.when(n >= F.lit(max(minp, 2 if s == "std" else 1)), _stat(s, col).over(f))
                for s in stats}

    out = O.bounded(d, keys, p, before, after, build)
    return out.drop(p) if drop else out


# ---------------------------------------------------------------- G8 time-range frames

def rolling_time(df: DataFrame, keys, ts: str, col: str, width_days: float = 7,
                 stats: Sequence[str] = ("mean", "std"), prefix: str | None = None,
                 blocks: int | None = None) -> DataFrame:
    """``rolling('7D')``: frame ``(t - width, t]`` of the same series, one
    non-NULL value suffices (std needs two).  ``ts`` must be unique per series."""
    keys = as_list(keys)
    prefix = prefix or f"{col}_roll{int(width_days)}d"
    width = int(round(width_days * DAY_US))
    d = df.withColumn("_tus", O.epoch_micros(ts))
    h = O.with_time_halo(d, keys, "_tus", width, blocks)
    w = Window.partitionBy(*keys, "_seg").orderBy("_tus").rangeBetween(-(width - 1), 0)
    n = F.count(col).over(w)
    cols = {f"{prefix}_{s}": F.when(n >= F.lit(2 if s == "std" else 1), _stat(s, col).over(w))
            for s in stats}
    return O.drop_halo(h.withColumns(cols)).drop("_tus")


# ---------------------------------------------------------------- G9 expanding

def expanding(df: DataFrame, keys, order, col: str, stats: Sequence[str] = ("max", "mean"),
              prefix: str | None = None, pos: str | None = None) -> DataFrame:
    """``expanding().stat()`` from the series start (min_periods=1)."""
    prefix = prefix or f"{col}_exp"
    d, p, drop = _with_pos(df, keys, order, pos)
    specs = []
    if "mean" in stats or "sum" in stats:
        specs += [("_es", "sum", col), ("_ec", "count", col)]
    for s in ("max", "min"):
        if s in stats:
            specs.append((f"{prefix}_{s}", s, col))
    if "count" in stats and ("_ec", "count", col) not in specs:
        specs.append(("_ec", "count", col))
    out = O.forward_prefix(d, keys, p, specs)
    extra = {}
    if "mean" in stats:
        extra[f"{prefix}_mean"] = F.when(F.col("_ec") > 0, F.col("_es") / F.col("_ec"))
    if "sum" in stats:
        extra[f"{prefix}_sum"] = F.coalesce(F.col("_es"), F.lit(0.0))
    if "count" in stats:
        extra[f"{prefix}_count"] = F.col("_ec")
    out = out.withColumns(extra).drop(*[c for c in ("_es", "_ec") if c in out.columns])
    return out.drop(p) if drop else out


# ---------------------------------------------------------------- G10 EWM

#: Segments whose states one fold combines.
FOLD = 128


def _compose(first: Column, then: Column) -> Column:
    """The state after ``first`` and ``then``: (decay, weight, mean), decay and weight as logarithms,
    so that nothing underflows however long ago the values were; a state without values has none."""
    kept = first["weight"] + then["decay"]
    top = F.greatest(kept, then["weight"])
    a, b = F.exp(kept - top), F.exp(then["weight"] - top)
    both = F.struct((first["decay"] + then["decay"]).alias("decay"), (top + F.log(a + b)).alias("weight"),
                    ((a * first["mean"] + b * then["mean"]) / (a + b)).alias("mean"))
    only = lambda weight, mean: F.struct((first["decay"] + then["decay"]).alias("decay"), weight.alias("weight"), mean.alias("mean"))
    return (F.when(then["mean"].isNull(), only(kept, first["mean"]))
            .when(first["mean"].isNull(), only(then["weight"], then["mean"])).otherwise(both))


def _no_state() -> Column:
    none = F.lit(None).cast("double")
    return F.struct(F.lit(0.0).alias("decay"), none.alias("weight"), none.alias("mean"))


def _states_before(states: DataFrame, series: list[str]) -> DataFrame:
    """(series, seg, before) for ``states`` (series, seg, state): the state of all earlier segments.

    An exclusive scan by levels: ``FOLD`` neighbouring segments fold into one state, those fold
    again until one fold holds a series, and the states come back down; no task holds
    more than ``FOLD`` states of a group.
    """
    groups = (states.withColumn("group", F.floor(F.col("seg") / F.lit(FOLD)))
              .groupBy(*series, "group").agg(F.array_sort(F.collect_list(F.struct("seg", "state"))).alias("list")))
    last = states.agg(F.max("seg")).first()[0]
    if last is None or last < FOLD:
        groups = groups.withColumn("start", _no_state())
    else:
        groups = O.materialize(groups)
        folded = groups.select(*series, F.col("group").alias("seg"),
                               F.reduce("list", _no_state(), lambda acc, x: _compose(acc, x["state"])).alias("state"))
        above = _states_before(folded, series).select(*series, F.col("seg").alias("group"), F.col("before").alias("start"))
        groups = groups.join(above, [*series, "group"])
    # one running state and the list of those before each segment
    begin = F.struct(F.col("start").alias("now"), F.filter(F.array(F.struct(F.lit(0).cast("bigint").alias("seg"), F.col("start").alias("before"))),
                                                         lambda x: F.lit(False)).alias("out"))
    step = lambda acc, x: F.struct(_compose(acc["now"], x["state"]).alias("now"),
                                   F.array_append(acc["out"], F.struct(x["seg"].alias("seg"), acc["now"].alias("before"))).alias("out"))
    return groups.select(*series, F.explode(F.reduce("list", begin, step)["out"]).alias("e")).select(*series, "e.seg", "e.before")


def ewm_mean(df: DataFrame, keys, order, col: str, span: float | None = None,
             alpha: float | None = None, name: str | None = None,
             pos: str | None = None) -> DataFrame:
    """``ewm(span).mean()`` with ``adjust=True, ignore_na=False``.

    ``y_t = sum_j r^(t-j) x_j / sum_j r^(t-j)`` over all non-NULL ``x_j``, ``r = 1-alpha``,
    row positions ``j <= t``: no horizon.  Inside a segment (first position e0) both sums are
    running sums of ``r^-(j-e0) x_j`` and ``r^-(j-e0)``; the segment length keeps the
    weights below 1e150.  What came before a segment is one state (how much later rows decay it,
    its weight, its mean); states compose, so an exclusive scan over the small table of
    segments gives every segment its start.  At a NULL ``x_t`` the value is that of the
    last non-NULL position.
    """
    if alpha is None:
        alpha = 2.0 / (float(span) + 1.0)
    name = name or f"{col}_ewm"
    r = 1.0 - alpha
    keys = as_list(keys)
    d, p, drop = _with_pos(df, keys, order, pos)
    if r <= 0.0:
        out = d.withColumn("_ewm_raw", F.col(col).cast("double"))
        out = O.forward_prefix(out, keys, p, [(name, "last", "_ewm_raw")]).drop("_ewm_raw")
        return out.drop(p) if drop else out
    reach = int(150 / -math.log10(r)) if r < 1.0 else 1 << 30
    rows = max(1, min(O.segment_rows(d), reach))
    log_r = math.log(r)
    d, series = O.with_series(d.withColumn("_seg", F.floor(F.col(p) / F.lit(rows)).cast("long")), keys)
    first = F.col("_seg") * F.lit(rows)
    w = Window.partitionBy(*series, "_seg").orderBy(p).rowsBetween(Window.unboundedPreceding, 0)
    x = F.col(col).cast("double")
    d = d.withColumn("_wt", F.when(x.isNotNull(), F.pow(F.lit(1.0 / r), F.col(p) - first)))
    d = d.withColumns({"_num": F.sum(x * F.col("_wt")).over(w), "_den": F.sum("_wt").over(w)})
    # a segment's state is read off its last row; both sides of the join share the windowed plan
    end = d.groupBy(*series, "_seg").agg(F.max_by(F.struct(F.col(p).alias("p"), "_num", "_den"), p).alias("e"))
    length = F.lit(log_r) * (F.col("e.p") + 1 - first)
    state = F.struct(length.alias("decay"), (F.log("e._den") + length).alias("weight"), (F.col("e._num") / F.col("e._den")).alias("mean"))
    before = _states_before(O.materialize(end.select(*series, F.col("_seg").alias("seg"), state.alias("state"))), series)
    joined = d.join(before.select(*series, F.col("seg").alias("_seg"), F.col("before").alias("_before")), [*series, "_seg"])
    # the earlier rows' weight on the scale of the segment's own sums
    earlier = F.exp("_before.weight")
    value = (F.when(F.col("_den").isNull(), F.col("_before.mean")).when(F.col("_before.mean").isNull(), F.col("_num") / F.col("_den"))
             .otherwise((earlier * F.col("_before.mean") + F.col("_num")) / (earlier + F.col("_den"))))
    out = joined.withColumn(name, value).drop("_seg", "_wt", "_num", "_den", "_before", O.SERIES)
    return out.drop(p) if drop else out


# ---------------------------------------------------------------- G11, G12 resample

def period_label(ts: str, rule: str) -> Column:
    """Bin label of pandas ``resample(rule)``: 'W' = week ending Sunday labelled by
    that Sunday (S12); 'M'/'ME' = month end (S13); 'MS' = month start; 'D' = day."""
    d = F.to_date(F.col(ts))
    if rule in ("W", "W-SUN"):
        return F.date_add(F.to_date(F.date_trunc("week", F.col(ts))), 6)
    if rule in ("M", "ME"):
        return F.last_day(d)
    if rule == "MS":
        return F.trunc(d, "MM")
    if rule == "D":
        return d
    raise ValueError(f"unsupported rule {rule}")


def _step(rule: str) -> Column:
    return {"W": F.expr("INTERVAL 7 DAYS"), "W-SUN": F.expr("INTERVAL 7 DAYS"),
            "M": F.expr("INTERVAL 1 MONTH"), "ME": F.expr("INTERVAL 1 MONTH"),
            "MS": F.expr("INTERVAL 1 MONTH"), "D": F.expr("INTERVAL 1 DAY")}[rule]


def resample(df: DataFrame, keys, ts: str, rule: str, aggs: dict[str, Sequence[str]],
             label: str = "period") -> DataFrame:
    """Per series, one row per period from the first to the last period
    present, empty periods included (mean/max/min NULL, sum/count 0).

    Output columns: keys, ``label`` (DATE), ``{col}_{stat}``.
    """
    keys = as_list(keys)
    lab = period_label(ts, rule)
    src = df.dropna(subset=keys) if keys else df
    binned = src.withColumn(label, lab)
    names = {f"{c}_{s}": (c, s) for c, ss in aggs.items() for s in ss}
    agg = binned.groupBy(*keys, label).agg(*[_stat(s, c).alias(n) for n, (c, s) in names.items()])
    spine = calendar_spine_from(agg, keys, label, rule)
    out = join_on_keys(spine, agg, [*keys, label], "left")
    fills = {n: F.coalesce(F.col(n), F.lit(0)) for n, (c, s) in names.items() if s in ("sum", "count")}
    return out.withColumns(fills) if fills else out


def calendar_spine_from(binned: DataFrame, keys, label: str, rule: str) -> DataFrame:
    """Every period between each series' first and last label (A7 per series)."""
    keys = as_list(keys)
    bounds = binned.groupBy(*keys).agg(F.min(label).alias("_lo"), F.max(label).alias("_hi"))
    if rule in ("M", "ME"):
        # month ends: step month starts, then take the month end
        seq = F.sequence(F.trunc("_lo", "MM"), F.trunc("_hi", "MM"), _step(rule))
        return bounds.select(*keys, F.explode(seq).alias("_m")).select(*keys, F.last_day("_m").alias(label))
    seq = F.sequence(F.col("_lo"), F.col("_hi"), _step(rule))
    return bounds.select(*keys, F.explode(seq).alias(label))

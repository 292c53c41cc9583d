"""Batch forecasting over many series (inventory K21, K22).

K21 re-aims the zero-shot foundation-model forecast (no weights, single-machine
runtime) as native per-series methods computed by windows and aggregates:
naive, drift and seasonal naive, each with a residual spread and nine deciles.
A user model can be plugged in per series with ``groupBy(keys).applyInPandas``.
K22 is the recursive multi-step forecast: one distributed transform per step over
the one-row-per-series frontier.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowframe.operators import order as O
from flowframe.operators import windows as W
from flowframe.operators.order import as_list, join_on_keys
from flowframe.session import checkpoint

# Standard normal quantiles at 0.1, 0.2, ..., 0.9 (the nine deciles).
DECILE_Z = [-1.2815515655446004, -0.8416212335729143, -0.5244005127080407, -0.2533471031357997, 0.0,
            0.2533471031357997, 0.5244005127080407, 0.8416212335729143, 1.2815515655446004]
DECILES = [f"q{10 * (i + 1)}" for i in range(9)]


def forecast(df: DataFrame, keys, ts: str, value: str, horizon: int = 30, method: str = "naive",
             season: int = 7, context: int | None = None, step_days: int = 1, clamp: bool = True) -> DataFrame:
    """Forecast the next ``horizon`` steps of every series from its latest
    ``context`` points (default: the whole history).  A forecast that a short series
    does not allow - drift of one point, a season that it does not cover - is NULL.

    With last value L, first context value F, context length n and one-step
    error spread s (sample std): naive ``L`` +- ``s sqrt(h)``; drift ``L + h(L-F)/(n-1)``
    +- ``s sqrt(h (1 + h/(n-1)))``; seasonal naive: the value one season back
    +- ``s sqrt(floor((h-1)/m) + 1)``.  Deciles are point + z * spread (monotone by
    construction), clamped at 0 when the context has no negative value.
    Output: keys, step, ts (last ts + step days), point, q10..q90.
    """
    keys = as_list(keys)
    d = O.positions(df, keys, [ts], "_fp")
    n_all = d.groupBy(*keys).agg(F.count(F.lit(1)).alias("_nall"))
    d = join_on_keys(d, n_all, keys) if keys else d.withColumn("_nall", d.agg(F.count(F.lit(1))).scalar())
    skip = F.greatest(F.col("_nall") - context, F.lit(0)) if context else F.lit(0)
    ctx = d.where(F.col("_fp") >= skip).withColumn("_ctxp", F.col("_fp") - skip)
    m = season if method == "seasonal_naive" else 1
    ctx = W.lags(ctx, keys, [ts], value, [m], ["_prev"], pos="_ctxp")
    stats = ctx.groupBy(*keys).agg(
        F.max_by(value, "_ctxp").alias("_L"), F.min_by(value, "_ctxp").alias("_F"),
        F.count(F.lit(1)).alias("_n"), F.max(ts).alias("_last_ts"), F.min(value).alias("_min"),
        F.stddev_samp(F.col(value) - F.col("_prev")).alias("_s_naive"),
        F.sort_array(F.collect_list(F.when(F.col("_ctxp") >= F.col("_nall") - skip - season,
                                           F.struct("_ctxp", F.col(value).alias("v"))))).alias("_tail"))
    drift = F.try_divide(F.col("_L") - F.col("_F"), F.col("_n") - 1)
    # spread: sample std of the one-step (one-season) errors; the drift method's
    # errors are the naive ones shifted by the mean step, so the std is the same
    stats = stats.withColumn("_s", F.col("_s_naive"))
    fut = stats.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    h = F.col("step")
    if method == "naive":
        point, spread = F.col("_L"), F.col("_s") * F.sqrt(h)
    elif method == "drift":
        point = F.col("_L") + h * drift
        spread = F.col("_s") * F.sqrt(h * (1 + F.try_divide(h, F.col("_n") - 1)))
    elif method == "seasonal_naive":
        tail = F.transform("_tail", lambda e: e["v"])
        at = F.size(tail) - F.lit(season) + F.pmod(h - 1, F.lit(season)) + 1
        point = F.when(at >= 1, F.try_element_at(tail, F.greatest(at, F.lit(1))))
        spread = F.col("_s") * F.sqrt(F.floor((h - 1) / season) + 1)
    else:
        raise ValueError(method)
    fut = fut.withColumns({"point": point, "_spread": spread})
    qs = {}
    for name, z in zip(DECILES, DECILE_Z):
        q = F.col("point") + F.lit(z) * F.col("_spread")
        qs[name] = F.when(F.lit(clamp) & (F.col("_min") >= 0), F.greatest(q, F.lit(0.0))).otherwise(q)
    out = fut.withColumns(qs).withColumn(
        "ts", F.col("_last_ts") + F.make_interval(days=(h * step_days).cast("int")))
    return out.select(*keys, "step", "ts", "point", *DECILES)


def recursive_forecast(history: DataFrame, keys, ts: str, value: str, n_lags: int = 7,
                       horizon: int = 14, checkpoint_every: int = 5) -> DataFrame:
    """Fit one linear model on lag features of all series, then predict
    ``horizon`` steps by feeding predictions back as lags.  The frontier holds
    one row per series with its last ``n_lags`` values as an array; each step is
    one distributed ``transform``.  Lineage is cut with ``checkpoint()`` (the
    shared checkpoint folder) every ``checkpoint_every`` steps.  A series with fewer
    than ``n_lags`` points, or a missing one among the last, has NULL forecasts."""
    keys = as_list(keys)
    lags = list(range(1, n_lags + 1))
    tr = W.lags(history, keys, [ts], value, lags, [f"_l{k}" for k in lags]).dropna(
        subset=[f"_l{k}" for k in lags])
    tr = tr.withColumn("features", array_to_vector(F.array(*[F.col(f"_l{k}").cast("double") for k in lags])))
    model = LinearRegression(labelCol=value, solver="normal").fit(tr)
    d = O.positions(history, keys, [ts], "_rp")
    n = d.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.max(ts).alias("_last"))
    d = join_on_keys(d, n, keys) if keys else d.withColumn("_n", n.select("_n").scalar()).withColumn(
        "_last", n.select("_last").scalar())
    front = (d.where(F.col("_rp") >= F.col("_n") - n_lags)
              .groupBy(*keys, "_last").agg(F.sort_array(F.collect_list(F.struct("_rp", F.col(value).cast("double")
                                                                              .alias("v")))).alias("_t"))
              .select(*keys, "_last", F.transform("_t", lambda e: e["v"]).alias("_hist")))
    ready = (F.size("_hist") == n_lags) & ~F.exists("_hist", lambda v: v.isNull())
    short = front.where(~ready).select(*keys, "_last", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("step"))
    preds = [short.select(*keys, "step", (F.col("_last") + F.make_interval(days=F.col("step"))).alias("ts"),
                          F.lit(None).cast("double").alias("forecast"))]
    front = checkpoint(front.where(ready))
    for step in range(1, horizon + 1):
        # lag k is the k-th value from the end of the history array
        feats = F.array(*[F.element_at("_hist", -k) for k in lags])
        scored = model.transform(front.withColumn("features", array_to_vector(feats)))
        preds.append(scored.select(*keys, F.lit(step).alias("step"),
                                   (F.col("_last") + F.make_interval(days=F.lit(step))).alias("ts"),
                                   F.col("prediction").alias("forecast")))
        front = scored.select(*keys, "_last", F.slice(F.concat("_hist", F.array("prediction")), 2, n_lags)
                              .alias("_hist"))
        if step % checkpoint_every == 0:
            front = checkpoint(front)
    out = preds[0]
    for p in preds[1:]:
        out = out.unionByName(p)
    return out

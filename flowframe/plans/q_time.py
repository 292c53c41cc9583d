"""Catalog: window and time-series operators (G) on the keyed event stream
(``user_id`` series ordered by ``ts``) and the daily/weekly order series."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowframe.operators import windows as W
from flowframe.operators.order import positions
from flowframe.plans.q_table import EVENTS_NULLS, events_with_nulls
from flowframe.plans.registry import query, rnd
from flowframe.sources.io import table as T

KEYS, ORD = ["user_id"], ["ts"]


def _ev(spark, sf):
    return events_with_nulls(spark, sf).select("event_id", "user_id", "ts", "event_type", "value")


@query("g01_group_transform_mean", f"""SELECT event_id, event_type,
  ROUND(AVG(value) OVER (PARTITION BY event_type), 6) AS value_mean,
  ROUND(value - AVG(value) OVER (PARTITION BY event_type), 6) AS value_demeaned FROM {EVENTS_NULLS}""", "T")
def g01(spark, sf):
    e = _ev(spark, sf)
    e = W.group_transform(e, ["event_type"], "value", "mean", "value_mean")
    e = W.group_demean(e, ["event_type"], "value", "value_demeaned")
    return e.select("event_id", "event_type", rnd("value_mean", 6).alias("value_mean"),
                    rnd("value_demeaned", 6).alias("value_demeaned"))


@query("g02_group_zscore", f"""SELECT event_id, user_id,
  ROUND((value - AVG(value) OVER (PARTITION BY user_id)) / NULLIF(STDDEV_SAMP(value) OVER (PARTITION BY user_id), 0), 6) AS value_z
FROM {EVENTS_NULLS}""", "T")
def g02(spark, sf):
    e = W.group_zscore(_ev(spark, sf), KEYS, "value", "value_z")
    return e.select("event_id", "user_id", rnd("value_z", 6).alias("value_z"))


@query("g03_lag_lead", f"""SELECT event_id, user_id, value,
  LAG(value, 1) OVER w AS lag_1, LAG(value, 7) OVER w AS lag_7, LEAD(value, 1) OVER w AS lead_1
FROM {EVENTS_NULLS} WINDOW w AS (PARTITION BY user_id ORDER BY ts)""")
def g03(spark, sf):
    e = W.lags(_ev(spark, sf), KEYS, ORD, "value", [1, 7, -1], ["lag_1", "lag_7", "lead_1"])
    return e.select("event_id", "user_id", "value", "lag_1", "lag_7", "lead_1")


@query("g04_diff", f"""SELECT event_id, ROUND(value - LAG(value) OVER (PARTITION BY user_id ORDER BY ts), 6) AS value_diff
FROM {EVENTS_NULLS}""", "T")
def g04(spark, sf):
    e = W.diff(_ev(spark, sf), KEYS, ORD, "value", 1, "value_diff")
    return e.select("event_id", rnd("value_diff", 6).alias("value_diff"))


@query("g05_pct_change_padded", f"""
WITH f AS (SELECT event_id, user_id, ts, LAST_VALUE(value IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS v FROM {EVENTS_NULLS})
SELECT event_id, ROUND(v / NULLIF(LAG(v) OVER (PARTITION BY user_id ORDER BY ts), 0) - 1, 6) AS value_pct FROM f""", "T")
def g05(spark, sf):
    e = W.pct_change(_ev(spark, sf), KEYS, ORD, "value", "value_pct")
    return e.select("event_id", rnd("value_pct", 6).alias("value_pct"))


@query("g06_rolling_7_rows", f"""SELECT event_id, CASE WHEN COUNT(value) OVER w = 7 THEN ROUND(AVG(value) OVER w, 6) END AS roll7_mean
FROM {EVENTS_NULLS} WINDOW w AS (PARTITION BY user_id ORDER BY ts ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""", "T")
def g06(spark, sf):
    e = W.rolling_rows(_ev(spark, sf), KEYS, ORD, "value", 7, ["mean"], prefix="roll7")
    return e.select("event_id", rnd("roll7_mean", 6).alias("roll7_mean"))


@query("g07_rolling_centered", f"""SELECT event_id, CASE WHEN COUNT(value) OVER w = 7 THEN ROUND(AVG(value) OVER w, 6) END AS c7_mean
FROM {EVENTS_NULLS} WINDOW w AS (PARTITION BY user_id ORDER BY ts ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)""", "T")
def g07(spark, sf):
    e = W.rolling_rows(_ev(spark, sf), KEYS, ORD, "value", 7, ["mean"], center=True, prefix="c7")
    return e.select("event_id", rnd("c7_mean", 6).alias("c7_mean"))


@query("g08_rolling_7d", f"""SELECT event_id, ROUND(AVG(value) OVER w, 6) AS r7d_mean,
  CASE WHEN COUNT(value) OVER w >= 2 THEN ROUND(STDDEV_SAMP(value) OVER w, 6) END AS r7d_std
FROM {EVENTS_NULLS} WINDOW w AS (PARTITION BY user_id ORDER BY ts
  RANGE BETWEEN INTERVAL '6 days 23:59:59.999999' PRECEDING AND CURRENT ROW)""", "T")
def g08(spark, sf):
    e = W.rolling_time(_ev(spark, sf), KEYS, "ts", "value", 7, ["mean", "std"], prefix="r7d")
    return e.select("event_id", rnd("r7d_mean", 6).alias("r7d_mean"), rnd("r7d_std", 6).alias("r7d_std"))


@query("g09_expanding_max_mean", f"""SELECT event_id, MAX(value) OVER w AS exp_max, ROUND(AVG(value) OVER w, 9) AS exp_mean
FROM {EVENTS_NULLS} WINDOW w AS (PARTITION BY user_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""", "T")
def g09(spark, sf):
    e = W.expanding(_ev(spark, sf), KEYS, ORD, "value", ["max", "mean"], prefix="exp")
    # 9 digits: a mean of 2^k two-decimal values ends in a 5 at digit k+2, where an
    # ulp of summation-order difference would flip a coarser rounding
    return e.select("event_id", "exp_max", rnd("exp_mean", 9).alias("exp_mean"))


# exact definition (no truncation): every earlier non-missing value, weight (1-a)^(t-j)
EWM_SQL = f"""
WITH e AS (SELECT event_id, user_id, value, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts) AS p FROM {EVENTS_NULLS})
SELECT t.event_id, ROUND(SUM(POW(0.75, t.p - j.p) * j.value) / SUM(POW(0.75, t.p - j.p)), 6) AS value_ewm
FROM e t LEFT JOIN e j ON t.user_id = j.user_id AND j.p <= t.p AND j.value IS NOT NULL
GROUP BY t.event_id"""


@query("g10_ewm_span7", EWM_SQL, "T")
def g10(spark, sf):
    e = W.ewm_mean(_ev(spark, sf), KEYS, ORD, "value", span=7, name="value_ewm")
    return e.select("event_id", rnd("value_ewm", 6).alias("value_ewm"))


@query("g11_resample_weekly", """
WITH w AS (SELECT CAST(date_trunc('week', o_orderdate) AS DATE) + 6 AS period, AVG(o_totalprice) AS m, SUM(o_totalprice) AS s,
  MAX(o_totalprice) AS x FROM orders GROUP BY 1),
b AS (SELECT MIN(period) AS lo, MAX(period) AS hi FROM w),
s AS (SELECT CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 7 DAY)) AS DATE) AS period FROM b)
SELECT CAST(s.period AS TIMESTAMP) AS period, ROUND(w.m, 4) AS price_mean, ROUND(COALESCE(w.s, 0), 2) AS price_sum, w.x AS price_max
FROM s LEFT JOIN w ON s.period = w.period""", "T")
def g11(spark, sf):
    r = W.resample(T(spark, sf, "orders").withColumnRenamed("o_totalprice", "price"), [], "o_orderdate", "W",
                   {"price": ["mean", "sum", "max"]})
    return r.select(F.col("period").cast("timestamp_ntz").alias("period"), rnd("price_mean", 4).alias("price_mean"),
                    rnd("price_sum", 2).alias("price_sum"), "price_max")


@query("g11_resample_weekly_keyed", f"""
WITH w AS (SELECT user_id, CAST(date_trunc('week', ts) AS DATE) + 6 AS period, AVG(value) AS m, COUNT(value) AS n
  FROM {EVENTS_NULLS} GROUP BY 1, 2),
b AS (SELECT user_id, MIN(period) AS lo, MAX(period) AS hi FROM w GROUP BY 1),
s AS (SELECT user_id, CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 7 DAY)) AS DATE) AS period FROM b)
SELECT s.user_id, CAST(s.period AS TIMESTAMP) AS period, ROUND(w.m, 6) AS value_mean, COALESCE(w.n, 0) AS value_count
FROM s LEFT JOIN w ON s.user_id = w.user_id AND s.period = w.period""", "T")
def g11k(spark, sf):
    r = W.resample(_ev(spark, sf), KEYS, "ts", "W", {"value": ["mean", "count"]})
    return r.select("user_id", F.col("period").cast("timestamp_ntz").alias("period"),
                    rnd("value_mean", 6).alias("value_mean"), "value_count")


@query("g12_resample_monthly", """
WITH m AS (SELECT last_day(o_orderdate) AS period, AVG(o_totalprice) AS v FROM orders GROUP BY 1),
b AS (SELECT date_trunc('month', MIN(period)) AS lo, date_trunc('month', MAX(period)) AS hi FROM m),
s AS (SELECT last_day(unnest(generate_series(lo, hi, INTERVAL 1 MONTH))) AS period FROM b)
SELECT CAST(s.period AS TIMESTAMP) AS period, ROUND(m.v, 4) AS price_mean FROM s LEFT JOIN m ON s.period = m.period""", "T")
def g12(spark, sf):
    r = W.resample(T(spark, sf, "orders").withColumnRenamed("o_totalprice", "price"), [], "o_orderdate", "M",
                   {"price": ["mean"]})
    return r.select(F.col("period").cast("timestamp_ntz").alias("period"), rnd("price_mean", 4).alias("price_mean"))


@query("g00_positions_unkeyed", """SELECT event_id, ROW_NUMBER() OVER (ORDER BY ts, event_id) - 1 AS pos FROM events""")
def g00(spark, sf):
    """The scalable row index itself (section 4.3 item 2) over one unkeyed series."""
    return positions(T(spark, sf, "events"), [], ["ts", "event_id"], "pos").select("event_id", "pos")

"""Flagship query: the heart of the forecast workflow on the order stream.

orders -> daily revenue (F1) -> calendar spine, empty days 0 (A7) -> lags 1/7/30
(G3) -> 7-day time-range mean (G8) -> month-demeaned revenue (G2) -> rows without
a full lag history dropped (D1).
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowframe.operators import windows as W
from flowframe.operators.order import join_on_keys
from flowframe.plans.registry import query, rnd
from flowframe.sources.io import table


def daily_revenue_features(orders: DataFrame) -> DataFrame:
    daily = (orders.groupBy(F.to_date("o_orderdate").alias("day"))
                   .agg(F.sum("o_totalprice").alias("_rev")))
    spine = W.calendar_spine_from(daily, [], "day", "D")
    s = (join_on_keys(spine, daily, ["day"], "left")
         .select("day", F.coalesce("_rev", F.lit(0.0)).alias("revenue")))
    s = W.lags(s, [], "day", "revenue", [1, 7, 30], ["lag_1", "lag_7", "lag_30"])
    s = W.rolling_time(s, [], "day", "revenue", 7, stats=("mean",), prefix="roll7d")
    s = W.group_demean(s.withColumn("_month", F.trunc("day", "MM")), ["_month"],
                       "revenue", "month_demeaned").drop("_month")
    s = s.dropna(subset=["lag_30"])
    return s.select(
        F.col("day").cast("timestamp_ntz").alias("day"), rnd("revenue", 2).alias("revenue"), rnd("lag_1", 2).alias("lag_1"),
        rnd("lag_7", 2).alias("lag_7"), rnd("lag_30", 2).alias("lag_30"),
        rnd("roll7d_mean", 4).alias("roll7d_mean"),
        rnd("month_demeaned", 4).alias("month_demeaned"))


FLAGSHIP_SQL = """
WITH daily AS (
  SELECT CAST(o_orderdate AS DATE) AS day, SUM(o_totalprice) AS rev FROM orders GROUP BY 1),
b AS (SELECT MIN(day) AS lo, MAX(day) AS hi FROM daily),
spine AS (SELECT CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS day FROM b),
s AS (SELECT spine.day, COALESCE(daily.rev, 0.0) AS revenue FROM spine LEFT JOIN daily ON spine.day = daily.day),
f AS (
  SELECT day, revenue,
    LAG(revenue, 1) OVER (ORDER BY day) AS lag_1,
    LAG(revenue, 7) OVER (ORDER BY day) AS lag_7,
    LAG(revenue, 30) OVER (ORDER BY day) AS lag_30,
    AVG(revenue) OVER (ORDER BY day RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW) AS roll7d_mean,
    revenue - AVG(revenue) OVER (PARTITION BY date_trunc('month', day)) AS month_demeaned
  FROM s)
SELECT CAST(day AS TIMESTAMP) AS day, ROUND(revenue, 2) AS revenue, ROUND(lag_1, 2) AS lag_1, ROUND(lag_7, 2) AS lag_7,
  ROUND(lag_30, 2) AS lag_30, ROUND(roll7d_mean, 4) AS roll7d_mean,
  ROUND(month_demeaned, 4) AS month_demeaned
FROM f WHERE lag_30 IS NOT NULL
"""


@query("x00_daily_revenue_features", FLAGSHIP_SQL, "T")
def q_flagship(spark: SparkSession, sf: str) -> DataFrame:
    return daily_revenue_features(table(spark, sf, "orders"))

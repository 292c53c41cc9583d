"""Catalog: the user-function surface."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowframe.operators import group as G
from flowframe.operators import windows as W
from flowframe.plans.q_table import EVENTS_NULLS, events_with_nulls
from flowframe.plans.registry import query, rnd
from flowframe.sources.io import table as T


@query("u01_group_transform_pandas", f"""SELECT event_id, user_id,
  ROUND((value - AVG(value) OVER (PARTITION BY user_id)) / STDDEV_SAMP(value) OVER (PARTITION BY user_id), 6) AS value_z
FROM {EVENTS_NULLS}""", "T")
def u01(spark, sf):
    """A z-score within each user: aggregate and join, no group in one task."""
    e = events_with_nulls(spark, sf).select("event_id", "user_id", "value")
    return W.group_zscore(e, ["user_id"], "value").select("event_id", "user_id", rnd("value_z", 6).alias("value_z"))


@query("u01_group_transform_fold", f"""SELECT event_id, user_id,
  ROUND((value - AVG(value) OVER (PARTITION BY user_id)) / STDDEV_SAMP(value) OVER (PARTITION BY user_id), 6) AS value_z
FROM {EVENTS_NULLS}""", "T")
def u01f(spark, sf):
    """The same by an opaque function in parts: count, mean and squared gaps of each batch, merged."""
    def update(state, rows):
        v = rows["value"].dropna()
        return merge(state, (len(v), v.mean(), ((v - v.mean()) ** 2).sum())) if len(v) else state

    def merge(a, b):
        n = a[0] + b[0]
        if not a[0] or not b[0]:
            return a if a[0] else b
        gap = b[1] - a[1]
        return n, a[1] + gap * b[0] / n, a[2] + b[2] + gap * gap * a[0] * b[0] / n

    def finish(state):
        n, mean, gaps = state
        return {"_m": mean if n else None, "_s": (gaps / (n - 1)) ** 0.5 if n > 1 else None}

    e = events_with_nulls(spark, sf).select("event_id", "user_id", "value")
    stats = G.group_fold(e, ["user_id"], lambda: (0, 0.0, 0.0), update, merge, finish, "_m double, _s double")
    z = F.try_divide(F.col("value") - F.col("_m"), F.col("_s"))
    return stats.select("event_id", "user_id", rnd(z, 6).alias("value_z"))


@query("u02_group_filter_pandas", """SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_custkey IN
  (SELECT o_custkey FROM orders GROUP BY 1 HAVING COUNT(*) >= 15)""")
def u02(spark, sf):
    """Rows of the customers with many orders: aggregate and semi join."""
    o = T(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return G.filter_groups(o, ["o_custkey"], min_rows=15)


def _rule(q: pd.Series, flag: pd.Series, disc: pd.Series) -> pd.Series:
    out = pd.Series("normal", index=q.index)
    out[disc >= 0.08] = "discounted"
    out[(q > 40) & (flag == "R")] = "big_return"
    return out


@query("u03_row_function_pandas_udf", """SELECT l_orderkey, l_linenumber,
  CASE WHEN l_quantity > 40 AND l_returnflag = 'R' THEN 'big_return' WHEN l_discount >= 0.08 THEN 'discounted'
  ELSE 'normal' END AS rule FROM lineitem""")
def u03(spark, sf):
    """``df.apply(complex_logic, axis=1)`` as an Arrow-batched pandas UDF."""
    rule = G.row_apply(_rule, "string")
    li = T(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", rule("l_quantity", "l_returnflag", "l_discount").alias("rule"))


def with_share(df: DataFrame, part: str, whole: str, name: str) -> DataFrame:
    return df.withColumn(name, rnd(F.try_divide(F.col(part), F.col(whole)), 6))


def at_least(df: DataFrame, **bounds: float) -> DataFrame:
    for c, low in bounds.items():
        df = df.where(F.col(c) >= F.lit(low))
    return df


@query("u04_pipe_chain", """SELECT s_suppkey, ROUND(s_acctbal / n, 6) AS balance_share FROM (
  SELECT *, SUM(GREATEST(s_acctbal, 0)) OVER (PARTITION BY s_nationkey) AS n FROM supplier)
WHERE n > 0 AND ROUND(s_acctbal / n, 6) >= 0.1""", "T")
def u04(spark, sf):
    """Table functions chained with ``DataFrame.transform``."""
    s = T(spark, sf, "supplier").select("s_suppkey", "s_nationkey", "s_acctbal")
    totals = s.groupBy("s_nationkey").agg(F.sum(F.greatest("s_acctbal", F.lit(0))).alias("n"))
    return (s.join(totals, "s_nationkey").where("n > 0").transform(with_share, "s_acctbal", "n", "balance_share")
             .transform(at_least, balance_share=0.1).select("s_suppkey", "balance_share"))

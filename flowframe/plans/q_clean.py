"""Catalog: cleaning (D), joins and combination (E), aggregation and reshaping (F)."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowframe.operators import clean as D
from flowframe.operators import combine as E
from flowframe.operators import group as G
from flowframe.operators.stats import quantiles
from flowframe.plans.q_table import EVENTS_NULLS, events_with_nulls
from flowframe.plans.registry import query, rnd
from flowframe.sources.io import table as T

# ---------------------------------------------------------------- D cleaning


@query("d01_dropna_subset", f"SELECT * FROM {EVENTS_NULLS} WHERE value IS NOT NULL AND props IS NOT NULL")
def d01(spark, sf):
    return D.dropna(events_with_nulls(spark, sf), ["value", "props"])


@query("d02_fillna_per_column", f"""SELECT event_id, ts, user_id, event_type, COALESCE(value, 0.0) AS value,
  COALESCE(props, '{{}}') AS props FROM {EVENTS_NULLS}""")
def d02(spark, sf):
    return D.fillna(events_with_nulls(spark, sf), {"value": 0.0, "props": "{}"})


@query("d03_impute_mean", f"""SELECT event_id, ROUND(COALESCE(value, (SELECT AVG(value) FROM {EVENTS_NULLS})), 6) AS value
FROM {EVENTS_NULLS}""", "T")
def d03(spark, sf):
    d = D.impute(events_with_nulls(spark, sf), ["value"], "mean")
    return d.select("event_id", rnd("value", 6).alias("value"))


@query("d03_impute_median", f"""SELECT event_id, ROUND(COALESCE(value, (SELECT quantile_cont(value, 0.5) FROM {EVENTS_NULLS})), 6) AS value
FROM {EVENTS_NULLS}""", "T")
def d03m(spark, sf):
    d = D.impute(events_with_nulls(spark, sf), ["value"], "median")
    return d.select("event_id", rnd("value", 6).alias("value"))


EVENT_TYPE_NULLS = "(SELECT event_id, CASE WHEN event_id % 6 = 0 THEN NULL ELSE event_type END AS event_type, user_id FROM events)"


@query("d03_impute_most_frequent", f"""
WITH e AS {EVENT_TYPE_NULLS},
m AS (SELECT event_type FROM e WHERE event_type IS NOT NULL GROUP BY 1 ORDER BY COUNT(*) DESC, event_type LIMIT 1)
SELECT event_id, COALESCE(e.event_type, (SELECT event_type FROM m)) AS event_type FROM e""")
def d03f(spark, sf):
    e = T(spark, sf, "events").select("event_id", F.when(F.col("event_id") % 6 != 0, F.col("event_type"))
                                      .alias("event_type"))
    return D.impute(e, ["event_type"], "most_frequent")


@query("d03_impute_group_mean", f"""SELECT event_id, user_id,
  ROUND(COALESCE(value, AVG(value) OVER (PARTITION BY user_id)), 6) AS value FROM {EVENTS_NULLS}""", "T")
def d03g(spark, sf):
    d = D.impute(events_with_nulls(spark, sf).select("event_id", "user_id", "value"), ["value"], "mean",
                 keys=["user_id"])
    return d.select("event_id", "user_id", rnd("value", 6).alias("value"))


@query("d04_ffill_bfill", f"""SELECT event_id, user_id,
  LAST_VALUE(value IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ffill,
  FIRST_VALUE(value IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS bfill
FROM {EVENTS_NULLS}""")
def d04(spark, sf):
    e = events_with_nulls(spark, sf).select("event_id", "user_id", "ts", "value")
    e = e.withColumns({"ffill": F.col("value"), "bfill": F.col("value")})
    e = D.fill_both(e, ["user_id"], ["ts"], ["ffill"], ["bfill"])
    return e.select("event_id", "user_id", "ffill", "bfill")


@query("d05_interpolate_linear", f"""
WITH e AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts) AS p FROM {EVENTS_NULLS}),
n AS (SELECT *,
  LAST_VALUE(CASE WHEN value IS NOT NULL THEN p END IGNORE NULLS) OVER w1 AS pp,
  LAST_VALUE(value IGNORE NULLS) OVER w1 AS pv,
  FIRST_VALUE(CASE WHEN value IS NOT NULL THEN p END IGNORE NULLS) OVER w2 AS np,
  FIRST_VALUE(value IGNORE NULLS) OVER w2 AS nv
  FROM e WINDOW w1 AS (PARTITION BY user_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                w2 AS (PARTITION BY user_id ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT event_id, user_id, ROUND(CASE WHEN value IS NOT NULL THEN value WHEN pp IS NULL THEN NULL
  WHEN np IS NULL THEN pv ELSE pv + (nv - pv) * (p - pp) / (np - pp) END, 6) AS value FROM n""", "T")
def d05(spark, sf):
    e = events_with_nulls(spark, sf).select("event_id", "user_id", "ts", "value")
    e = D.interpolate(e, ["user_id"], ["ts"], "value")
    return e.select("event_id", "user_id", rnd("value", 6).alias("value"))


@query("d06_drop_duplicates_keep_first", """SELECT * FROM lineitem
QUALIFY ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey, l_suppkey) = 1""")
def d06(spark, sf):
    return D.drop_duplicates(T(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"],
                             ["l_shipdate", "l_partkey", "l_suppkey"])


@query("d07_astype", """SELECT l_orderkey, CAST(l_linenumber AS DOUBLE) AS l_linenumber,
  CAST(l_returnflag = 'R' AS INTEGER) AS is_returned, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS l_shipdate
FROM lineitem""")
def d07(spark, sf):
    li = T(spark, sf, "lineitem").select("l_orderkey", "l_linenumber",
                                         (F.col("l_returnflag") == "R").alias("is_returned"), "l_shipdate")
    return D.cast_columns(li, {"l_linenumber": "double", "is_returned": "int", "l_shipdate": "string"})


@query("d08_to_numeric_coerce", """SELECT event_id,
  TRY_CAST(CASE WHEN event_id % 3 = 0 THEN props WHEN event_id % 3 = 1 THEN '1,' || CAST(user_id AS VARCHAR)
           ELSE CAST(user_id AS VARCHAR) || '.5' END AS DOUBLE) AS num FROM events""")
def d08(spark, sf):
    e = T(spark, sf, "events")
    s = (F.when(F.col("event_id") % 3 == 0, F.col("props"))
          .when(F.col("event_id") % 3 == 1, F.concat(F.lit("1,"), F.col("user_id").cast("string")))
          .otherwise(F.concat(F.col("user_id").cast("string"), F.lit(".5"))))
    return e.select("event_id", D.to_numeric(s).alias("num"))


@query("d09_to_datetime", """SELECT o_orderkey,
  TRY_CAST(CASE WHEN o_orderkey % 10 = 0 THEN 'not a date' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS TIMESTAMP) AS parsed
FROM orders""")
def d09(spark, sf):
    o = T(spark, sf, "orders")
    s = F.when(F.col("o_orderkey") % 10 == 0, F.lit("not a date")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return o.select("o_orderkey", D.to_datetime(s).alias("parsed"))


@query("d10_category_codes", """
WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 8 = 0 THEN NULL ELSE o_orderpriority END AS pr FROM orders),
l AS (SELECT pr, CAST(ROW_NUMBER() OVER (ORDER BY pr) - 1 AS INTEGER) AS code FROM (SELECT DISTINCT pr FROM o WHERE pr IS NOT NULL))
SELECT o.o_orderkey, o.pr, COALESCE(l.code, -1) AS pr_code FROM o LEFT JOIN l ON o.pr = l.pr""")
def d10(spark, sf):
    o = T(spark, sf, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 8 != 0, F.col("o_orderpriority"))
                                      .alias("pr"))
    return D.category_codes(o, "pr", "pr_code")


PART_OUTLIER = "(SELECT p_partkey, CASE WHEN p_partkey = 0 THEN 10 * p_retailprice ELSE p_retailprice END AS price FROM part)"


def part_outlier(spark, sf):
    p = T(spark, sf, "part")
    return p.select("p_partkey", F.when(F.col("p_partkey") == 0, 10 * F.col("p_retailprice"))
                    .otherwise(F.col("p_retailprice")).alias("price"))


@query("d11_clip_at_quantile", f"""SELECT p_partkey, ROUND(LEAST(price, (SELECT quantile_cont(price, 0.99) FROM {PART_OUTLIER})), 6) AS price
FROM {PART_OUTLIER}""", "T")
def d11(spark, sf):
    d = D.cap_outliers(part_outlier(spark, sf), "price", 0.99)
    return d.select("p_partkey", rnd("price", 6).alias("price"))


@query("d14_cut_equal_width", f"""
WITH b AS (SELECT MIN(price) AS lo, MAX(price) AS hi FROM {PART_OUTLIER})
SELECT p_partkey, CASE WHEN price <= lo + (hi - lo) * {1 / 3!r} THEN 'low' WHEN price <= lo + (hi - lo) * {2 / 3!r} THEN 'mid'
  WHEN price <= hi THEN 'high' END AS price_bin FROM {PART_OUTLIER}, b""")
def d14(spark, sf):
    return D.cut(part_outlier(spark, sf), "price", 3, ["low", "mid", "high"], "price_bin").drop("price")


@query("d15_qcut_quartiles", """
WITH q AS (SELECT quantile_cont(o_totalprice, 0.25) AS q1, quantile_cont(o_totalprice, 0.5) AS q2,
  quantile_cont(o_totalprice, 0.75) AS q3 FROM orders)
SELECT o_orderkey, CASE WHEN o_totalprice <= q1 THEN 'Q1' WHEN o_totalprice <= q2 THEN 'Q2'
  WHEN o_totalprice <= q3 THEN 'Q3' ELSE 'Q4' END AS price_q FROM orders, q""")
def d15(spark, sf):
    o = T(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return D.qcut(o, "o_totalprice", 4, ["Q1", "Q2", "Q3", "Q4"], "price_q").drop("o_totalprice")


# ---------------------------------------------------------------- E joins


@query("e01_merge_left_dimension", """SELECT c.c_custkey, c.c_name, c.c_nationkey, n.n_name, n.n_regionkey
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey""")
def e01(spark, sf):
    nat = T(spark, sf, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    c = T(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey")
    return E.merge_left(c, nat, ["c_nationkey"])


@query("e02_merge_asof_backward", """
WITH l AS (SELECT event_id, user_id, ts, value FROM events WHERE event_type = 'purchase'),
r AS (SELECT user_id, ts AS view_ts, event_id AS view_event_id, value AS view_value FROM events WHERE event_type = 'view')
SELECT l.event_id, l.user_id, l.ts, l.value, r.view_ts, r.view_event_id, r.view_value
FROM l ASOF LEFT JOIN r ON l.user_id = r.user_id AND l.ts >= r.view_ts""")
def e02(spark, sf):
    ev = T(spark, sf, "events")
    left = ev.where("event_type = 'purchase'").select("event_id", "user_id", "ts", "value")
    right = ev.where("event_type = 'view'").select("user_id", F.col("ts").alias("view_ts"),
                                                  F.col("event_id").alias("view_event_id"),
                                                  F.col("value").alias("view_value"))
    out = E.merge_asof(left, right, on="ts", right_on="view_ts", by="user_id", right_order="view_event_id")
    return out.select("event_id", "user_id", "ts", "value", "view_ts", "view_event_id", "view_value")


@query("e02_merge_asof_monthly", """
WITH d AS (SELECT CAST(o_orderdate AS DATE) AS day, SUM(o_totalprice) AS revenue FROM orders GROUP BY 1),
m AS (SELECT CAST(m AS DATE) AS month_start, ROUND(month(m) / 12.0, 6) AS gdp_growth FROM
      (SELECT unnest(generate_series(date_trunc('month', MIN(o_orderdate)), date_trunc('month', MAX(o_orderdate)), INTERVAL 1 MONTH)) AS m FROM orders))
SELECT CAST(d.day AS TIMESTAMP) AS day, ROUND(d.revenue, 2) AS revenue, m.gdp_growth
FROM d ASOF LEFT JOIN m ON d.day >= m.month_start""")
def e02m(spark, sf):
    from flowframe.sources import io
    o = T(spark, sf, "orders")
    d = o.groupBy(F.to_date("o_orderdate").alias("day")).agg(F.sum("o_totalprice").alias("revenue"))
    m = io.spine_of(o, "o_orderdate", "MS", "month_start").withColumn(
        "gdp_growth", rnd(F.month("month_start") / 12.0, 6))
    out = E.merge_asof(d, m, on="day", right_on="month_start")
    return out.select(F.col("day").cast("timestamp_ntz").alias("day"), rnd("revenue", 2).alias("revenue"),
                      "gdp_growth")


@query("e03_join_with_suffixes", """
WITH a AS (SELECT c_nationkey AS nationkey, COUNT(*) AS n, ROUND(SUM(c_acctbal), 2) AS bal FROM customer GROUP BY 1),
b AS (SELECT s_nationkey AS nationkey, COUNT(*) AS n, ROUND(SUM(s_acctbal), 2) AS bal FROM supplier GROUP BY 1)
SELECT a.nationkey, a.n AS n_cust, a.bal AS bal_cust, b.n AS n_supp, b.bal AS bal_supp FROM a LEFT JOIN b ON a.nationkey = b.nationkey""", "T")
def e03(spark, sf):
    a = T(spark, sf, "customer").groupBy(F.col("c_nationkey").alias("nationkey")).agg(
        F.count(F.lit(1)).alias("n"), rnd(F.sum("c_acctbal"), 2).alias("bal"))
    b = T(spark, sf, "supplier").groupBy(F.col("s_nationkey").alias("nationkey")).agg(
        F.count(F.lit(1)).alias("n"), rnd(F.sum("s_acctbal"), 2).alias("bal"))
    return E.join_suffix(a, b, ["nationkey"], "_cust", "_supp")


@query("e04_concat_columns_by_position", """
WITH a AS (SELECT c_name, ROW_NUMBER() OVER (ORDER BY c_custkey) AS p FROM customer),
b AS (SELECT s_name, ROW_NUMBER() OVER (ORDER BY s_suppkey) AS p FROM supplier)
SELECT a.c_name, b.s_name FROM a FULL JOIN b ON a.p = b.p""")
def e04(spark, sf):
    a = T(spark, sf, "customer").select("c_name", "c_custkey")
    b = T(spark, sf, "supplier").select("s_name", "s_suppkey")
    return E.concat_columns(a, b, ["c_custkey"], ["s_suppkey"]).select("c_name", "s_name")


@query("e05_combine_first", """
WITH a AS (SELECT c_custkey AS custkey, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_acctbal END AS balance FROM customer),
b AS (SELECT o_custkey AS custkey, ROUND(AVG(o_totalprice), 6) AS balance, COUNT(*) AS n_orders FROM orders GROUP BY 1)
SELECT COALESCE(a.custkey, b.custkey) AS custkey, COALESCE(a.balance, b.balance) AS balance, b.n_orders
FROM a FULL JOIN b ON a.custkey = b.custkey""")
def e05(spark, sf):
    a = T(spark, sf, "customer").select(F.col("c_custkey").alias("custkey"),
                                        F.when(F.col("c_custkey") % 7 != 0, F.col("c_acctbal")).alias("balance"))
    b = T(spark, sf, "orders").groupBy(F.col("o_custkey").alias("custkey")).agg(
        rnd(F.avg("o_totalprice"), 6).alias("balance"), F.count(F.lit(1)).alias("n_orders"))
    return E.combine_first(a, b, ["custkey"])


@query("e06_union_by_name", """
SELECT o_orderkey, o_totalprice, CAST(NULL AS VARCHAR) AS o_orderpriority FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT o_orderkey, CAST(NULL AS DOUBLE), o_orderpriority FROM orders WHERE o_orderstatus <> 'F'""")
def e06(spark, sf):
    o = T(spark, sf, "orders")
    return E.union_by_name([o.where("o_orderstatus = 'F'").select("o_orderkey", "o_totalprice"),
                            o.where("o_orderstatus <> 'F'").select("o_orderpriority", "o_orderkey")])


# ---------------------------------------------------------------- F aggregation

LINE_NULLKEY = """(SELECT CASE WHEN l_orderkey % 13 = 0 THEN NULL ELSE l_returnflag END AS l_returnflag,
  l_linestatus, l_quantity, l_extendedprice FROM lineitem)"""


def line_nullkey(spark, sf):
    li = T(spark, sf, "lineitem")
    return li.select(F.when(F.col("l_orderkey") % 13 != 0, F.col("l_returnflag")).alias("l_returnflag"),
                     "l_linestatus", "l_quantity", "l_extendedprice")


@query("f01_groupby_mean", f"""SELECT l_returnflag, ROUND(AVG(l_quantity), 6) AS l_quantity_mean
FROM {LINE_NULLKEY} WHERE l_returnflag IS NOT NULL GROUP BY 1""", "T")
def f01(spark, sf):
    g = G.agg(line_nullkey(spark, sf), ["l_returnflag"], {"l_quantity": "mean"})
    return g.withColumn("l_quantity_mean", rnd("l_quantity_mean", 6))


@query("f02_groupby_multi_agg", """SELECT l_returnflag, l_linestatus, ROUND(AVG(l_quantity), 6) AS l_quantity_mean,
  ROUND(STDDEV_SAMP(l_quantity), 6) AS l_quantity_std, MIN(l_quantity) AS l_quantity_min, MAX(l_quantity) AS l_quantity_max,
  ROUND(SUM(l_extendedprice), 2) AS l_extendedprice_sum FROM lineitem GROUP BY 1, 2""", "T")
def f02(spark, sf):
    g = G.agg(T(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"],
              {"l_quantity": ["mean", "std", "min", "max"], "l_extendedprice": "sum"})
    return g.withColumns({"l_quantity_mean": rnd("l_quantity_mean", 6),
                          "l_quantity_std": rnd("l_quantity_std", 6),
                          "l_extendedprice_sum": rnd("l_extendedprice_sum", 2)})


@query("f03_named_agg", """SELECT o_orderpriority, ROUND(AVG(o_totalprice), 4) AS avg_price, COUNT(o_orderkey) AS n_orders,
  MAX(o_totalprice) AS max_price FROM orders GROUP BY 1""", "T")
def f03(spark, sf):
    g = G.named_agg(T(spark, sf, "orders"), ["o_orderpriority"], avg_price=("o_totalprice", "mean"),
                    n_orders=("o_orderkey", "count"), max_price=("o_totalprice", "max"))
    return g.withColumn("avg_price", rnd("avg_price", 4))


@query("f04_filter_groups", """SELECT * FROM orders WHERE o_custkey IN
  (SELECT o_custkey FROM orders GROUP BY 1 HAVING COUNT(*) >= 15)""")
def f04(spark, sf):
    return G.filter_groups(T(spark, sf, "orders"), ["o_custkey"], min_rows=15)


@query("f05_quantiles", """SELECT ROUND(quantile_cont(l_extendedprice, 0.1), 6) AS q10,
  ROUND(quantile_cont(l_extendedprice, 0.5), 6) AS q50, ROUND(quantile_cont(l_extendedprice, 0.9), 6) AS q90 FROM lineitem""", "T")
def f05(spark, sf):
    q = quantiles(T(spark, sf, "lineitem"), "l_extendedprice", [0.1, 0.5, 0.9], names=["q10", "q50", "q90"])
    return q.select(*[rnd(c, 6).alias(c) for c in ("q10", "q50", "q90")])


@query("f05_quantiles_by_group", """SELECT l_suppkey, ROUND(quantile_cont(l_quantity, 0.25), 6) AS q25,
  ROUND(quantile_cont(l_quantity, 0.75), 6) AS q75 FROM lineitem GROUP BY 1""", "T")
def f05g(spark, sf):
    q = quantiles(T(spark, sf, "lineitem"), "l_quantity", [0.25, 0.75], ["l_suppkey"], ["q25", "q75"])
    return q.select("l_suppkey", rnd("q25", 6).alias("q25"), rnd("q75", 6).alias("q75"))


@query("f06_pivot_table_mean", """SELECT l_returnflag, ROUND(AVG(CASE WHEN l_linestatus = 'F' THEN l_quantity END), 6) AS F,
  ROUND(AVG(CASE WHEN l_linestatus = 'O' THEN l_quantity END), 6) AS O FROM lineitem GROUP BY 1""", "T")
def f06(spark, sf):
    p = G.pivot_table(T(spark, sf, "lineitem"), ["l_returnflag"], "l_linestatus", "l_quantity", "mean", ["F", "O"])
    return p.select("l_returnflag", rnd("F", 6).alias("F"), rnd("O", 6).alias("O"))


PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query("f07_crosstab", "SELECT o_orderstatus, " + ", ".join(
    f"COUNT(*) FILTER (WHERE o_orderpriority = '{p}') AS \"{p}\"" for p in PRIORITIES) + " FROM orders GROUP BY 1")
def f07(spark, sf):
    return G.crosstab(T(spark, sf, "orders"), "o_orderstatus", "o_orderpriority", PRIORITIES)


@query("f08_melt", """SELECT p_partkey, 'p_size' AS variable, CAST(p_size AS DOUBLE) AS value FROM part
UNION ALL SELECT p_partkey, 'p_retailprice', CASE WHEN p_partkey % 9 = 0 THEN NULL ELSE p_retailprice END FROM part""")
def f08(spark, sf):
    p = T(spark, sf, "part").select("p_partkey", F.col("p_size").cast("double").alias("p_size"),
                                    F.when(F.col("p_partkey") % 9 != 0, F.col("p_retailprice")).alias("p_retailprice"))
    return G.melt(p, ["p_partkey"], ["p_size", "p_retailprice"])


@query("f09_stack_drop_missing", """SELECT p_partkey, 'p_size' AS variable, CAST(p_size AS DOUBLE) AS value FROM part
UNION ALL SELECT p_partkey, 'p_retailprice', p_retailprice FROM part WHERE p_partkey % 9 <> 0""")
def f09(spark, sf):
    p = T(spark, sf, "part").select("p_partkey", F.col("p_size").cast("double").alias("p_size"),
                                    F.when(F.col("p_partkey") % 9 != 0, F.col("p_retailprice")).alias("p_retailprice"))
    return G.stack(p, ["p_partkey"], ["p_size", "p_retailprice"])


@query("f09_unstack", """SELECT c_nationkey, """ + ", ".join(
    f"ROUND(SUM(c_acctbal) FILTER (WHERE c_mktsegment = '{s}'), 2) AS {s}"
    for s in ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]) + " FROM customer GROUP BY 1", "T")
def f09u(spark, sf):
    segs = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
    long = T(spark, sf, "customer").groupBy("c_nationkey", "c_mktsegment").agg(
        rnd(F.sum("c_acctbal"), 2).alias("bal"))
    return G.unstack(long, ["c_nationkey"], "c_mktsegment", "bal", segs)


@query("f10_explode_keep_empty", """SELECT vec_id, UNNEST(CASE WHEN vec_id % 50 = 0 THEN [NULL::FLOAT] ELSE embedding END) AS x
FROM embeddings""")
def f10(spark, sf):
    e = T(spark, sf, "embeddings").select(
        "vec_id", F.when(F.col("vec_id") % 50 == 0, F.array().cast("array<float>"))
        .otherwise(F.col("embedding")).alias("x"))
    return G.explode_list(e, "x")

"""Catalog: sources (A), profiling (B), selection (C), sort and top-k (H)."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from flowframe.operators import profile as P
from flowframe.operators import select as S
from flowframe.operators import sort as H
from flowframe.plans.registry import query, rnd
from flowframe.sources import io
from flowframe.sources.io import table as T

LINE_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def events_with_nulls(spark, sf):
    """FIXTURES rule: NULL injection by the same expression on both sides."""
    return T(spark, sf, "events").withColumns({
        "value": F.when(F.col("event_id") % 5 != 0, F.col("value")),
        "props": F.when(F.col("event_id") % 7 != 0, F.col("props")),
    })


EVENTS_NULLS = """(SELECT event_id, ts, user_id, event_type,
  CASE WHEN event_id % 5 = 0 THEN NULL ELSE value END AS value,
  CASE WHEN event_id % 7 = 0 THEN NULL ELSE props END AS props FROM events)"""


# ---------------------------------------------------------------- A sources / sinks

@query("a01_csv_scan", """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
  o_orderpriority FROM orders""")
def a01(spark: SparkSession, sf: str):
    path = io.write_csv(T(spark, sf, "orders"), io.scratch_path(spark, "a01"))
    schema = ("o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate STRING, o_orderpriority STRING")
    return io.read_csv(spark, path, schema=schema, parse_dates=["o_orderdate"])


@query("a02_csv_dir_by_name", """
SELECT o_orderkey, o_custkey, o_totalprice, CAST(NULL AS VARCHAR) AS o_orderstatus FROM orders WHERE o_orderstatus = 'F'
UNION ALL
SELECT o_orderkey, CAST(NULL AS BIGINT) AS o_custkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderstatus <> 'F'""")
def a02(spark, sf):
    o = T(spark, sf, "orders")
    base = io.scratch_path(spark, "a02")
    # two file groups whose headers differ in order and in columns
    o.where("o_orderstatus = 'F'").select("o_orderkey", "o_custkey", "o_totalprice") \
        .write.option("header", True).csv(f"{base}/first")
    o.where("o_orderstatus <> 'F'").select("o_totalprice", "o_orderstatus", "o_orderkey") \
        .write.option("header", True).csv(f"{base}/second")
    d = io.load_csv_dir(spark, base, "*.csv")
    return d.select(F.col("o_orderkey").cast("bigint").alias("o_orderkey"),
                    F.col("o_custkey").cast("bigint").alias("o_custkey"),
                    F.col("o_totalprice").cast("double").alias("o_totalprice"), "o_orderstatus")


@query("a03_csv_sink_forecast", """
WITH d AS (SELECT CAST(o_orderdate AS DATE) AS day, SUM(o_totalprice) AS v FROM orders GROUP BY 1)
SELECT CAST(day AS TIMESTAMP) AS date, ROUND(v, 2) AS actual,
  ROUND(LAG(v) OVER (ORDER BY day), 2) AS predicted FROM d""", "T")
def a03(spark, sf):
    from flowframe.operators import windows as W
    d = (T(spark, sf, "orders").groupBy(F.to_date("o_orderdate").alias("day"))
         .agg(F.sum("o_totalprice").alias("v")))
    d = W.lags(d, [], "day", "v", [1], ["p"])
    res = d.select(F.col("day").cast("timestamp_ntz").alias("date"),
                   rnd("v", 2).alias("actual"), rnd("p", 2).alias("predicted"))
    path = io.write_csv(res, io.scratch_path(spark, "a03"))
    return io.read_csv(spark, path, schema="date TIMESTAMP_NTZ, actual DOUBLE, predicted DOUBLE")


@query("a04_json_sink", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def a04(spark, sf):
    c = T(spark, sf, "customer")
    path = io.write_json(c, io.scratch_path(spark, "a04"))
    return io.read_json(spark, path, schema=c.schema)


@query("a05_json_records_scan", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def a05(spark, sf):
    c = T(spark, sf, "customer")
    path = io.write_json_records(c, io.scratch_path(spark, "a05"), rows_per_file=500)
    schema = StructType(c.schema.fields + [StructField("_chunk", IntegerType())])
    return io.read_json(spark, path, schema=schema, multiline=True)


@query("a06_parquet_roundtrip", """SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice,
  l_returnflag, l_shipdate FROM lineitem""")
def a06(spark, sf):
    li = T(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice",
                                         "l_returnflag", "l_shipdate")
    path = io.write_parquet(li, io.scratch_path(spark, "a06"), partition_by=["l_returnflag"])
    return io.read_parquet(spark, path).select(*li.columns)


@query("a07_month_start_spine", """
WITH b AS (SELECT date_trunc('month', MIN(o_orderdate)) AS lo, date_trunc('month', MAX(o_orderdate)) AS hi FROM orders)
SELECT CAST(m AS TIMESTAMP) AS month_start, CAST(year(m) * 100 + month(m) AS INTEGER) AS yyyymm,
  ROUND(month(m) / 12.0, 6) AS gdp_growth
FROM (SELECT unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS m FROM b)""", "T")
def a07(spark, sf):
    s = io.spine_of(T(spark, sf, "orders"), "o_orderdate", "MS", "m")
    return s.select(F.col("m").cast("timestamp_ntz").alias("month_start"),
                    (F.year("m") * 100 + F.month("m")).cast("int").alias("yyyymm"),
                    rnd(F.month("m") / 12.0, 6).alias("gdp_growth"))


STATUS_DIM = [("F", "finished", 1), ("O", "open", 2), ("P", "pending", 3)]


@query("a08_inline_dimension", """
WITH dim(o_orderstatus, status_name, priority) AS (VALUES ('F', 'finished', 1), ('O', 'open', 2), ('P', 'pending', 3))
SELECT o.o_orderstatus, d.status_name, CAST(d.priority AS INTEGER) AS priority, COUNT(*) AS n_orders
FROM orders o LEFT JOIN dim d ON o.o_orderstatus = d.o_orderstatus GROUP BY ALL""")
def a08(spark, sf):
    dim = io.small_table(spark, STATUS_DIM, "o_orderstatus STRING, status_name STRING, priority INT")
    o = T(spark, sf, "orders")
    j = o.join(dim, "o_orderstatus", "left")
    return j.groupBy("o_orderstatus", "status_name", "priority").agg(F.count(F.lit(1)).alias("n_orders"))


# ---------------------------------------------------------------- B profiling

def _profile_sql():
    cols = [("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"),
            ("l_linenumber", "int"), ("l_quantity", "double"), ("l_extendedprice", "double"),
            ("l_discount", "double"), ("l_tax", "double"), ("l_returnflag", "string"),
            ("l_linestatus", "string"), ("l_shipdate", "timestamp_ntz")]
    parts = [f"SELECT CAST({i} AS INTEGER) AS position, '{c}' AS column, '{t}' AS dtype, "
             f"COUNT({c}) AS non_null, COUNT(*) AS n_rows FROM lineitem" for i, (c, t) in enumerate(cols)]
    return "\nUNION ALL\n".join(parts)


@query("b01_table_profile", _profile_sql())
def b01(spark, sf):
    return P.table_profile(T(spark, sf, "lineitem"))


def _describe_sql():
    parts = []
    for c in LINE_NUM:
        parts.append(f"""SELECT '{c}' AS column, COUNT({c}) AS count, ROUND(AVG({c}), 6) AS mean,
  ROUND(STDDEV_SAMP({c}), 6) AS std, ROUND(MIN({c}), 6) AS min, ROUND(quantile_cont({c}, 0.1), 6) AS p10,
  ROUND(quantile_cont({c}, 0.5), 6) AS p50, ROUND(quantile_cont({c}, 0.9), 6) AS p90,
  ROUND(MAX({c}), 6) AS max FROM lineitem""")
    return "\nUNION ALL\n".join(parts)


@query("b02_describe_numeric", _describe_sql(), "T")
def b02(spark, sf):
    d = P.describe(T(spark, sf, "lineitem"), LINE_NUM, [0.1, 0.5, 0.9])
    return d.select("column", "count", *[rnd(c, 6).alias(c) for c in
                                          ("mean", "std", "min", "p10", "p50", "p90", "max")])


def _describe_cat_sql(cols):
    parts = []
    for t, c in cols:
        parts.append(f"""(WITH vc AS (SELECT {c} AS v, COUNT(*) AS f FROM {t} WHERE {c} IS NOT NULL GROUP BY 1)
SELECT '{c}' AS column, CAST(SUM(f) AS BIGINT) AS count, COUNT(*) AS unique,
  (SELECT CAST(v AS VARCHAR) FROM vc ORDER BY f DESC, v ASC LIMIT 1) AS top, MAX(f) AS freq FROM vc)""")
    return "\nUNION ALL\n".join(parts)


@query("b03_describe_categorical", _describe_cat_sql([("orders", "o_orderstatus"), ("orders", "o_orderpriority")]))
def b03(spark, sf):
    return P.describe_categorical(T(spark, sf, "orders"), ["o_orderstatus", "o_orderpriority"])


@query("b04_nunique", """SELECT COUNT(DISTINCT l_returnflag) AS l_returnflag, COUNT(DISTINCT l_suppkey) AS l_suppkey,
  COUNT(DISTINCT l_partkey) AS l_partkey FROM lineitem""")
def b04(spark, sf):
    return P.nunique(T(spark, sf, "lineitem"), ["l_returnflag", "l_suppkey", "l_partkey"])


@query("b04_unique_values", "SELECT DISTINCT o_orderpriority FROM orders")
def b04u(spark, sf):
    return P.distinct_values(T(spark, sf, "orders"), "o_orderpriority")


@query("b05_value_counts_normalized", f"""
WITH e AS (SELECT CASE WHEN event_id % 9 = 0 THEN NULL ELSE event_type END AS event_type FROM events)
SELECT event_type, COUNT(*) AS count, ROUND(COUNT(*) / (SELECT COUNT(*) FROM e WHERE event_type IS NOT NULL), 6) AS proportion
FROM e WHERE event_type IS NOT NULL GROUP BY 1""", "T")
def b05(spark, sf):
    e = T(spark, sf, "events").withColumn("event_type", F.when(F.col("event_id") % 9 != 0, F.col("event_type")))
    vc = P.value_counts(e, "event_type", normalize=True)
    return vc.withColumn("proportion", rnd("proportion", 6))


@query("b06_missing_counts", f"""
SELECT 'event_id' AS column, COUNT(*) - COUNT(event_id) AS missing FROM {EVENTS_NULLS}
UNION ALL SELECT 'ts', COUNT(*) - COUNT(ts) FROM {EVENTS_NULLS}
UNION ALL SELECT 'user_id', COUNT(*) - COUNT(user_id) FROM {EVENTS_NULLS}
UNION ALL SELECT 'event_type', COUNT(*) - COUNT(event_type) FROM {EVENTS_NULLS}
UNION ALL SELECT 'value', COUNT(*) - COUNT(value) FROM {EVENTS_NULLS}
UNION ALL SELECT 'props', COUNT(*) - COUNT(props) FROM {EVENTS_NULLS}""")
def b06(spark, sf):
    return P.missing_counts(events_with_nulls(spark, sf))


def _corr_sql():
    parts = [f"SELECT '{a}' AS a, '{b}' AS b, ROUND(CORR({a}, {b}), 6) AS r FROM lineitem"
             for a in LINE_NUM for b in LINE_NUM]
    return "\nUNION ALL\n".join(parts)


@query("b07_corr_matrix", _corr_sql(), "T")
def b07(spark, sf):
    return P.corr_matrix(T(spark, sf, "lineitem"), LINE_NUM).withColumn("r", rnd("r", 6))


@query("b08_histogram_20", """
WITH b AS (SELECT MIN(p_retailprice) AS lo, MAX(p_retailprice) AS hi FROM part),
c AS (SELECT CAST(LEAST(FLOOR((p_retailprice - lo) / (hi - lo) * 20) + 1, 20) AS INTEGER) AS bin, COUNT(*) AS n
      FROM part, b GROUP BY 1),
s AS (SELECT CAST(i AS INTEGER) AS bin FROM range(1, 21) t(i))
SELECT s.bin, ROUND(lo + (s.bin - 1) * (hi - lo) / 20, 6) AS lo, ROUND(lo + s.bin * (hi - lo) / 20, 6) AS hi,
  COALESCE(c.n, 0) AS count FROM s CROSS JOIN b LEFT JOIN c ON s.bin = c.bin""", "T")
def b08(spark, sf):
    h = P.histogram(T(spark, sf, "part"), "p_retailprice", 20)
    return h.select("bin", rnd("lo", 6).alias("lo"), rnd("hi", 6).alias("hi"), "count")


@query("b09_box_stats_by_group", """
WITH q AS (SELECT l_returnflag, quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.5) AS median,
  quantile_cont(l_extendedprice, 0.75) AS q3 FROM lineitem GROUP BY 1),
f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lf, q3 + 1.5 * (q3 - q1) AS uf FROM q)
SELECT l.l_returnflag, ROUND(f.q1, 6) AS q1, ROUND(f.median, 6) AS median, ROUND(f.q3, 6) AS q3,
  ROUND(MIN(CASE WHEN l_extendedprice BETWEEN lf AND uf THEN l_extendedprice END), 6) AS whisker_lo,
  ROUND(MAX(CASE WHEN l_extendedprice BETWEEN lf AND uf THEN l_extendedprice END), 6) AS whisker_hi,
  SUM(CASE WHEN l_extendedprice BETWEEN lf AND uf THEN 0 ELSE 1 END) AS outliers
FROM lineitem l JOIN f ON l.l_returnflag = f.l_returnflag GROUP BY l.l_returnflag, f.q1, f.median, f.q3""", "T")
def b09(spark, sf):
    b = P.box_stats(T(spark, sf, "lineitem"), "l_extendedprice", "l_returnflag")
    return b.select("l_returnflag", *[rnd(c, 6).alias(c) for c in
                                      ("q1", "median", "q3", "whisker_lo", "whisker_hi")],
                    F.col("outliers").cast("bigint").alias("outliers"))


# ---------------------------------------------------------------- C selection

@query("c01_project_drop", "SELECT l_orderkey, l_partkey, l_quantity, l_extendedprice FROM lineitem")
def c01(spark, sf):
    li = S.project(T(spark, sf, "lineitem"), ["l_orderkey", "l_partkey", "l_quantity", "l_extendedprice",
                                               "l_discount"])
    return S.drop(li, ["l_discount"])


@query("c02_columns_by_regex", "SELECT p_size, p_retailprice FROM part")
def c02(spark, sf):
    return S.filter_columns(T(spark, sf, "part"), "size|price")


@query("c03_columns_by_type", "SELECT c_custkey, c_nationkey, c_acctbal FROM customer")
def c03(spark, sf):
    return S.select_dtypes(T(spark, sf, "customer"))


@query("c04_loc_label_range", """
SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) - 1 AS p FROM orders)
WHERE p BETWEEN 0 AND 5""")
def c04(spark, sf):
    o = T(spark, sf, "orders")
    return S.loc_range(o, ["o_orderdate", "o_orderkey"], 0, 5, keys=["o_custkey"],
                       cols=["o_custkey", "o_orderkey", "o_orderdate", "o_totalprice"])


@query("c05_iloc_slice", """
SELECT o_custkey, o_orderkey, o_totalprice FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) - 1 AS p FROM orders)
WHERE p >= 1 AND p < 4""")
def c05(spark, sf):
    return S.iloc_range(T(spark, sf, "orders"), ["o_orderdate", "o_orderkey"], 1, 4, keys=["o_custkey"],
                        cols=["o_custkey", "o_orderkey", "o_totalprice"])


@query("c05_iloc_tail", """
SELECT o_custkey, o_orderkey, o_totalprice FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS r FROM orders)
WHERE r <= 3""")
def c05t(spark, sf):
    return S.iloc_range(T(spark, sf, "orders"), ["o_orderdate", "o_orderkey"], -3, None, keys=["o_custkey"],
                        cols=["o_custkey", "o_orderkey", "o_totalprice"])


@query("c06_point_lookup", "SELECT o_totalprice FROM orders WHERE o_orderkey = (SELECT MAX(o_orderkey) FROM orders)")
def c06(spark, sf):
    o = T(spark, sf, "orders")
    return S.at(o, "o_orderkey", o.agg(F.max("o_orderkey")).scalar(), "o_totalprice")


@query("c07_boolean_filter", """SELECT * FROM lineitem
WHERE (l_quantity > 30 AND l_discount < 0.05) OR l_returnflag = 'R'""")
def c07(spark, sf):
    c = F.col
    return S.where_rows(T(spark, sf, "lineitem"),
                        ((c("l_quantity") > 30) & (c("l_discount") < 0.05)) | (c("l_returnflag") == "R"))


@query("c08_query_string", "SELECT * FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 100000")
def c08(spark, sf):
    return S.where_rows(T(spark, sf, "orders"), 'o_orderstatus == "F" and o_totalprice > 100000')


@query("c09_isin_list", "SELECT * FROM part WHERE p_brand IN ('Brand#1', 'Brand#2', 'Brand#3')")
def c09(spark, sf):
    return S.isin(T(spark, sf, "part"), "p_brand", ["Brand#1", "Brand#2", "Brand#3"])


@query("c09_isin_frame", """SELECT * FROM lineitem WHERE l_suppkey IN
  (SELECT s_suppkey FROM supplier WHERE s_nationkey IN (1, 2, 3))""")
def c09f(spark, sf):
    sup = T(spark, sf, "supplier").where(F.col("s_nationkey").isin(1, 2, 3)).select("s_suppkey")
    return S.isin(T(spark, sf, "lineitem"), "l_suppkey", sup)


@query("c10_contains_filter", """SELECT conv_id, turn, role FROM conversations
WHERE regexp_matches(text, '(?i)une[,.]')""")
def c10(spark, sf):
    d = S.contains_rows(T(spark, sf, "conversations"), "text", r"une[,.]", case=False)
    return d.select("conv_id", "turn", "role")


@query("c11_where_mask", """
WITH l AS (SELECT l_orderkey, l_linenumber, l_partkey,
  CASE WHEN l_partkey % 11 = 0 THEN NULL ELSE l_quantity END AS q, l_extendedprice FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey,
  CASE WHEN COALESCE(q > 10, FALSE) THEN q ELSE 0 END AS q_where,
  CASE WHEN COALESCE(q > 10, FALSE) THEN 0 ELSE q END AS q_mask FROM l""")
def c11(spark, sf):
    li = T(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.when(F.col("l_partkey") % 11 != 0, F.col("l_quantity")).alias("q"))
    cond = F.col("q") > 10
    a = S.where_values(li.withColumn("q_where", F.col("q")), cond, ["q_where"], 0)
    b = S.where_values(a.withColumn("q_mask", F.col("q")), cond, ["q_mask"], 0, mask=True)
    return b.drop("q")


@query("c12_assign_eval", """SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) AS net,
  l_quantity + l_tax AS qt FROM lineitem""", "T")
def c12(spark, sf):
    li = T(spark, sf, "lineitem")
    out = S.assign(li, net=F.col("l_extendedprice") * (1 - F.col("l_discount")), qt="l_quantity + l_tax")
    return out.select("l_orderkey", "l_linenumber", "net", "qt")


@query("c13_rename", "SELECT n_nationkey AS nation_id, n_name AS nation, n_regionkey AS region_id FROM nation")
def c13(spark, sf):
    return S.rename(T(spark, sf, "nation"), {"n_nationkey": "nation_id", "n_name": "nation",
                                             "n_regionkey": "region_id"})


@query("c14_row_rule", """SELECT l_orderkey, l_linenumber,
  CASE WHEN l_quantity > 40 AND l_returnflag = 'R' THEN 'big_return'
       WHEN l_discount >= 0.08 THEN 'discounted' WHEN l_quantity < 5 THEN 'small' ELSE 'normal' END AS rule,
  l_quantity * l_extendedprice AS qty_x_price FROM lineitem""")
def c14(spark, sf):
    c = F.col
    rule = S.case_rule([((c("l_quantity") > 40) & (c("l_returnflag") == "R"), "big_return"),
                        (c("l_discount") >= 0.08, "discounted"), (c("l_quantity") < 5, "small")], "normal")
    return T(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", rule.alias("rule"),
                                           (c("l_quantity") * c("l_extendedprice")).alias("qty_x_price"))


# ---------------------------------------------------------------- H sort / top-k

@query("h01_sort_values_rank", """
WITH c AS (SELECT c_custkey, c_mktsegment, CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE c_acctbal END AS acct FROM customer)
SELECT c_custkey, c_mktsegment, acct,
  ROW_NUMBER() OVER (ORDER BY c_mktsegment ASC NULLS LAST, acct DESC NULLS LAST, c_custkey) - 1 AS rank
FROM c""")
def h01(spark, sf):
    c = T(spark, sf, "customer").select(
        "c_custkey", "c_mktsegment", F.when(F.col("c_custkey") % 10 != 0, F.col("c_acctbal")).alias("acct"))
    return H.sort_values(c, ["c_mktsegment", "acct", "c_custkey"], [True, False, True], rank_col="rank")


@query("h02_nlargest", "SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 3")
def h02(spark, sf):
    return H.nlargest(T(spark, sf, "orders"), 3, "o_totalprice", ["o_orderkey"])


@query("h03_head", "SELECT * FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 5")
def h03(spark, sf):
    return H.head(T(spark, sf, "orders"), 5, ["o_orderdate", "o_orderkey"])

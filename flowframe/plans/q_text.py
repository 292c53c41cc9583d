"""Catalog: scalar text and date functions (I1-I15) over whole texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowframe.functions import dates as DT
from flowframe.functions import text as TX
from flowframe.plans.registry import query, rnd
from flowframe.sources.io import table as T

# Log-style text rule from the test-data notes (FIXTURES.md).
LOG_SQL = """(SELECT event_id, CASE WHEN event_type IN ('error', 'view')
  THEN upper(event_type) || ': Code: ' || CAST(event_id AS VARCHAR) ELSE event_type || ' ok' END AS msg FROM events)"""


def log_messages(spark, sf):
    e = T(spark, sf, "events")
    msg = (F.when(F.col("event_type").isin("error", "view"),
                  F.concat(F.upper("event_type"), F.lit(": Code: "), F.col("event_id").cast("string")))
            .otherwise(F.concat(F.col("event_type"), F.lit(" ok"))))
    return e.select("event_id", msg.alias("msg"))


@query("i01_lower_strip_length", """SELECT doc_id, lower(regexp_replace(text, '^\\s+|\\s+$', '', 'g')) AS clean,
  length(regexp_replace(text, '^\\s+|\\s+$', '', 'g')) AS n FROM documents""")
def i01(spark, sf):
    d = T(spark, sf, "documents")
    s = TX.strip(F.col("text"))
    return d.select("doc_id", TX.lower(s).alias("clean"), TX.length(s).alias("n"))


@query("i02_split_part", f"""SELECT event_id, split_part(msg, ':', 1) AS head,
  CASE WHEN len(string_split(msg, ':')) >= 3 THEN split_part(msg, ':', 3) END AS tail FROM {LOG_SQL}""")
def i02(spark, sf):
    m = log_messages(spark, sf)
    return m.select("event_id", TX.split_part(F.col("msg"), ":", 0).alias("head"),
                    TX.split_part(F.col("msg"), ":", 2).alias("tail"))


@query("i02_split_expand", """SELECT p_partkey, split_part(p_brand, '#', 1) AS brand_word,
  split_part(p_brand, '#', 2) AS brand_no FROM part""")
def i02e(spark, sf):
    p = T(spark, sf, "part")
    return p.select("p_partkey", *TX.split_columns(F.col("p_brand"), "#", 2, ["brand_word", "brand_no"]))


@query("i03_str_cat_per_group", """SELECT conv_id, string_agg(role, ',' ORDER BY turn) AS roles,
  string_agg(CASE WHEN turn % 3 = 0 THEN NULL ELSE CAST(turn AS VARCHAR) END, '|' ORDER BY turn) AS turns FROM conversations GROUP BY 1""")
def i03(spark, sf):
    c = T(spark, sf, "conversations").withColumn(
        "t", F.when(F.col("turn") % 3 != 0, F.col("turn").cast("string")))
    return c.groupBy("conv_id").agg(TX.cat("role", ",", "turn").alias("roles"),
                                    TX.cat("t", "|", "turn").alias("turns"))


@query("i04_contains_flags", """SELECT doc_id, CAST(contains(text, 'example.com') AS INTEGER) AS has_domain,
  CAST(regexp_matches(text, '(?i)MAIL[0-9]') AS INTEGER) AS has_mail_host,
  CAST(regexp_matches(text, '[0-9]{3}-[0-9]{4}') AS INTEGER) AS has_phone FROM documents""")
def i04(spark, sf):
    d = T(spark, sf, "documents")
    t = F.col("text")
    return d.select("doc_id", TX.contains(t, "example.com", regex=False).cast("int").alias("has_domain"),
                    TX.contains(t, "MAIL[0-9]", case=False).cast("int").alias("has_mail_host"),
                    TX.contains(t, "[0-9]{3}-[0-9]{4}").cast("int").alias("has_phone"))


@query("i05_startswith", """SELECT conv_id, turn, starts_with(text, 'The') AS starts_the FROM conversations""")
def i05(spark, sf):
    c = T(spark, sf, "conversations")
    return c.select("conv_id", "turn", TX.startswith(F.col("text"), "The").alias("starts_the"))


@query("i06_extract_code_default", f"""SELECT event_id,
  COALESCE(TRY_CAST(NULLIF(regexp_extract(msg, 'Code: ([0-9]+)', 1), '') AS BIGINT), 0) AS code FROM {LOG_SQL}""")
def i06(spark, sf):
    m = log_messages(spark, sf)
    return m.select("event_id", TX.extract_code(F.col("msg"), r"Code: ([0-9]+)").alias("code"))


EMAIL_PHONE = r"(?P<email>[A-Za-z0-9._]+@[A-Za-z0-9.]+)|(?P<phone>\+1 \([0-9]{3}\) [0-9]{3}-[0-9]{4})"


@query("i07_extract_named_groups", """SELECT doc_id,
  NULLIF(regexp_extract(text, '([A-Za-z0-9._]+@[A-Za-z0-9.]+)|(\\+1 \\([0-9]{3}\\) [0-9]{3}-[0-9]{4})', 1), '') AS email,
  NULLIF(regexp_extract(text, '([A-Za-z0-9._]+@[A-Za-z0-9.]+)|(\\+1 \\([0-9]{3}\\) [0-9]{3}-[0-9]{4})', 2), '') AS phone FROM documents""")
def i07(spark, sf):
    d = T(spark, sf, "documents")
    return d.select("doc_id", *TX.extract_named(F.col("text"), EMAIL_PHONE))


EXTRACT_ALL = r"(?P<user>[a-z]+)\.(?P<num>[0-9]+)@"


@query("i08_extractall_rows", """
WITH m AS (SELECT doc_id, regexp_extract_all(text, '([a-z]+)\\.([0-9]+)@', 1) AS u,
  regexp_extract_all(text, '([a-z]+)\\.([0-9]+)@', 2) AS n FROM documents)
SELECT doc_id, CAST(i - 1 AS INTEGER) AS match, u[i] AS user, n[i] AS num
FROM m, LATERAL (SELECT unnest(range(1, len(u) + 1)) AS i) WHERE len(u) > 0""")
def i08(spark, sf):
    d = T(spark, sf, "documents")
    z = d.select("doc_id", F.posexplode(TX.extract_all(F.col("text"), EXTRACT_ALL)).alias("match", "m"))
    return z.select("doc_id", "match", F.col("m.user").alias("user"), F.col("m.num").alias("num"))


@query("i09_regex_replace_backref", """SELECT doc_id,
  regexp_replace(text, '\\+1 \\(([0-9]{3})\\) ([0-9]{3})-([0-9]{4})', '+1 (***) ***-\\3', 'g') AS masked FROM documents""")
def i09(spark, sf):
    d = T(spark, sf, "documents")
    return d.select("doc_id", TX.replace_regex(F.col("text"), r"\+1 \(([0-9]{3})\) ([0-9]{3})-([0-9]{4})",
                                               r"+1 (***) ***-\3").alias("masked"))


@query("i10_replace_literal", f"SELECT event_id, replace(msg, 'ERROR', 'ERR') AS msg FROM {LOG_SQL}")
def i10(spark, sf):
    m = log_messages(spark, sf)
    return m.select("event_id", TX.replace_literal(F.col("msg"), "ERROR", "ERR").alias("msg"))


@query("i11_prefix_concat", "SELECT c_custkey, 'ID_' || CAST(c_custkey AS VARCHAR) AS label FROM customer")
def i11(spark, sf):
    c = T(spark, sf, "customer")
    return c.select("c_custkey", TX.prefix(F.col("c_custkey"), "ID_").alias("label"))


@query("i12_date_parts", """SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
  CAST(day(o_orderdate) AS INTEGER) AS day, CAST(isodow(o_orderdate) - 1 AS INTEGER) AS dayofweek,
  dayname(o_orderdate) AS day_name FROM orders""")
def i12(spark, sf):
    o = T(spark, sf, "orders")
    d = F.col("o_orderdate")
    return o.select("o_orderkey", F.year(d).alias("year"), F.month(d).alias("month"), F.dayofmonth(d).alias("day"),
                    DT.dayofweek(d).alias("dayofweek"), DT.day_name(d).alias("day_name"))


@query("i13_month_period", """SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS period FROM orders""")
def i13(spark, sf):
    o = T(spark, sf, "orders")
    return o.select("o_orderkey", DT.to_period_month(F.col("o_orderdate")).cast("timestamp_ntz").alias("period"))


@query("i14_add_months", """SELECT event_id, ts + INTERVAL 1 MONTH AS next_month FROM events""")
def i14(spark, sf):
    e = T(spark, sf, "events")
    return e.select("event_id", DT.add_months(F.col("ts"), 1).alias("next_month"))


@query("i15_format_number", """SELECT o_orderkey, printf('%.2f', o_totalprice) AS price_text FROM orders""")
def i15(spark, sf):
    o = T(spark, sf, "orders")
    return o.select("o_orderkey", DT.format_number(F.col("o_totalprice"), 2).alias("price_text"))

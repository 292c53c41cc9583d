"""Catalog: feature engineering and splits (J) and evaluation metrics (M)."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowframe.operators import features as J
from flowframe.operators import metrics as M
from flowframe.operators import split as SP
from flowframe.operators import windows as W
from flowframe.operators.order import join_on_keys
from flowframe.plans.registry import query, rnd
from flowframe.sources.io import table as T

SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
PRIORITY_ORDER = ["5-LOW", "4-NOT SPECIFIED", "3-MEDIUM", "2-HIGH", "1-URGENT"]


def daily_revenue(spark, sf):
    """Daily revenue on a complete calendar (A7 + F1), the forecast series."""
    o = T(spark, sf, "orders")
    d = o.groupBy(F.to_date("o_orderdate").alias("day")).agg(F.sum("o_totalprice").alias("_r"))
    spine = W.calendar_spine_from(d, [], "day", "D")
    return join_on_keys(spine, d, ["day"], "left").select("day", F.coalesce("_r", F.lit(0.0)).alias("revenue"))


DAILY_SQL = """(WITH d AS (SELECT CAST(o_orderdate AS DATE) AS day, SUM(o_totalprice) AS r FROM orders GROUP BY 1),
b AS (SELECT MIN(day) AS lo, MAX(day) AS hi FROM d),
s AS (SELECT CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS day FROM b)
SELECT s.day, COALESCE(d.r, 0.0) AS revenue FROM s LEFT JOIN d ON s.day = d.day)"""


def _tfidf_sql():
    words = J.english_stop_words()
    if words is None:       # no Spark ML jar readable: rows-only check
        return None
    stops = ", ".join("'" + w.replace("'", "''") + "'" for w in words)
    return f"""
WITH tok AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\\pL\\pN_]{{2,}}')) AS term FROM documents),
tf AS (SELECT doc_id, term, COUNT(*) AS tf FROM tok WHERE term NOT IN ({stops}) GROUP BY 1, 2),
v AS (SELECT term, COUNT(*) AS df FROM tf GROUP BY 1 ORDER BY SUM(tf) DESC, term LIMIT 5),
n AS (SELECT COUNT(*) AS n FROM documents),
w AS (SELECT tf.doc_id, tf.term, tf.tf * (ln((1.0 + n.n) / (1.0 + v.df)) + 1.0) AS w FROM tf JOIN v ON tf.term = v.term CROSS JOIN n)
SELECT doc_id, term, ROUND(w / sqrt(SUM(w * w) OVER (PARTITION BY doc_id)), 6) AS tfidf FROM w"""


@query("j01_tfidf_top5", _tfidf_sql(), "T")
def j01(spark, sf):
    t = J.tfidf_top_terms(T(spark, sf, "documents"), "doc_id", "text", 5)
    return t.select("doc_id", "term", rnd("tfidf", 6).alias("tfidf"))


@query("j02_get_dummies_drop_first", "SELECT c_custkey, " + ", ".join(
    f"COALESCE(CAST(seg = '{s}' AS INTEGER), 0) AS c_mktsegment_{s}" for s in SEGMENTS[1:]) +
    " FROM (SELECT c_custkey, CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE c_mktsegment END AS seg FROM customer)")
def j02(spark, sf):
    c = T(spark, sf, "customer").select(
        "c_custkey", F.when(F.col("c_custkey") % 17 != 0, F.col("c_mktsegment")).alias("c_mktsegment"))
    return J.get_dummies(c, "c_mktsegment", drop_first=True)


@query("j03_one_hot_unknown_zero", """
WITH lv AS (SELECT DISTINCT n_name AS level FROM nation WHERE n_regionkey IN (0, 1))
SELECT c.c_custkey, lv.level, CAST(n.n_name = lv.level AS INTEGER) AS is_level
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey CROSS JOIN lv""")
def j03(spark, sf):
    nat = T(spark, sf, "nation")
    fitted = J.levels(nat.where(F.col("n_regionkey").isin(0, 1)), "n_name")
    c = T(spark, sf, "customer").join(nat.select(F.col("n_nationkey").alias("c_nationkey"), "n_name"), "c_nationkey")
    wide = J.one_hot(c.select("c_custkey", "n_name"), "n_name", fitted, prefix="oh")
    entries = [F.struct(F.lit(v).alias("level"), F.col(f"oh_{v}").alias("is_level")) for v in fitted]
    return wide.select("c_custkey", F.explode(F.array(*entries)).alias("e")).select("c_custkey", "e.*")


@query("j04_label_encode", """SELECT c_custkey, CAST(DENSE_RANK() OVER (ORDER BY c_mktsegment) - 1 AS INTEGER) AS seg_code
FROM customer""")
def j04(spark, sf):
    c = T(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return J.label_encode(c, "c_mktsegment", "seg_code").select("c_custkey", "seg_code")


@query("j05_ordinal_encode", "SELECT o_orderkey, CAST(CASE o_orderpriority " + " ".join(
    f"WHEN '{p}' THEN {i}" for i, p in enumerate(PRIORITY_ORDER)) + " END AS INTEGER) AS priority_ord FROM orders")
def j05(spark, sf):
    o = T(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return J.ordinal_encode(o, "o_orderpriority", PRIORITY_ORDER, "priority_ord").drop("o_orderpriority")


@query("j06_standard_scale", """SELECT p_partkey,
  ROUND((p_retailprice - AVG(p_retailprice) OVER ()) / STDDEV_POP(p_retailprice) OVER (), 6) AS p_retailprice_std,
  ROUND((p_size - AVG(p_size) OVER ()) / STDDEV_POP(p_size) OVER (), 6) AS p_size_std FROM part""", "T")
def j06(spark, sf):
    p = J.standard_scale(T(spark, sf, "part"), ["p_retailprice", "p_size"])
    return p.select("p_partkey", rnd("p_retailprice_std", 6).alias("p_retailprice_std"),
                    rnd("p_size_std", 6).alias("p_size_std"))


@query("j07_minmax_scale", """SELECT p_partkey,
  ROUND((p_retailprice - MIN(p_retailprice) OVER ()) / (MAX(p_retailprice) OVER () - MIN(p_retailprice) OVER ()), 6) AS p_retailprice_mm
FROM part""", "T")
def j07(spark, sf):
    p = J.minmax_scale(T(spark, sf, "part"), ["p_retailprice"])
    return p.select("p_partkey", rnd("p_retailprice_mm", 6).alias("p_retailprice_mm"))


@query("j08_robust_scale", """
WITH q AS (SELECT quantile_cont(p_retailprice, 0.25) AS a, quantile_cont(p_retailprice, 0.5) AS m,
  quantile_cont(p_retailprice, 0.75) AS b FROM part)
SELECT p_partkey, ROUND((p_retailprice - m) / (b - a), 6) AS p_retailprice_rob FROM part, q""", "T")
def j08(spark, sf):
    p = J.robust_scale(T(spark, sf, "part"), ["p_retailprice"])
    return p.select("p_partkey", rnd("p_retailprice_rob", 6).alias("p_retailprice_rob"))


@query("j09_f_regression_rank", """
WITH s AS (SELECT 'l_quantity' AS feature, CORR(l_quantity, l_extendedprice) AS r, COUNT(*) AS n FROM lineitem
  UNION ALL SELECT 'l_discount', CORR(l_discount, l_extendedprice), COUNT(*) FROM lineitem
  UNION ALL SELECT 'l_tax', CORR(l_tax, l_extendedprice), COUNT(*) FROM lineitem)
SELECT feature, ROUND(r * r / (1 - r * r) * (n - 2), 4) AS f_score,
  CAST(ROW_NUMBER() OVER (ORDER BY r * r / (1 - r * r) * (n - 2) DESC, feature) AS INTEGER) AS rank FROM s""", "T")
def j09(spark, sf):
    s = J.f_regression(T(spark, sf, "lineitem"), ["l_quantity", "l_discount", "l_tax"], "l_extendedprice")
    return s.select("feature", rnd("f_score", 4).alias("f_score"), "rank")


def _anova_sql(k=64):
    parts = []
    for i in range(k):
        x = f"CAST(embedding[{i + 1}] AS DOUBLE)"
        parts.append(f"""SELECT 'e{i}' AS feature,
  ((SELECT SUM(s * s / n) FROM (SELECT label, SUM({x}) AS s, COUNT(*) AS n FROM embeddings GROUP BY 1)) - POW(SUM({x}), 2) / COUNT(*))
  / (COUNT(DISTINCT label) - 1) /
  ((SUM({x} * {x}) - (SELECT SUM(s * s / n) FROM (SELECT label, SUM({x}) AS s, COUNT(*) AS n FROM embeddings GROUP BY 1)))
   / (COUNT(*) - COUNT(DISTINCT label))) AS f FROM embeddings""")
    return ("WITH s AS (" + " UNION ALL ".join(parts) + ")\nSELECT feature, ROUND(f, 4) AS f_score, "
            "CAST(ROW_NUMBER() OVER (ORDER BY f DESC, feature) AS INTEGER) AS rank FROM s")


@query("j09_f_classif_rank", _anova_sql(), "T")
def j09c(spark, sf):
    e = T(spark, sf, "embeddings")
    dims = [f"e{i}" for i in range(64)]
    e = e.select("label", *[F.col("embedding")[i].cast("double").alias(c) for i, c in enumerate(dims)])
    s = J.f_classif(e, dims, "label")
    return s.select("feature", rnd("f_score", 4).alias("f_score"), "rank")


@query("j14_forecast_features", f"""
WITH d AS {DAILY_SQL}
SELECT * FROM (SELECT CAST(day AS TIMESTAMP) AS date, ROUND(revenue, 2) AS revenue, CAST(month(day) AS INTEGER) AS month,
  CAST(day(day) AS INTEGER) AS day, CAST(isodow(day) - 1 AS INTEGER) AS dayofweek,
  ROUND(LAG(revenue, 1) OVER w, 2) AS lag_1, ROUND(LAG(revenue, 7) OVER w, 2) AS lag_7,
  ROUND(LAG(revenue, 30) OVER w, 2) AS lag_30 FROM d WINDOW w AS (ORDER BY day)) WHERE lag_30 IS NOT NULL""", "T")
def j14(spark, sf):
    d = daily_revenue(spark, sf).withColumnRenamed("day", "date")
    f = J.forecast_features(d, [], "date", "revenue")
    return f.select(F.col("date").cast("timestamp_ntz").alias("date"), rnd("revenue", 2).alias("revenue"),
                    "month", "day", "dayofweek", rnd("lag_1", 2).alias("lag_1"),
                    rnd("lag_7", 2).alias("lag_7"), rnd("lag_30", 2).alias("lag_30"))


@query("j15_surge_next_label", f"""
WITH d AS {DAILY_SQL}, q AS (SELECT quantile_cont(revenue, 0.9) AS t FROM d)
SELECT CAST(day AS TIMESTAMP) AS day, CAST(nxt > t AS INTEGER) AS surge FROM
  (SELECT day, LEAD(revenue) OVER (ORDER BY day) AS nxt FROM d), q WHERE nxt IS NOT NULL""")
def j15(spark, sf):
    s = J.surge_label(daily_revenue(spark, sf), [], "day", "revenue")
    return s.select(F.col("day").cast("timestamp_ntz").alias("day"), "surge")


@query("j16_chrono_split_keyed", """SELECT o_orderkey, CASE WHEN ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) - 1
  < FLOOR(COUNT(*) OVER (PARTITION BY o_custkey) * 0.8) THEN 'train' ELSE 'test' END AS role FROM orders""")
def j16(spark, sf):
    s = SP.chrono_split(T(spark, sf, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"], 0.8)
    return s.select("o_orderkey", "role")


@query("j16_holdout_last_30", f"""WITH d AS {DAILY_SQL}
SELECT CAST(day AS TIMESTAMP) AS day, CASE WHEN ROW_NUMBER() OVER (ORDER BY day) <= COUNT(*) OVER () - 30
  THEN 'train' ELSE 'test' END AS role FROM d""")
def j16t(spark, sf):
    s = SP.chrono_split(daily_revenue(spark, sf), [], ["day"], train_frac=None, test_last=30)
    return s.select(F.col("day").cast("timestamp_ntz").alias("day"), "role")


@query("j19_time_series_split", f"""
WITH d AS (SELECT day, ROW_NUMBER() OVER (ORDER BY day) - 1 AS p, COUNT(*) OVER () AS n FROM {DAILY_SQL}),
f AS (SELECT CAST(unnest(range(0, 5)) AS INTEGER) AS fold)
SELECT CAST(day AS TIMESTAMP) AS day, fold, p AS position,
  CASE WHEN p < n - (5 - fold) * (n // 6) THEN 'train' ELSE 'test' END AS role
FROM d CROSS JOIN f WHERE p < n - (5 - fold) * (n // 6) + (n // 6)""")
def j19(spark, sf):
    s = SP.time_series_split(daily_revenue(spark, sf), [], ["day"], 5)
    return s.select(F.col("day").cast("timestamp_ntz").alias("day"), "fold", "position", "role")


@query("j20_class_weights", """SELECT doc_id, quality, ROUND(COUNT(*) OVER () / (2.0 * COUNT(*) OVER (PARTITION BY quality)), 6) AS weight
FROM labels""", "T")
def j20(spark, sf):
    w = SP.class_weights(T(spark, sf, "labels").select("doc_id", "quality"), "quality")
    return w.select("doc_id", "quality", rnd("weight", 6).alias("weight"))


def holdout_sql(table: str, id_col: str, label: str) -> str:
    """J17 in SQL: the same seeded hash order and the same shares."""
    return f"""(WITH c AS (SELECT {label} AS y, COUNT(*) AS n FROM {table} GROUP BY 1),
t AS (SELECT COUNT(*) AS m, CEIL(COUNT(*) * 0.2) AS nt FROM {table}),
s AS (SELECT y, FLOOR(nt * n / m) AS fl, nt * n / m - FLOOR(nt * n / m) AS fr, nt FROM c, t),
a AS (SELECT y, fl + CASE WHEN ROW_NUMBER() OVER (ORDER BY fr DESC, y) <= nt - SUM(fl) OVER () THEN 1 ELSE 0 END AS k FROM s),
h AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY {label} ORDER BY md5({id_col} || ':42'), {id_col}) - 1 AS hi FROM {table})
SELECT h.* EXCLUDE (hi), CASE WHEN hi < k THEN 'test' ELSE 'train' END AS role FROM h JOIN a ON h.{label} = a.y)"""


@query("j17_stratified_holdout", "SELECT * FROM " + holdout_sql("labels", "doc_id", "quality"))
def j17(spark, sf):
    return SP.stratified_holdout(T(spark, sf, "labels"), ["doc_id"], "quality", 0.2, seed=42)


@query("j18_stratified_kfold", """SELECT *, CAST((ROW_NUMBER() OVER (PARTITION BY quality ORDER BY md5(doc_id || ':42'), doc_id) - 1) % 5 AS INTEGER) AS fold
FROM labels""")
def j18(spark, sf):
    return SP.kfold(T(spark, sf, "labels"), ["doc_id"], 5, seed=42, label="quality")


@query("j21_upsample_minority", """
WITH mi AS (SELECT *, ROW_NUMBER() OVER (ORDER BY doc_id) - 1 AS k FROM labels WHERE quality = 0),
d AS (SELECT CAST('0x' || substr(md5(i || ':42'), 1, 13) AS BIGINT) % (SELECT COUNT(*) FROM mi) AS k
  FROM (SELECT unnest(range((SELECT COUNT(*) FROM labels WHERE quality = 1))) AS i))
SELECT * FROM labels WHERE quality = 1 UNION ALL SELECT mi.* EXCLUDE (k) FROM d JOIN mi USING (k)""")
def j21(spark, sf):
    return SP.upsample_minority(T(spark, sf, "labels"), ["doc_id"], "quality", minority=0, majority=1, seed=42)


# ---------------------------------------------------------------- M metrics

LINE_PRED = """(SELECT l.l_returnflag, l.l_extendedprice AS y, l.l_quantity * p.p_retailprice AS pred
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey)"""


def line_pred(spark, sf):
    li, p = T(spark, sf, "lineitem"), T(spark, sf, "part")
    j = li.join(p.select(F.col("p_partkey").alias("l_partkey"), "p_retailprice"), "l_partkey")
    return j.select("l_returnflag", F.col("l_extendedprice").alias("y"),
                    (F.col("l_quantity") * F.col("p_retailprice")).alias("pred"))


@query("m01_regression_metrics", f"""SELECT l_returnflag, COUNT(*) AS n, ROUND(AVG((y - pred) * (y - pred)), 4) AS mse,
  ROUND(SQRT(AVG((y - pred) * (y - pred))), 6) AS rmse, ROUND(AVG(ABS(y - pred)), 6) AS mae,
  ROUND(1 - SUM((y - pred) * (y - pred)) / (VAR_POP(y) * COUNT(*)), 6) AS r2, ROUND(AVG(ABS(y - pred) / ABS(y)), 6) AS mape
FROM {LINE_PRED} GROUP BY 1""", "T")
def m01(spark, sf):
    m = M.regression_metrics(line_pred(spark, sf), "y", "pred", ["l_returnflag"])
    return m.select("l_returnflag", "n", rnd("mse", 4).alias("mse"),
                    *[rnd(c, 6).alias(c) for c in ("rmse", "mae", "r2", "mape")])


DOC_PRED = """(SELECT l.doc_id, l.quality AS y, CAST(d.n_chars > 2000 AS INTEGER) AS pred, d.n_chars // 1000 AS score
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"""


def doc_pred(spark, sf):
    lab, doc = T(spark, sf, "labels"), T(spark, sf, "documents")
    j = lab.join(doc.select("doc_id", "n_chars"), "doc_id")
    return j.select("doc_id", F.col("quality").alias("y"), (F.col("n_chars") > 2000).cast("int").alias("pred"),
                    F.floor(F.col("n_chars") / 1000).alias("score"))


@query("m02_accuracy_f1", f"""SELECT ROUND(AVG(CAST(y = pred AS DOUBLE)), 6) AS accuracy,
  ROUND(2.0 * SUM(CASE WHEN y = 1 AND pred = 1 THEN 1 ELSE 0 END) / (SUM(CASE WHEN y = 1 THEN 1 ELSE 0 END) + SUM(CASE WHEN pred = 1 THEN 1 ELSE 0 END)), 6) AS f1
FROM {DOC_PRED}""", "T")
def m02(spark, sf):
    m = M.binary_metrics(doc_pred(spark, sf), "y", "pred")
    return m.select(rnd("accuracy", 6).alias("accuracy"), rnd("f1", 6).alias("f1"))


@query("m03_roc_auc_tied", f"""
WITH r AS (SELECT y, AVG(rk) OVER (PARTITION BY score) AS ar FROM (SELECT y, score, RANK() OVER (ORDER BY score) AS r0,
  ROW_NUMBER() OVER (ORDER BY score) AS rk FROM {DOC_PRED}))
SELECT ROUND((SUM(CASE WHEN y = 1 THEN ar END) - SUM(y) * (SUM(y) + 1) / 2.0) / (SUM(y) * (COUNT(*) - SUM(y))), 6) AS roc_auc FROM r""", "T")
def m03(spark, sf):
    a = M.roc_auc(doc_pred(spark, sf), "y", "score")
    return a.select(rnd("roc_auc", 6).alias("roc_auc"))


@query("m05_confusion_matrix", f"""
WITH p AS {DOC_PRED}, l AS (SELECT DISTINCT y AS v FROM p UNION SELECT DISTINCT pred FROM p)
SELECT a.v AS label, b.v AS predicted, COUNT(p.y) AS count FROM l a CROSS JOIN l b
LEFT JOIN p ON p.y = a.v AND p.pred = b.v GROUP BY 1, 2""")
def m05(spark, sf):
    return M.confusion_matrix(doc_pred(spark, sf), "y", "pred")


@query("m06_classification_report", f"""
WITH p AS {DOC_PRED}, c AS (SELECT v AS c FROM (SELECT y AS v FROM p UNION SELECT pred FROM p)),
s AS (SELECT c.c, SUM(CASE WHEN p.y = c.c AND p.pred = c.c THEN 1 ELSE 0 END) AS tp,
  SUM(CASE WHEN p.y = c.c THEN 1 ELSE 0 END) AS support, SUM(CASE WHEN p.pred = c.c THEN 1 ELSE 0 END) AS npred FROM c, p GROUP BY 1),
per AS (SELECT CAST(c AS VARCHAR) AS class, COALESCE(tp / NULLIF(npred, 0), 0) AS precision,
  COALESCE(tp / NULLIF(support, 0), 0) AS recall, COALESCE(2.0 * tp / NULLIF(support + npred, 0), 0) AS f1, support, tp FROM s)
SELECT class, ROUND(precision, 6) AS precision, ROUND(recall, 6) AS recall, ROUND(f1, 6) AS f1, CAST(support AS BIGINT) AS support FROM per
UNION ALL SELECT 'accuracy', ROUND(SUM(tp) / SUM(support), 6), ROUND(SUM(tp) / SUM(support), 6), ROUND(SUM(tp) / SUM(support), 6), CAST(SUM(support) AS BIGINT) FROM per
UNION ALL SELECT 'macro avg', ROUND(AVG(precision), 6), ROUND(AVG(recall), 6), ROUND(AVG(f1), 6), CAST(SUM(support) AS BIGINT) FROM per
UNION ALL SELECT 'weighted avg', ROUND(SUM(precision * support) / SUM(support), 6), ROUND(SUM(recall * support) / SUM(support), 6),
  ROUND(SUM(f1 * support) / SUM(support), 6), CAST(SUM(support) AS BIGINT) FROM per""", "T")
def m06(spark, sf):
    r = M.classification_report(doc_pred(spark, sf), "y", "pred")
    return r.select("class", *[rnd(c, 6).alias(c) for c in ("precision", "recall", "f1")],
                    F.col("support").cast("long").alias("support"))


@query("m07_silhouette_sqeuclidean", """
WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
d AS (SELECT a.vec_id, a.label AS la, b.label AS lb, POW(list_distance(a.x, b.x), 2) AS d2
      FROM e a JOIN e b ON a.vec_id <> b.vec_id),
m AS (SELECT vec_id, la, lb, AVG(d2) AS md FROM d GROUP BY 1, 2, 3),
s AS (SELECT vec_id, MAX(CASE WHEN la = lb THEN md END) AS a, MIN(CASE WHEN la <> lb THEN md END) AS b FROM m GROUP BY 1)
SELECT ROUND(AVG(CASE WHEN a IS NULL THEN 0 ELSE (b - a) / GREATEST(a, b) END), 6) AS silhouette FROM s""", "T")
def m07(spark, sf):
    s = M.silhouette_sq(T(spark, sf, "embeddings"), "vec_id", "embedding", "label")
    return s.select(rnd("silhouette", 6).alias("silhouette"))


@query("m07_silhouette_euclidean", """
WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
d AS (SELECT a.vec_id, a.label AS la, b.label AS lb, list_distance(a.x, b.x) AS d FROM e a JOIN e b ON a.vec_id <> b.vec_id),
m AS (SELECT vec_id, la, lb, AVG(d) AS md FROM d GROUP BY 1, 2, 3),
s AS (SELECT vec_id, MAX(CASE WHEN la = lb THEN md END) AS a, MIN(CASE WHEN la <> lb THEN md END) AS b FROM m GROUP BY 1)
SELECT ROUND(AVG(CASE WHEN a IS NULL THEN 0 ELSE (b - a) / GREATEST(a, b) END), 6) AS silhouette FROM s""", "T")
def m07e(spark, sf):
    s = M.silhouette(T(spark, sf, "embeddings"), "vec_id", "embedding", "label")
    return s.select(rnd("silhouette", 6).alias("silhouette"))

"""Catalog: models, tuning, attribution and forecasting (K), model-based feature
selection (J10-J13) and model-based imputation (D12, D13).

The supervised examples follow the reference's forecasting workflow on the order
stream: daily revenue with calendar and lag features (J14) as the regression
problem, the next-day surge label (J15) as the classification problem, a
chronological hold-out (J16) for evaluation.  Clustering and neighbours use the
embedding vectors.  Fitted models cannot match another library bit for bit;
their rows are checked by row counts here and by property tests in ``tests/``.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from flowframe.operators import agglomerate as AG
from flowframe.operators import boosting as B
from flowframe.operators import explain as X
from flowframe.operators import features as J
from flowframe.operators import forecast as FC
from flowframe.operators import kernels as KM
from flowframe.operators import models as K
from flowframe.operators import neighbors as NB
from flowframe.operators import split as SP
from flowframe.operators import tuning as TU
from flowframe.operators import windows as W
from flowframe.plans.q_features import DAILY_SQL, SEGMENTS, daily_revenue, holdout_sql
from flowframe.plans.registry import query, rnd
from flowframe.sources import io
from flowframe.sources.io import table as T
from flowframe.session import checkpoint

LINE = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
FEATS = ["month", "day", "dayofweek", "lag_1", "lag_7", "lag_30"]


def daily_features(spark, sf):
    """J14 features of daily revenue plus the J15 surge label and a J16 role."""
    d = daily_revenue(spark, sf).withColumnRenamed("day", "date")
    f = J.forecast_features(d, [], "date", "revenue")
    f = J.surge_label(f, [], "date", "revenue", 0.9, "surge")
    return SP.chrono_split(f, [], ["date"], 0.8)


def _split(spark, sf):
    f = checkpoint(daily_features(spark, sf))
    return f.where("role = 'train'"), f.where("role = 'test'")


def _pred(df, label="revenue"):
    return df.select(F.col("date").cast("timestamp_ntz").alias("date"), F.col(label).alias("actual"),
                     F.col("prediction").alias("predicted"))


@query("k01_linear_regression_1d", """SELECT ROUND(regr_slope(l_extendedprice, l_quantity), 6) AS coef,
  ROUND(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept FROM lineitem""", "T")
def k01(spark, sf):
    m = K.fit_linear(T(spark, sf, "lineitem"), ["l_quantity"], "l_extendedprice", "ols")
    return spark.range(1).select(rnd(F.lit(float(m.coefficients[0])), 6).alias("coef"),
                                 rnd(F.lit(float(m.intercept)), 4).alias("intercept"))


@query("k02_ridge_lasso_coefficients")
def k02(spark, sf):
    tr, _ = _split(spark, sf)
    ridge = K.fit_linear(tr, FEATS, "revenue", "ridge", 1.0)
    lasso = K.fit_linear(tr, FEATS, "revenue", "lasso", 0.1)
    return K.coefficients(ridge, FEATS, "ridge").unionByName(K.coefficients(lasso, FEATS, "lasso"))


@query("k03_rbf_kernel_regression")
def k03(spark, sf):
    tr, te = _split(spark, sf)
    return _pred(KM.rbf_regression(tr, te, FEATS, "revenue", C=1.0, epsilon=0.1))


@query("k04_random_forest_regression")
def k04(spark, sf):
    tr, te = _split(spark, sf)
    m = K.random_forest_regressor(100, None, 42, label="revenue").fit(K.assemble(tr, FEATS))
    return _pred(m.transform(K.assemble(te, FEATS)))


@query("k05_gbt_regression")
def k05(spark, sf):
    tr, te = _split(spark, sf)
    m = K.gbt_regressor(100, 0.1, 3, label="revenue").fit(K.assemble(tr, FEATS))
    return _pred(m.transform(K.assemble(te, FEATS)))


@query("k05_hist_boosting_regression")
def k05h(spark, sf):
    tr, te = _split(spark, sf)
    m = B.fit_histogram(tr, FEATS, "revenue", n_iter=20, max_leaves=8)
    return _pred(m.transform(te))


@query("k05_hist_boosting_stump", """
WITH d AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity AS a, l_discount AS b, l_extendedprice AS y FROM lineitem),
c AS (SELECT DISTINCT 0 AS f, a AS t FROM d UNION ALL SELECT DISTINCT 1, b FROM d),
g AS (SELECT f, t, COUNT(*) AS n, AVG(y) AS m, COUNT(*) FILTER (CASE f WHEN 0 THEN a ELSE b END <= t) AS nl,
  SUM(y) FILTER (CASE f WHEN 0 THEN a ELSE b END <= t) AS sl, SUM(y) AS s FROM d, c GROUP BY f, t),
b AS (SELECT f, t, m, sl / nl AS l, (s - sl) / (n - nl) AS r FROM g WHERE nl >= 20 AND n - nl >= 20
  ORDER BY POW(sl - nl * m, 2) / nl + POW(s - sl - (n - nl) * m, 2) / (n - nl) DESC, f, t LIMIT 1)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  ROUND(m + 0.1 * ((CASE WHEN CASE f WHEN 0 THEN a ELSE d.b END <= t THEN l ELSE r END) - m), 4) AS predicted FROM d, b""", "T")
def k05hs(spark, sf):
    """One iteration of two leaves: the best of all splits, found by SQL as well."""
    li = T(spark, sf, "lineitem")
    m = B.fit_histogram(li, ["l_quantity", "l_discount"], "l_extendedprice", n_iter=1, max_leaves=2)
    return m.transform(li).select(*LINE, rnd("prediction", 4).alias("predicted"))


def _proba(df):
    return df.select(F.col("date").cast("timestamp_ntz").alias("date"), "surge",
                     vector_to_array("probability")[1].alias("prob_1"), F.col("prediction").cast("int").alias("pred"))


@query("k06_logistic_regression_proba")
def k06(spark, sf):
    tr, te = _split(spark, sf)
    n = tr.count()
    m = K.logistic_regression(n, 1.0, label="surge").fit(K.assemble(tr, FEATS))
    return _proba(m.transform(K.assemble(te, FEATS)))


@query("k07_rbf_kernel_classifier_proba")
def k07(spark, sf):
    tr, te = _split(spark, sf)
    out = KM.rbf_classifier(tr, te, FEATS, "surge")
    return out.select(F.col("date").cast("timestamp_ntz").alias("date"), "surge", "prob_1")


@query("k08_knn_classifier", f"""
WITH h AS (SELECT * FROM {holdout_sql("embeddings", "vec_id", "label")}),
d AS (SELECT q.vec_id, q.label, c.label AS v, ROW_NUMBER() OVER (PARTITION BY q.vec_id
  ORDER BY list_distance(CAST(q.embedding AS DOUBLE[]), CAST(c.embedding AS DOUBLE[])), c.vec_id) AS rk
  FROM h q JOIN h c ON q.role = 'test' AND c.role = 'train'),
n AS (SELECT vec_id, label, v, COUNT(*) AS k FROM d WHERE rk <= 5 GROUP BY ALL)
SELECT vec_id, label, arg_min(v, (-k, v)) AS predicted FROM n GROUP BY ALL""")
def k08(spark, sf):
    e = SP.stratified_holdout(T(spark, sf, "embeddings"), ["vec_id"], "label", 0.2, seed=42)
    tr, te = e.where("role = 'train'"), e.where("role = 'test'")
    pred = NB.knn_classify(tr, te, "vec_id", "label", vector="embedding", k=5)
    return te.select("vec_id", "label").join(pred, "vec_id")


@query("k09_decision_tree_classifier")
def k09(spark, sf):
    tr, te = _split(spark, sf)
    m = K.decision_tree(5, label="surge").fit(K.assemble(tr, FEATS))
    return _proba(m.transform(K.assemble(te, FEATS)))


# A tree of one split over two features, by search over all splits for the least impurity.
STUMP_SQL = """
WITH d AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity AS a, l_discount AS b,
  CASE WHEN l_quantity * (1 - l_discount) > 30 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS y FROM lineitem),
c AS (SELECT DISTINCT 0 AS f, a AS t FROM d UNION ALL SELECT DISTINCT 1, b FROM d),
g AS (SELECT f, t, COUNT(*) AS n, SUM(y) AS s, COUNT(*) FILTER (CASE f WHEN 0 THEN a ELSE b END <= t) AS nl,
  SUM(y) FILTER (CASE f WHEN 0 THEN a ELSE b END <= t) AS sl FROM d, c GROUP BY f, t),
best AS (SELECT f, t, sl / nl AS l, (s - sl) / (n - nl) AS r FROM g WHERE nl > 0 AND nl < n
  ORDER BY (sl * sl + POW(nl - sl, 2)) / nl + (POW(s - sl, 2) + POW(n - nl - s + sl, 2)) / (n - nl) DESC LIMIT 1),
p AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, y, CASE WHEN CASE f WHEN 0 THEN a ELSE b END <= t THEN l ELSE r END AS p FROM d, best)
"""


def _stump(spark, sf):
    li = T(spark, sf, "lineitem").withColumn("many", (F.col("l_quantity") * (1 - F.col("l_discount")) > 30).cast("double"))
    tree = K.decision_tree(1, label="many").setMaxBins(64)
    return li, Pipeline(stages=[K.VectorAssembler(inputCols=["l_quantity", "l_discount"], outputCol="features"), tree]).fit(li)


@query("k09_decision_tree_stump", STUMP_SQL + """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, ROUND(p, 6) AS prob_1,
  CASE WHEN p > 0.5 THEN 1 ELSE 0 END AS pred FROM p""", "T")
def k09s(spark, sf):
    li, model = _stump(spark, sf)
    return model.transform(li).select(*LINE, rnd(vector_to_array("probability")[1], 6).alias("prob_1"), F.col("prediction").cast("int").alias("pred"))


@query("m04_reloaded_classifier_score", STUMP_SQL + """SELECT ROUND(AVG(CASE WHEN (p > 0.5) = (y = 1) THEN 1.0 ELSE 0.0 END), 9) AS accuracy,
  COUNT(*) AS n FROM p""", "T")
def m04(spark, sf):
    """``joblib.load(path).score(X, y)``: the accuracy of a pipeline that was saved and read again."""
    li, model = _stump(spark, sf)
    scored = K.save_load(model, io.scratch_path(spark, "m04")).transform(li)
    hit = (F.col("many") == F.col("prediction")).cast("double")
    return scored.agg(rnd(F.avg(hit), 9).alias("accuracy"), F.count(F.lit(1)).alias("n"))


@query("k10_random_forest_balanced")
def k10(spark, sf):
    tr, te = _split(spark, sf)
    tr = SP.class_weights(tr, "surge", "w")
    m = K.random_forest_classifier(100, None, "w", label="surge").fit(K.assemble(tr, FEATS))
    return _proba(m.transform(K.assemble(te, FEATS)))


def _emb(spark, sf):
    from pyspark.ml.functions import array_to_vector
    return T(spark, sf, "embeddings").withColumn("features", array_to_vector("embedding"))


@query("k11_kmeans_3")
def k11(spark, sf):
    e = _emb(spark, sf)
    return K.kmeans(3).fit(e).transform(e).select("vec_id", "label", F.col("prediction").alias("cluster"))


@query("k13_bisecting_kmeans_3")
def k13(spark, sf):
    e = _emb(spark, sf)
    return K.hierarchical(3).fit(e).transform(e).select("vec_id", "label", F.col("prediction").alias("cluster"))


@query("k13_agglomerative_3")
def k13a(spark, sf):
    """Ward linkage; its square cost is that of distinct vectors."""
    e = T(spark, sf, "embeddings")
    return AG.agglomerate(e, "vec_id", k=3, vector="embedding").join(e.select("vec_id", "label"), "vec_id").select("vec_id", "label", "cluster")


@query("k13_agglomerative_1d", """
WITH RECURSIVE p AS (SELECT DISTINCT s_nationkey AS x, COUNT(*) AS n FROM supplier GROUP BY 1),
c AS (SELECT 0 AS step, list({'a': x, 'b': x, 'n': n, 's': (n * x)::DOUBLE} ORDER BY x) AS g FROM p
  UNION ALL
  SELECT step + 1, list_concat(list_concat(g[:m - 1], [{'a': g[m].a, 'b': g[m + 1].b, 'n': g[m].n + g[m + 1].n, 's': g[m].s + g[m + 1].s}]), g[m + 2:])
  FROM (SELECT step, g, list_position(d, list_min(d)) AS m FROM (SELECT step, g,
      list_transform(range(1, len(g)), lambda i: g[i].n * g[i + 1].n / (g[i].n + g[i + 1].n) * POW(g[i].s / g[i].n - g[i + 1].s / g[i + 1].n, 2)) AS d
    FROM c WHERE len(g) > 3))),
last AS (SELECT unnest(g) AS k FROM c ORDER BY step DESC LIMIT 3),
named AS (SELECT s_suppkey, k.a, MIN(s_suppkey) OVER (PARTITION BY k.a) AS first FROM supplier JOIN last ON s_nationkey BETWEEN k.a AND k.b)
SELECT s_suppkey, CAST(DENSE_RANK() OVER (ORDER BY first) - 1 AS INTEGER) AS cluster FROM named""")
def k13o(spark, sf):
    """On a line, clusters are stretches, so SQL can follow the merges of neighbours."""
    return AG.agglomerate(T(spark, sf, "supplier"), "s_suppkey", ["s_nationkey"], 3)


def _k14_sql() -> str:
    hot = ", ".join(f"CASE WHEN c_mktsegment = '{s}' THEN 1.0 ELSE 0.0 END" for s in SEGMENTS)
    return f"""SELECT c_custkey, [ROUND((c_acctbal - AVG(c_acctbal) OVER ()) / STDDEV_POP(c_acctbal) OVER (), 6),
  ROUND((c_nationkey - AVG(c_nationkey) OVER ()) / STDDEV_POP(c_nationkey) OVER (), 6), {hot}]::DOUBLE[] AS features FROM customer"""


@query("k14_column_transformer", _k14_sql(), "T")
def k14(spark, sf):
    c = T(spark, sf, "customer")
    p = Pipeline(stages=K.column_transformer(["c_acctbal", "c_nationkey"], ["c_mktsegment"])).fit(c)
    return p.transform(c).select("c_custkey", F.transform(vector_to_array("features"), lambda v: rnd(v, 6)).alias("features"))


@query("k15_pipeline_scale_select_model")
def k15(spark, sf):
    tr, te = _split(spark, sf)
    pipe = K.scale_select_model(FEATS, K.linear_estimator("ols", label="revenue"), k=3, label="revenue")
    return _pred(pipe.fit(tr).transform(te))


def _lr(train=None):
    return K.linear_estimator("ols", label="revenue")


def _penalised(kind, alpha):
    """A penalty scaled by the training rows it is fitted on, and by nothing else."""
    def make(train):
        row = train.agg(F.count(F.lit(1)), F.stddev_pop("revenue")).first()
        return TU.scaled(K.linear_estimator(kind, alpha, row[0], row[1], "revenue"))
    return make


def _rbf(train):
    return Pipeline(stages=[K.FourierFeatures(FEATS, "_rff"), K.linear_estimator("ols", label="revenue").copy().setFeaturesCol("_rff")])


@query("k02_ridge_1d", """
WITH s AS (SELECT AVG(l_quantity) AS mx, AVG(l_extendedprice) AS my, COUNT(*) AS n, COVAR_POP(l_extendedprice, l_quantity) AS c,
  VAR_POP(l_quantity) AS v FROM lineitem)
SELECT ROUND(n * c / (n * v + 1.0), 4) AS coef, ROUND(my - n * c / (n * v + 1.0) * mx, 2) AS intercept FROM s""", "T")
def k02r(spark, sf):
    """Ridge with one feature against its closed form ``Sxy / (Sxx + alpha)``."""
    m = K.fit_linear(T(spark, sf, "lineitem"), ["l_quantity"], "l_extendedprice", "ridge", 1.0)
    return spark.range(1).select(rnd(F.lit(float(m.coefficients[0])), 4).alias("coef"),
                                 rnd(F.lit(float(m.intercept)), 2).alias("intercept"))


@query("k16_time_series_cv_1d", f"""
WITH d AS (SELECT day, revenue, LAG(revenue) OVER (ORDER BY day) AS x FROM {DAILY_SQL}),
p AS (SELECT *, ROW_NUMBER() OVER (ORDER BY day) - 1 AS p, COUNT(*) OVER () AS n FROM d WHERE x IS NOT NULL),
f AS (SELECT CAST(unnest(range(0, 5)) AS INTEGER) AS fold),
m AS (SELECT fold, regr_slope(revenue, x) AS b, regr_intercept(revenue, x) AS a FROM p, f WHERE p < n - (5 - fold) * (n // 6) GROUP BY 1)
SELECT m.fold, ROUND(SQRT(AVG(POW(revenue - a - b * x, 2))), 2) AS rmse FROM p JOIN m
  ON p >= n - (5 - m.fold) * (n // 6) AND p < n - (5 - m.fold) * (n // 6) + (n // 6) GROUP BY 1""", "T")
def k16s(spark, sf):
    """Scaler and linear model with one lag, cross-validated, against closed forms."""
    d = W.lags(daily_revenue(spark, sf), [], ["day"], "revenue", [1], ["lag_1"]).dropna(subset=["lag_1"])
    rows = TU.ts_cross_val(d, ["day"], ["lag_1"], "revenue", lambda tr: TU.scaled(_lr()), 5)
    return spark.createDataFrame(rows, "fold INT, rmse DOUBLE").select("fold", rnd("rmse", 2).alias("rmse"))


@query("k16_time_series_cv_rmse")
def k16(spark, sf):
    tr, _ = _split(spark, sf)
    rows = TU.ts_cross_val(tr, ["date"], FEATS, "revenue", lambda t: TU.scaled(_lr()), 5)
    return spark.createDataFrame(rows, "fold INT, rmse DOUBLE")


@query("k17_model_comparison")
def k17(spark, sf):
    tr, _ = _split(spark, sf)
    models = {
        "linear": lambda t: TU.scaled(_lr()),
        "ridge": _penalised("ridge", 1.0),
        "lasso": _penalised("lasso", 0.1),
        "rbf": _rbf,
        "random_forest": lambda t: K.random_forest_regressor(100, None, 42, label="revenue"),
        "gbt": lambda t: K.gbt_regressor(100, 0.1, 3, label="revenue"),
    }
    return TU.compare_models(tr, ["date"], FEATS, "revenue", models, 5)


# min_samples_split = s has no Spark twin; a node of fewer than 2m rows cannot be split when
# children need m rows, so s = 2, 5, 10 stand as minInstancesPerNode 1, 2, 5
FOREST_GRID = {"numTrees": [50, 100], "maxDepth": [30, 10, 20], "minInstancesPerNode": [1, 2]}


@query("k18_grid_search_cv")
def k18(spark, sf):
    tr, _ = _split(spark, sf)
    est = K.random_forest_regressor(100, None, 42, label="revenue")
    return TU.grid_search(tr, ["date"], FEATS, "revenue", est, FOREST_GRID, folds=3)


@query("k18_grid_search_classifier")
def k18c(spark, sf):
    tr, _ = _split(spark, sf)
    pipe = TU.scaled(K.decision_tree(5, label="surge"))
    return TU.grid_search(tr, ["date"], FEATS, "surge", pipe, {"maxDepth": [3, 5, 10], "minInstancesPerNode": [1, 2]}, folds=3, metric="accuracy")


@query("k19_random_search_ts_cv")
def k19(spark, sf):
    tr, _ = _split(spark, sf)
    grid = {"n_estimators": [50, 100, 200], "max_depth": [30, 10, 20, 25], "min_samples_leaf": [1, 2, 4], "min_samples_split": [2, 5, 10]}

    def make(n_estimators, max_depth, min_samples_leaf, min_samples_split):
        return TU.scaled(K.random_forest_regressor(n_estimators, max_depth, 42, max(min_samples_leaf, min_samples_split // 2), label="revenue"))
    return TU.random_search(tr, ["date"], FEATS, "revenue", make, grid, n_iter=10, seed=42)


@query("k20_save_load_score")
def k20(spark, sf):
    tr, te = _split(spark, sf)
    pipe = K.scale_select_model(FEATS, LogisticRegression(labelCol="surge"), label="surge")
    fitted = pipe.fit(tr)
    loaded = K.save_load(fitted, io.scratch_path(spark, "k20"))
    p = loaded.transform(te)
    return p.agg(F.avg((F.col("surge") == F.col("prediction")).cast("double")).alias("accuracy"),
                 F.count(F.lit(1)).alias("n"))


def priority_daily(spark, sf):
    """Many series: daily revenue per order priority on a complete calendar."""
    o = T(spark, sf, "orders").withColumn("day", F.to_date("o_orderdate"))
    r = W.resample(o, ["o_orderpriority"], "day", "D", {"o_totalprice": ["sum"]})
    return r.select("o_orderpriority", F.col("period").alias("day"), F.col("o_totalprice_sum").alias("revenue"))


PRIORITY_DAILY_SQL = """(WITH d AS (SELECT o_orderpriority, CAST(o_orderdate AS DATE) AS day, SUM(o_totalprice) AS r FROM orders GROUP BY 1, 2),
b AS (SELECT o_orderpriority, MIN(day) AS lo, MAX(day) AS hi FROM d GROUP BY 1),
s AS (SELECT o_orderpriority, CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS day FROM b)
SELECT s.o_orderpriority, s.day, COALESCE(d.r, 0.0) AS revenue FROM s LEFT JOIN d ON s.o_orderpriority = d.o_orderpriority AND s.day = d.day)"""


def _forecast_sql(method: str) -> str:
    zs = FC.DECILE_Z
    m = 7 if method == "seasonal_naive" else 1
    if method == "naive":
        point, spread = "L", "s * SQRT(h)"
    elif method == "drift":
        point, spread = "L + h * (L - F) / (n - 1)", "s * SQRT(h * (1 + h / (n - 1)))"
    else:
        point, spread = "tail[7 - 7 + ((h - 1) % 7) + 1 + (len(tail) - 7)]", "s * SQRT(FLOOR((h - 1) / 7) + 1)"
    qs = ",\n  ".join(
        f"ROUND(CASE WHEN mn >= 0 THEN GREATEST(pt + ({z!r}) * sp, 0.0) ELSE pt + ({z!r}) * sp END, 4) AS {q}"
        for q, z in zip(FC.DECILES, zs))
    return f"""
WITH d AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY o_orderpriority ORDER BY day) - 1 AS p,
  COUNT(*) OVER (PARTITION BY o_orderpriority) AS nall FROM {PRIORITY_DAILY_SQL}),
c AS (SELECT *, revenue - LAG(revenue, {m}) OVER (PARTITION BY o_orderpriority ORDER BY day) AS e FROM d WHERE p >= nall - 1024),
st AS (SELECT o_orderpriority, arg_max(revenue, day) AS L, arg_min(revenue, day) AS F, COUNT(*) AS n, MAX(day) AS last_day,
  MIN(revenue) AS mn, STDDEV_SAMP(e) AS s, list(revenue ORDER BY day) FILTER (WHERE p >= nall - 7) AS tail FROM c GROUP BY 1),
f AS (SELECT st.*, h, {point} AS pt, {spread} AS sp FROM st, (SELECT unnest(range(1, 31)) AS h))
SELECT o_orderpriority, CAST(h AS INTEGER) AS step, CAST(last_day + CAST(h AS INTEGER) AS TIMESTAMP) AS ts, ROUND(pt, 4) AS point,
  {qs} FROM f"""


def _forecast_query(method):
    def build(spark, sf):
        f = FC.forecast(priority_daily(spark, sf), ["o_orderpriority"], "day", "revenue", 30, method, context=1024)
        return f.select("o_orderpriority", "step", F.col("ts").cast("timestamp_ntz").alias("ts"),
                        rnd("point", 4).alias("point"), *[rnd(q, 4).alias(q) for q in FC.DECILES])
    return build


for _m in ("naive", "drift", "seasonal_naive"):
    query(f"k21_forecast_{_m}", _forecast_sql(_m), "T")(_forecast_query(_m))


@query("k22_recursive_forecast")
def k22(spark, sf):
    return FC.recursive_forecast(priority_daily(spark, sf), ["o_orderpriority"], "day", "revenue",
                                 n_lags=7, horizon=14)


@query("k23_shap_linear_1d", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  ROUND(regr_slope(l_extendedprice, l_quantity) OVER () * (l_quantity - AVG(l_quantity) OVER ()), 6) AS phi
FROM lineitem""", "T")
def k23(spark, sf):
    li = T(spark, sf, "lineitem")
    m = K.fit_linear(li, ["l_quantity"], "l_extendedprice", "ols")
    ids = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    s = X.linear_shap(li, ids, ["l_quantity"], list(m.coefficients), m.intercept)
    return s.select(*ids, rnd("phi", 6).alias("phi"))


@query("k22_recursive_1lag", f"""
WITH RECURSIVE d AS (SELECT * FROM {PRIORITY_DAILY_SQL}),
l AS (SELECT revenue AS y, LAG(revenue) OVER (PARTITION BY o_orderpriority ORDER BY day) AS x FROM d),
m AS (SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM l WHERE x IS NOT NULL),
s AS (SELECT o_orderpriority, arg_max(revenue, day) AS v, MAX(day) AS last_day FROM d GROUP BY 1),
r AS (SELECT o_orderpriority, last_day, 0 AS step, v FROM s
  UNION ALL SELECT o_orderpriority, last_day, step + 1, a + b * v FROM r, m WHERE step < 14)
SELECT o_orderpriority, step, CAST(last_day + step AS TIMESTAMP) AS ts, ROUND(v, 2) AS forecast FROM r WHERE step > 0""", "T")
def k22l(spark, sf):
    """One lag: the recursion has a closed step, so SQL can follow it."""
    f = FC.recursive_forecast(priority_daily(spark, sf), ["o_orderpriority"], "day", "revenue", n_lags=1, horizon=14)
    return f.select("o_orderpriority", "step", F.col("ts").cast("timestamp_ntz").alias("ts"), rnd("forecast", 2).alias("forecast"))


def _forest(spark, sf):
    tr, te = _split(spark, sf)
    m = K.random_forest_regressor(100, 10, 42, label="revenue").fit(K.assemble(tr, FEATS))
    return m, te.withColumn("row_id", F.unix_date(F.col("date").cast("date")).cast("long"))


def _rf_shap(spark, sf):
    m, te = _forest(spark, sf)
    return X.shap_values(m, te, "row_id", FEATS)


@query("k23_shap_forest")
def k23f(spark, sf):
    return _rf_shap(spark, sf)


@query("k23_shap_sampling_forest")
def k23s(spark, sf):
    m, te = _forest(spark, sf)
    return X.sampling_shap(m, te, "row_id", FEATS)


# A regression tree of depth two over two features, by search over all splits, and the value
# v(S) of every coalition S: at a split on a feature outside S both sides count by their rows.
ONE_TREE_SQL = """
WITH d AS MATERIALIZED (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_discount AS a, l_tax AS b, l_discount * l_tax AS y FROM lineitem),
c AS (SELECT DISTINCT 0 AS f, a AS t FROM d UNION ALL SELECT DISTINCT 1, b FROM d),
root AS MATERIALIZED (SELECT f, t, nl, n - nl AS nr FROM (
    SELECT f, t, COUNT(*) AS n, SUM(y) AS s, COUNT(*) FILTER (CASE f WHEN 0 THEN a ELSE b END <= t) AS nl,
      SUM(y) FILTER (CASE f WHEN 0 THEN a ELSE b END <= t) AS sl FROM d, c GROUP BY f, t)
  WHERE nl > 0 AND nl < n ORDER BY sl * sl / nl + (s - sl) * (s - sl) / (n - nl) DESC LIMIT 1),
d2 AS (SELECT d.*, CASE f WHEN 0 THEN a ELSE b END > t AS side FROM d, root),
kids AS MATERIALIZED (SELECT side, f, t, sl / nl AS l, (s - sl) / (n - nl) AS r, s / n AS m FROM (
    SELECT side, c.f, c.t, COUNT(*) AS n, SUM(y) AS s, COUNT(*) FILTER (CASE c.f WHEN 0 THEN a ELSE b END <= c.t) AS nl,
      SUM(y) FILTER (CASE c.f WHEN 0 THEN a ELSE b END <= c.t) AS sl FROM d2, c GROUP BY ALL)
  WHERE nl > 0 AND nl < n QUALIFY ROW_NUMBER() OVER (PARTITION BY side ORDER BY sl * sl / nl + (s - sl) * (s - sl) / (n - nl) DESC) = 1),
s AS (SELECT unnest([0, 1, 2, 3]) AS held),
v AS (SELECT d2.l_orderkey, d2.l_linenumber, d2.l_partkey, d2.l_suppkey, d2.a, d2.b, held,
    CASE WHEN held >> root.f & 1 = 1 THEN CASE WHEN d2.side THEN cr ELSE cl END ELSE (d2.nl * cl + d2.nr * cr) / (d2.nl + d2.nr) END AS v
  FROM (SELECT d2.*, held, root.nl, root.nr,
      CASE WHEN held >> kl.f & 1 = 1 THEN CASE WHEN CASE kl.f WHEN 0 THEN a ELSE b END <= kl.t THEN kl.l ELSE kl.r END ELSE kl.m END AS cl,
      CASE WHEN held >> kr.f & 1 = 1 THEN CASE WHEN CASE kr.f WHEN 0 THEN a ELSE b END <= kr.t THEN kr.l ELSE kr.r END ELSE kr.m END AS cr
    FROM d2, s, kids kl, kids kr, root WHERE NOT kl.side AND kr.side) d2, root),
w AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, a, b, MAX(v) FILTER (held = 0) AS v0, MAX(v) FILTER (held = 1) AS v1,
  MAX(v) FILTER (held = 2) AS v2, MAX(v) FILTER (held = 3) AS v3 FROM v GROUP BY ALL),
phi AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, a, b, v0 AS base,
  (v1 - v0 + v3 - v2) / 2 AS phi_a, (v2 - v0 + v3 - v1) / 2 AS phi_b FROM w)
"""


def _one_tree_shap(spark, sf):
    """Attribution of one fitted tree of depth two."""
    li = T(spark, sf, "lineitem").select(*LINE, "l_discount", "l_tax", (F.col("l_discount") * F.col("l_tax")).alias("y"))
    feats = ["l_discount", "l_tax"]
    m = K.decision_tree_regressor(2, label="y").fit(K.assemble(li, feats))
    return X.shap_values(m, li, LINE, feats)


@query("k23_shap_one_tree", ONE_TREE_SQL + """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 'l_discount' AS feature, ROUND(phi_a, 9) AS phi, ROUND(base, 9) AS base FROM phi
UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 'l_tax', ROUND(phi_b, 9), ROUND(base, 9) FROM phi""", "T")
def k23t(spark, sf):
    return _one_tree_shap(spark, sf).select(*LINE, "feature", rnd("phi", 9).alias("phi"), rnd("base", 9).alias("base"))


@query("k24_shap_summary_one_tree", ONE_TREE_SQL + """
SELECT feature, ROUND(m, 9) AS mean_abs_phi, ROW_NUMBER() OVER (ORDER BY m DESC, feature) AS rank FROM (
  SELECT 'l_discount' AS feature, AVG(ABS(phi_a)) AS m FROM phi UNION ALL SELECT 'l_tax', AVG(ABS(phi_b)) FROM phi)""", "T")
def k24t(spark, sf):
    g = X.mean_abs_importance(_one_tree_shap(spark, sf))
    return g.select("feature", rnd("mean_abs_phi", 9).alias("mean_abs_phi"), F.col("rank").cast("long").alias("rank"))


@query("k24_shap_dependence_one_tree", ONE_TREE_SQL + "SELECT a AS value, ROUND(phi_a, 9) AS phi FROM phi", "T")
def k24d(spark, sf):
    """Value and attribution of the discount, a row each."""
    return X.dependence(_one_tree_shap(spark, sf), "l_discount").select("value", rnd("phi", 9).alias("phi"))


@query("k24_shap_dependence")
def k24df(spark, sf):
    return X.dependence(_rf_shap(spark, sf), "lag_7")


@query("k24_shap_summary")
def k24(spark, sf):
    return X.mean_abs_importance(_rf_shap(spark, sf))


@query("k24_shap_waterfall")
def k24w(spark, sf):
    s = _rf_shap(spark, sf)
    return X.waterfall(s, "row_id", s.agg(F.min("row_id")).first()[0])


@query("j10_recursive_feature_elimination")
def j10(spark, sf):
    tr, _ = _split(spark, sf)
    return K.rfe(tr, FEATS, "revenue", 3)


@query("j11_select_from_model_median")
def j11(spark, sf):
    tr, _ = _split(spark, sf)
    return K.select_from_model(tr, FEATS, "revenue").select(
        F.col("date").cast("timestamp_ntz").alias("date"), "selected")


@query("j12_pca_95_variance")
def j12(spark, sf):
    e = T(spark, sf, "embeddings")
    cols = [f"e{i}" for i in range(64)]
    e = e.select("vec_id", *[F.col("embedding")[i].cast("double").alias(c) for i, c in enumerate(cols)])
    return K.pca_variance(e, cols, 0.95).select("vec_id", "pcs")


@query("j12_pca_2d", """
WITH s AS (SELECT AVG(l_quantity) AS mx, AVG(l_discount) AS my, VAR_SAMP(l_quantity) AS a, VAR_SAMP(l_discount) AS d,
  COVAR_SAMP(l_quantity, l_discount) AS b FROM lineitem),
e AS (SELECT *, (a + d) / 2 + SQRT(POW((a - d) / 2, 2) + b * b) AS l1, (a + d) / 2 - SQRT(POW((a - d) / 2, 2) + b * b) AS l2 FROM s)
SELECT ROUND(l1 / (l1 + l2), 6) AS explained, ROUND(ABS(b) / SQRT(b * b + POW(l1 - a, 2)), 6) AS weight FROM e""", "T")
def j12s(spark, sf):
    """Two columns: first component's share of the variance and weight, in closed form."""
    li = T(spark, sf, "lineitem").select(F.col("l_quantity"), F.col("l_discount"))
    p = K.pca_variance(li, ["l_quantity", "l_discount"], 1.0)
    v = p.agg(F.var_samp(F.col("pcs")[0]).alias("l1"), F.var_samp(F.col("pcs")[1]).alias("l2"),
              F.abs(F.regr_slope(F.col("pcs")[0], F.col("l_quantity"))).alias("w"))
    g = p.agg(F.covar_samp("l_quantity", "l_discount").alias("b"), F.var_samp("l_quantity").alias("a"))
    # the weight of l_quantity in the unit vector w satisfies cov(pc1, l_quantity) = l1 * w
    c = p.agg(F.abs(F.covar_samp(F.col("pcs")[0], F.col("l_quantity"))).alias("c"))
    return v.crossJoin(c).select(rnd(F.col("l1") / (F.col("l1") + F.col("l2")), 6).alias("explained"),
                                 rnd(F.col("c") / F.col("l1"), 6).alias("weight"))


@query("j13_permutation_importance")
def j13(spark, sf):
    tr, _ = _split(spark, sf)
    tr = tr.withColumn("row_id", F.unix_date(F.col("date").cast("date")).cast("long"))
    m = K.random_forest_regressor(50, 10, 42, label="revenue").fit(K.assemble(tr, FEATS))
    imp = TU.permutation_importance(m, tr, "row_id", FEATS, "revenue", n_repeats=10)
    return imp.groupBy("feature").agg(F.avg("drop").alias("mean_drop"), F.stddev_samp("drop").alias("std_drop"))


@query("d12_knn_impute", """
WITH p AS (SELECT p_partkey, CAST(p_size AS DOUBLE) AS s, CAST(regexp_extract(p_brand, '([0-9]+)', 1) AS DOUBLE) AS b,
  CASE WHEN p_partkey % 10 <> 0 THEN p_retailprice END AS y FROM part),
d AS (SELECT q.p_partkey, c.y, ROW_NUMBER() OVER (PARTITION BY q.p_partkey
  ORDER BY (q.s - c.s) * (q.s - c.s) + (q.b - c.b) * (q.b - c.b), c.p_partkey) AS rk FROM p q JOIN p c ON q.y IS NULL AND c.y IS NOT NULL),
f AS (SELECT p_partkey, AVG(y) AS f FROM d WHERE rk <= 5 GROUP BY 1)
SELECT p.p_partkey, s AS p_size, b AS brand_no, ROUND(COALESCE(y, f), 6) AS p_retailprice FROM p LEFT JOIN f ON p.p_partkey = f.p_partkey""", "T")
def d12(spark, sf):
    p = T(spark, sf, "part").select(
        "p_partkey", F.col("p_size").cast("double").alias("p_size"),
        F.regexp_extract("p_brand", "([0-9]+)", 1).cast("double").alias("brand_no"),
        F.when(F.col("p_partkey") % 10 != 0, F.col("p_retailprice")).alias("p_retailprice"))
    return NB.knn_impute(p, "p_partkey", ["p_size", "brand_no"], "p_retailprice", k=5).withColumn("p_retailprice", rnd("p_retailprice", 6))


@query("d13_iterative_impute_1d", """
WITH p AS (SELECT p_partkey, CAST(p_size AS DOUBLE) AS p_size,
  CASE WHEN p_partkey % 10 = 0 THEN NULL ELSE p_retailprice END AS price FROM part),
r AS (SELECT regr_slope(price, p_size) AS b, regr_intercept(price, p_size) AS a FROM p WHERE price IS NOT NULL)
SELECT p_partkey, ROUND(COALESCE(price, a + b * p_size), 6) AS price FROM p, r""", "T")
def d13(spark, sf):
    p = T(spark, sf, "part").select(
        "p_partkey", F.col("p_size").cast("double").alias("p_size"),
        F.when(F.col("p_partkey") % 10 != 0, F.col("p_retailprice")).alias("price"))
    out = NB.iterative_impute(p, "p_partkey", ["p_size", "price"])
    return out.select("p_partkey", rnd("price", 6).alias("price"))


@query("k12_dbscan", """
WITH RECURSIVE z AS (SELECT p_partkey AS id, (p_size - AVG(p_size) OVER ()) / STDDEV_POP(p_size) OVER () AS x,
  (p_retailprice - AVG(p_retailprice) OVER ()) / STDDEV_POP(p_retailprice) OVER () AS y FROM part),
nb AS MATERIALIZED (SELECT a.id AS a, b.id AS b FROM z a JOIN z b ON (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= 0.25),
core AS MATERIALIZED (SELECT a AS id FROM nb GROUP BY a HAVING COUNT(*) >= 5),
links AS MATERIALIZED (SELECT a, b FROM nb SEMI JOIN core ca ON ca.id = nb.a SEMI JOIN core cb ON cb.id = nb.b),
cc(id, lab) USING KEY (id) AS (
  SELECT id, id FROM core
  UNION
  (SELECT l.b, MIN(cc.lab) FROM cc JOIN links l ON l.a = cc.id JOIN recurring.cc AS old ON old.id = l.b
   WHERE cc.lab < old.lab GROUP BY l.b)),
lab AS (SELECT id, lab FROM cc UNION ALL
  SELECT nb.a, MIN(cc.lab) FROM nb JOIN cc ON cc.id = nb.b ANTI JOIN core ON core.id = nb.a GROUP BY nb.a)
SELECT z.id AS p_partkey, CAST(COALESCE(DENSE_RANK() OVER (ORDER BY lab NULLS LAST) - 1 + lab - lab, -1) AS INTEGER) AS cluster
FROM z LEFT JOIN lab ON lab.id = z.id""")
def k12(spark, sf):
    """``DBSCAN(eps=0.5, min_samples=5)`` on the standardised part size and price."""
    p = T(spark, sf, "part").select("p_partkey", F.col("p_size").cast("double").alias("size"),
                                    F.col("p_retailprice").alias("price"))
    z = J.standard_scale(p, ["size", "price"], "_z")
    return NB.dbscan(z, "p_partkey", ["size_z", "price_z"], eps=0.5, min_samples=5)

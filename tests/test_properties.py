"""Property tests for rows checked without SQL (R): exact shares, fold sizes,
no future rows in time-series folds, exact upsample counts, repeatability."""

from pyspark.sql import functions as F

from flowframe.operators import split as SP
from flowframe.sources.io import table as T
from tests.conftest import SF_CHECK


def test_stratified_holdout_exact_shares(spark):
    lab = T(spark, SF_CHECK, "labels")
    s = SP.stratified_holdout(lab, ["doc_id"], "quality", 0.2, seed=42).toPandas()
    n = len(s)
    n_test = -(-n * 2 // 10)                                     # ceil(0.2 n)
    assert (s["role"] == "test").sum() == n_test
    for q, g in s.groupby("quality"):
        share = n_test * len(g) / n
        assert int(share) <= (g["role"] == "test").sum() <= int(share) + 1
    s2 = SP.stratified_holdout(lab, ["doc_id"], "quality", 0.2, seed=42).toPandas()
    assert s.sort_values("doc_id")["role"].tolist() == s2.sort_values("doc_id")["role"].tolist()


def test_stratified_kfold_balanced(spark):
    lab = T(spark, SF_CHECK, "labels")
    f = SP.kfold(lab, ["doc_id"], 5, seed=42, label="quality").toPandas()
    sizes = f.groupby(["quality", "fold"]).size().unstack()
    assert (sizes.max(axis=1) - sizes.min(axis=1) <= 1).all()


def test_time_series_split_no_future(spark):
    o = T(spark, SF_CHECK, "orders")
    s = SP.time_series_split(o, [], ["o_orderdate", "o_orderkey"], 5).toPandas()
    for fold, g in s.groupby("fold"):
        assert g[g.role == "train"]["position"].max() < g[g.role == "test"]["position"].min()
    sizes = s[s.role == "test"].groupby("fold").size()
    assert sizes.nunique() == 1


def test_upsample_exact_counts(spark):
    lab = T(spark, SF_CHECK, "labels")
    up = SP.upsample_minority(lab, ["doc_id"], "quality", minority=0, majority=1, seed=42)
    c = {r["quality"]: r["count"] for r in up.groupBy("quality").count().collect()}
    assert c[0] == c[1] == lab.where(F.col("quality") == 1).count()


def test_forecast_deciles_monotone_and_clamped(spark):
    from flowframe.operators import forecast as FC
    from flowframe.plans.q_models import priority_daily
    f = FC.forecast(priority_daily(spark, SF_CHECK), ["o_orderpriority"], "day", "revenue", 30, "drift").toPandas()
    q = f[FC.DECILES].to_numpy()
    assert (q[:, 1:] >= q[:, :-1] - 1e-9).all()
    assert (q >= 0).all()                      # revenue is never negative, so deciles are clamped
    assert f.groupby("o_orderpriority").size().eq(30).all()


def test_sampling_shap_additive(spark):
    import numpy as np
    from flowframe.operators import explain as X
    from flowframe.operators import models as K
    o = T(spark, SF_CHECK, "orders").select(
        "o_orderkey", F.col("o_totalprice").alias("y"), F.month("o_orderdate").cast("double").alias("m"),
        F.dayofmonth("o_orderdate").cast("double").alias("d"), F.col("o_custkey").cast("double").alias("c"))
    feats = ["m", "d", "c"]
    model = K.random_forest_regressor(20, 5, 42, label="y").fit(K.assemble(o, feats))
    rows = o.where(F.col("o_orderkey") < 40)
    phi = X.sampling_shap(model, rows, "o_orderkey", feats, n_orders=4).toPandas()
    pred = model.transform(K.assemble(rows, feats)).select("o_orderkey", "prediction").toPandas()
    tot = phi.groupby("o_orderkey").agg(s=("phi", "sum"), b=("base", "first")).reset_index()
    m = tot.merge(pred, on="o_orderkey")
    np.testing.assert_allclose(m["s"] + m["b"], m["prediction"], rtol=1e-9, atol=1e-6)

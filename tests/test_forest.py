"""Forests grown in tasks against Spark's own, and against each setting by itself."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from flowframe.operators import forest as FO
from flowframe.operators import models as K
from flowframe.operators import tuning as TU

FEATS = ["a", "b", "c"]


def data(spark, n=400):
    rng = np.random.default_rng(11)
    pdf = pd.DataFrame({"id": np.arange(n), "a": rng.normal(size=n), "b": rng.integers(0, 12, n).astype(float), "c": np.round(rng.normal(size=n), 1)})
    pdf["y"] = 1000 * (pdf["a"] * pdf["b"] + pdf["c"] ** 2) + 50 * rng.normal(size=n)
    return spark.createDataFrame(pdf), pdf


@pytest.mark.parametrize("depth,least", [(3, 1), (30, 1), (30, 4)])
def test_trees_without_bootstrap_are_those_of_spark(spark, depth, least):
    df, pdf = data(spark)
    rows = K.assemble(df.where("id < 300").orderBy("id").coalesce(1), FEATS)
    est = RandomForestRegressor(labelCol="y", numTrees=2, maxDepth=depth, minInstancesPerNode=least, bootstrap=False, featureSubsetStrategy="all", seed=1)
    assert FO.fits(est, rows, 300)
    model = est.fit(rows)
    want = model.transform(K.assemble(df, FEATS)).orderBy("id").toPandas()["prediction"].to_numpy()
    x, y = pdf[FEATS].to_numpy(), pdf["y"].to_numpy()
    cut, nodes = FO.grow(x[:300], y[:300], FO.Growth.of(est), range(2), depth, x, [2, depth])
    assert cut[depth].sum(axis=0) / 2 == pytest.approx(want, rel=1e-9)
    top = est.copy({est.maxDepth: 2}).fit(rows).transform(K.assemble(df, FEATS)).orderBy("id").toPandas()["prediction"]
    assert cut[2].sum(axis=0) / 2 == pytest.approx(top.to_numpy(), rel=1e-9)
    # Spark's saved trees leave out children that predict the same
    assert len(nodes[0]) >= model.totalNumNodes and (nodes[2] < 0).sum() == (nodes[2] > 0).sum() + 2


def test_a_grid_of_forests_makes_no_job_for_each_level(spark):
    df, _ = data(spark, 150)
    est = K.random_forest_regressor(100, None, 42, label="y")
    grid = {"numTrees": [3, 25], "maxDepth": [30, 2], "minInstancesPerNode": [1, 5]}
    sc = spark.sparkContext
    sc.setJobGroup("grid", "grid")
    try:
        got = {r["setting"]: r["rmse"] for r in TU.grid_search(df, ["id"], FEATS, "y", est, grid).collect()}
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert len(got) == 8 and len(sc.statusTracker().getJobIdsForGroup("grid")) < 60
    # the settings of a shared forest score as each does by itself
    for setting, rmse in list(got.items())[::3]:
        alone = {k: [int(v)] for k, v in (p.split("=") for p in setting.split(", "))}
        assert TU.grid_search(df, ["id"], FEATS, "y", est, alone).first()["rmse"] == pytest.approx(rmse, rel=1e-12)
    # and near Spark's forest, whose bootstrap draws others
    from flowframe.operators import split as SP
    d = K.assemble(SP.kfold(df, ["id"], 3, 42, name="_fold").coalesce(1), FEATS).cache()
    plain = [TU._rmse(est.copy({est.numTrees: 25, est.maxDepth: 8}).fit(d.where(F.col("_fold") != k)).transform(d.where(F.col("_fold") == k)), "y") for k in range(3)]
    assert got["maxDepth=30, minInstancesPerNode=1, numTrees=25"] == pytest.approx(np.mean(plain), rel=0.15)


def test_the_last_fit_is_a_whole_forest_on_all_rows(spark):
    df, pdf = data(spark, 200)
    rows = K.assemble(df.withColumn("_fold", F.lit(0)), FEATS)
    est = K.random_forest_regressor(45, 6, 42, label="y")
    nodes = FO.fitted(FO.packed(rows, ["id"], "y"), est).toPandas()
    assert sorted(nodes["tree"].unique()) == list(range(45))
    x = pdf[FEATS].to_numpy()
    total = np.zeros(len(x))
    for _, t in nodes.groupby("tree"):
        t = t.set_index("node")
        for i, v in enumerate(x):
            k = 0
            while t.at[k, "left"] >= 0:
                k = t.at[k, "left"] if v[t.at[k, "feature"]] <= t.at[k, "threshold"] else t.at[k, "right"]
            total[i] += t.at[k, "value"]
    cut, _ = FO.grow(x, pdf["y"].to_numpy(), FO.Growth.of(est), range(45), 6, x, [6])
    assert total == pytest.approx(cut[6].sum(axis=0), rel=1e-12)
    assert np.corrcoef(total, pdf["y"])[0, 1] > 0.9


def test_large_weighted_or_categorical_inputs_are_left_to_spark(spark):
    df, _ = data(spark, 60)
    rows = K.assemble(df, FEATS)
    est = K.random_forest_regressor(5, 3, label="y")
    assert FO.fits(est, rows, 60) and not FO.fits(est, rows, FO.CELLS)
    assert not FO.fits(est.copy().setWeightCol("a"), rows, 60) and not FO.fits(est.copy().setFeatureSubsetStrategy("sqrt"), rows, 60)
    assert not FO.fits(K.decision_tree_regressor(3, label="y"), rows, 60)


def test_missing_values_and_flat_features(spark):
    x = np.array([[1.0, 5.0], [np.nan, 5.0], [2.0, 5.0], [np.nan, 5.0]] * 10)
    y = np.where(np.isnan(x[:, 0]), 9.0, x[:, 0])
    cut, _ = FO.grow(x, y, FO.Growth(32, 1, 0.0, 1.0, 42, False), range(1), 5, x[:4], [0, 5])
    assert cut[0][0] == pytest.approx(np.full(4, y.mean())) and cut[5][0] == pytest.approx(y[:4])
    flat, nodes = FO.grow(x[:, 1:], y, FO.Growth(32, 1, 0.0, 1.0, 42), range(3), 5, x[:4, 1:], [5])
    assert flat[5].shape == (3, 4) and len(nodes[0]) == 3

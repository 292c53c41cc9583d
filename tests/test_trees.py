"""Tree attribution against all subsets, additivity, missing values and classifiers."""

import itertools
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from flowframe.operators import explain as X
from flowframe.operators import models as K
from flowframe.operators import trees as T


def data(spark, n, d, seed=3):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, d)), 2)
    y = x[:, 0] * x[:, 1] + np.abs(x[:, 2]) + (x[:, 0] > 0) * x[:, min(3, d - 1)] + 0.1 * rng.normal(size=n)
    feats = [f"f{i}" for i in range(d)]
    pdf = pd.DataFrame(x, columns=feats).assign(id=np.arange(n), y=y, c=(y > y.mean()).astype(float))
    return spark.createDataFrame(pdf), feats


def conditional(nodes, x, held):
    """Expected value of a tree that follows the row on the features ``held``."""
    def at(i):
        left, right, feature, threshold, cover, value = nodes[i]
        if left < 0:
            return value
        if feature in held:
            return at(left if x[feature] <= threshold else right)
        return (nodes[left][4] * at(left) + nodes[right][4] * at(right)) / cover
    return at(0)


def brute(nodes, x):
    d = len(x)
    phi = np.zeros(d)
    for j in range(d):
        for k in range(d):
            w = math.factorial(k) * math.factorial(d - k - 1) / math.factorial(d)
            for s in itertools.combinations([i for i in range(d) if i != j], k):
                phi[j] += w * (conditional(nodes, x, {*s, j}) - conditional(nodes, x, set(s)))
    return phi


def random_tree(rng, d, depth):
    nodes = {}

    def grow(i, level, cover):
        if level == depth or cover < 2 or rng.random() < 0.1:
            nodes[i] = (-1, -1, -1, 0.0, cover, float(rng.normal()))
            return
        left = int(rng.integers(1, cover))
        a, b = len(nodes) + 1000 * level + 2 * i + 1, len(nodes) + 1000 * level + 2 * i + 2
        nodes[i] = (a, b, int(rng.integers(d)), float(np.round(rng.normal(), 1)), cover, 0.0)
        grow(a, level + 1, left)
        grow(b, level + 1, cover - left)

    grow(0, 0, 500)
    return nodes


def test_cover_attribution_of_random_trees_is_exact():
    rng = np.random.default_rng(1)
    for depth in (0, 1, 2, 4, 6):
        trees = [random_tree(rng, 5, depth) for _ in range(3)]
        table = T.leaf_table(trees)
        x = np.round(rng.normal(size=(8, 5)), 1)
        shares = table.shares(None)
        phi = table.attribute(x, shares)
        assert phi == pytest.approx(np.array([sum(brute(t, r) for t in trees) for r in x]), abs=1e-9)
        assert phi.sum(axis=1) + table.base(shares) == pytest.approx(table.predict(x), abs=1e-9)


def test_means_background_equals_all_subsets(spark):
    df, feats = data(spark, 300, 6)
    model = K.random_forest_regressor(12, 6, 1, label="y").fit(K.assemble(df, feats))
    some = df.where("id < 12")
    exact = {(r["id"], r["feature"]): (r["phi"], r["base"], r["value"]) for r in X.exact_shap(model, some, "id", feats).collect()}
    path = X.tree_shap(model, some, "id", feats, background="means").collect()
    assert len(path) == len(exact)
    for r in path:
        phi, base, value = exact[r["id"], r["feature"]]
        assert r["phi"] == pytest.approx(phi, abs=1e-9) and r["base"] == pytest.approx(base, abs=1e-9) and r["value"] == value


def additive(spark, model, df, feats, prediction, background="cover"):
    phi = X.tree_shap(model, df, "id", feats, background).groupBy("id").agg(F.sum("phi").alias("s"), F.max("base").alias("b"), F.count("*").alias("n"))
    rows = phi.join(prediction, "id").collect()
    assert rows and all(r["s"] + r["b"] == pytest.approx(r["p"], abs=1e-8) and r["n"] == len(feats) for r in rows)


def test_additive_on_thirty_features(spark):
    df, feats = data(spark, 400, 30)
    a = K.assemble(df, feats)
    for est in (K.random_forest_regressor(10, 8, 1, label="y"), K.gbt_regressor(12, 0.1, 4, label="y")):
        model = est.fit(a)
        pred = model.transform(a).select("id", F.col("prediction").alias("p"))
        additive(spark, model, df, feats, pred)
        additive(spark, model, df, feats, pred, "means")
    values = X.shap_values(model, df, "id", feats)
    assert values.columns == ["id", "feature", "value", "phi", "base"] and values.count() == 400 * 30
    assert X.dependence(values, "f0").count() == 400


def test_classifiers_attribute_a_class_probability(spark):
    from pyspark.ml.functions import vector_to_array
    df, feats = data(spark, 300, 5)
    a = K.assemble(df, feats)
    for est in (K.decision_tree(4, label="c"), K.random_forest_classifier(8, 5, label="c")):
        model = est.fit(a)
        pred = model.transform(a).select("id", vector_to_array("probability")[1].alias("p"))
        additive(spark, model, df, feats, pred)


def test_missing_values_follow_the_fitted_tree(spark):
    df, feats = data(spark, 300, 4)
    model = K.random_forest_regressor(6, 5, 1, label="y").fit(K.assemble(df, feats))
    holes = df.withColumn("f1", F.when(F.col("id") % 3 > 0, F.col("f1"))).withColumn("f0", F.when(F.col("id") % 5 > 0, F.col("f0")))
    pred = model.transform(K.assemble(holes, feats)).select("id", F.col("prediction").alias("p"))
    additive(spark, model, holes, feats, pred)
    assert X.tree_shap(model, holes.where("false"), "id", feats).count() == 0

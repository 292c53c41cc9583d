"""Kernel machines: their objective against a bound from the dual problem."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from flowframe.operators import kernels as K


def table(spark, n=200, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 2)) * [10.0, 0.1] + [5.0, 1.0]
    s = (x - [5.0, 1.0]) / [10.0, 0.1]
    y = np.sin(2 * s[:, 0]) + 0.5 * s[:, 1] + 0.2 * rng.normal(size=n)
    c = (s[:, 0] ** 2 + s[:, 1] ** 2 + 0.3 * rng.normal(size=n) < 1.2).astype(float)
    pdf = pd.DataFrame({"id": np.arange(n), "a": x[:, 0], "b": x[:, 1], "y": y, "c": c})
    return pdf, spark.createDataFrame(pdf).repartition(4)


@pytest.mark.parametrize("kind,C", [("epsilon", 1.0), ("hinge", 1.0)])
def test_objective_is_within_one_percent_of_the_optimum(spark, kind, C):
    """Every row is a landmark, so the kernel is exact.  Any feasible point of the dual bounds the optimum from below."""
    pdf, df = table(spark)
    machine = K.fit_kernel(df, ["a", "b"], "y" if kind == "epsilon" else "c", kind, C, 0.1)
    x = pdf[["a", "b"]].to_numpy()
    s = (x - x.mean(axis=0)) / x.std(axis=0)
    kernel = np.exp(-0.5 * ((s[:, None] - s) ** 2).sum(axis=2))
    f = machine.mapped(x) @ machine.weights
    w2 = (machine.weights[:-1] ** 2).sum()
    if kind == "epsilon":
        y = pdf["y"].to_numpy()
        primal = 0.5 * w2 + C * np.maximum(np.abs(f - y) - 0.1, 0).sum()
        beta = -C * K.losses(kind, f, y, 0.1, machine.width)[1]
        linear = lambda b: y @ b - 0.1 * np.abs(b).sum()
    else:
        y = 2 * pdf["c"].to_numpy() - 1
        primal = 0.5 * w2 + C * np.maximum(1 - y * f, 0).sum()
        beta = -C * K.losses(kind, f, y, 0.1, machine.width)[1]
        linear = lambda b: np.abs(b).sum()
    # the free constant asks for a sum of 0: shrink the heavier sign
    up, down = beta[beta > 0].sum(), -beta[beta < 0].sum()
    beta = np.where(beta > 0, beta * min(1.0, down / up), beta * min(1.0, up / down))
    dual = linear(beta) - 0.5 * beta @ kernel @ beta
    assert dual <= primal + 1e-9 and primal - dual <= 0.01 * primal


def test_few_landmarks_missing_values_and_empty_tables(spark):
    pdf, df = table(spark, 300)
    holes = df.withColumn("a", F.when(F.col("id") % 10 > 0, F.col("a")))
    out = K.rbf_regression(holes, holes, ["a", "b"], "y", C=10.0, landmarks=40).toPandas().set_index("id")
    lost = out.index % 10 == 0
    assert out.loc[lost, "prediction"].isna().all() and out.loc[~lost, "prediction"].notna().all()
    err = (out.loc[~lost, "prediction"] - out.loc[~lost, "y"]) ** 2
    assert err.mean() < 0.3 * out["y"].var()
    got = K.rbf_classifier(df, df, ["a", "b"], "c", landmarks=40).toPandas()
    assert got.columns.tolist() == ["id", "a", "b", "y", "c", "prediction", "prob_1"]
    assert (got["prediction"] == got["c"]).mean() > 0.85 and got["prob_1"].between(0, 1).all()
    assert got.loc[got["c"] == 1, "prob_1"].mean() > got.loc[got["c"] == 0, "prob_1"].mean() + 0.4
    far = K.fit_kernel(df.withColumn("y", F.col("y") + 1000.0), ["a", "b"], "y", landmarks=20)
    assert abs(far.transform(df, "p").agg(F.avg("p")).first()[0] - 1000) < 1
    none = K.fit_kernel(df.where("false"), ["a", "b"], "y")
    assert {r["prediction"] for r in none.transform(df).collect()} == {0.0} and none.transform(df.where("false")).count() == 0

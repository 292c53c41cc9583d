"""pandas parity for the semantic rules of SURVEY section 1.1 on small frames."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from flowframe.operators import clean as D
from flowframe.operators import features as J
from flowframe.operators import windows as W


def test_interpolate_linear(spark):
    x = [np.nan, 1.0, np.nan, np.nan, 4.0, np.nan, 10.0, np.nan, np.nan]
    pdf = pd.DataFrame({"t": range(len(x)), "x": x})
    df = spark.createDataFrame(pdf).withColumn("x", F.when(~F.isnan("x"), F.col("x")))
    got = D.interpolate(df, [], ["t"], "x").orderBy("t").toPandas()["x"]
    np.testing.assert_allclose(got, pdf["x"].interpolate(method="linear"), equal_nan=True)


def test_pct_change_pads(spark):
    x = [1.0, np.nan, 2.0, 4.0, np.nan, 2.0]
    pdf = pd.DataFrame({"t": range(len(x)), "x": x})
    df = spark.createDataFrame(pdf).withColumn("x", F.when(~F.isnan("x"), F.col("x")))
    got = W.pct_change(df, [], ["t"], "x", "p").orderBy("t").toPandas()["p"]
    exp = pdf["x"].ffill().pct_change()
    np.testing.assert_allclose(got, exp, equal_nan=True)


def test_cut_and_qcut(spark):
    rng = np.random.default_rng(1)
    v = rng.normal(size=200).round(3)
    pdf = pd.DataFrame({"i": range(200), "v": v})
    df = spark.createDataFrame(pdf)
    c = D.cut(df, "v", 3, ["a", "b", "c"], "b").orderBy("i").toPandas()["b"]
    assert (c.to_numpy() == pd.cut(pdf["v"], 3, labels=["a", "b", "c"]).astype(str).to_numpy()).all()
    q = D.qcut(df, "v", 4, ["q1", "q2", "q3", "q4"], "q").orderBy("i").toPandas()["q"]
    assert (q.to_numpy() == pd.qcut(pdf["v"], 4, labels=["q1", "q2", "q3", "q4"]).astype(str).to_numpy()).all()


def test_weekly_resample_empty_weeks(spark):
    ts = pd.to_datetime(["2024-01-01 10:00", "2024-01-07 23:00", "2024-01-22 00:00", "2024-01-23 00:00"])
    pdf = pd.DataFrame({"ts": ts, "v": [1.0, 2.0, 3.0, 5.0]})
    df = spark.createDataFrame(pdf).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    got = W.resample(df, [], "ts", "W", {"v": ["mean", "sum"]}).orderBy("period").toPandas()
    exp = pdf.set_index("ts")["v"].resample("W")
    np.testing.assert_allclose(got["v_mean"], exp.mean().to_numpy(), equal_nan=True)
    np.testing.assert_allclose(got["v_sum"], exp.sum().to_numpy())
    assert [str(d) for d in got["period"]] == [str(d.date()) for d in exp.mean().index]


def test_get_dummies_drop_first(spark):
    pdf = pd.DataFrame({"i": [0, 1, 2, 3], "c": ["b", "a", None, "c"]})
    df = spark.createDataFrame(pdf)
    got = J.get_dummies(df, "c").orderBy("i").toPandas()
    exp = pd.get_dummies(pdf, columns=["c"], drop_first=True).astype({"c_b": int, "c_c": int})
    assert (got[["c_b", "c_c"]].to_numpy() == exp[["c_b", "c_c"]].to_numpy()).all()


def test_drop_duplicates_keeps_first(spark):
    pdf = pd.DataFrame({"t": [3, 1, 2, 5, 4], "k": ["a", "a", "b", "b", "a"], "v": [1, 2, 3, 4, 5]})
    got = D.drop_duplicates(spark.createDataFrame(pdf), ["k"], ["t"]).orderBy("k").toPandas()
    exp = pdf.sort_values("t").drop_duplicates(subset=["k"]).sort_values("k")
    assert got["v"].tolist() == exp["v"].tolist()


def test_pivot_table_drops_all_missing_columns(spark):
    pdf = pd.DataFrame({"r": ["a", "a", "b"], "c": ["x", "y", "x"], "v": [1.0, None, 3.0]})
    from flowframe.operators import group as G
    got = G.pivot_table(spark.createDataFrame(pdf), ["r"], "c", "v", "mean", levels=["x", "y"])
    exp = pdf.pivot_table(index="r", columns="c", values="v", aggfunc="mean")
    assert sorted(c for c in got.columns if c != "r") == sorted(exp.columns)

"""Operators under a hot key (one key holding most rows), against pandas/NumPy."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from flowframe.operators import combine as E
from flowframe.operators import clean as D
from flowframe.operators.stats import quantiles


def test_asof_join_hot_key(spark):
    rng = np.random.default_rng(11)
    n = 2000
    lk = np.where(rng.random(n) < 0.75, 0, rng.integers(1, 10, n))
    left = pd.DataFrame({"k": lk.astype("int64"), "t": rng.permutation(n * 3)[:n].astype("int64"),
                         "lid": np.arange(n, dtype="int64")})
    m = 600
    rk = np.where(rng.random(m) < 0.75, 0, rng.integers(1, 10, m))
    right = pd.DataFrame({"k": rk.astype("int64"), "rt": rng.permutation(n * 3)[:m].astype("int64"),
                          "rv": rng.normal(size=m)})
    exp = pd.merge_asof(left.sort_values("t"), right.sort_values("rt"), left_on="t", right_on="rt",
                        by="k", direction="backward").sort_values("lid")
    lsp = spark.createDataFrame(left).withColumn("t", F.col("t").cast("timestamp"))
    rsp = spark.createDataFrame(right).withColumn("rt", F.col("rt").cast("timestamp"))
    got = E.merge_asof(lsp, rsp, on="t", right_on="rt", by="k").toPandas().sort_values("lid")
    np.testing.assert_allclose(got["rv"].to_numpy(dtype=float), exp["rv"].to_numpy(dtype=float), equal_nan=True)


def test_quantiles_hot_group(spark):
    rng = np.random.default_rng(5)
    n = 5000
    g = np.where(rng.random(n) < 0.8, 0, rng.integers(1, 6, n))
    x = rng.normal(size=n).round(2)       # many ties
    pdf = pd.DataFrame({"g": g.astype("int64"), "x": x})
    got = quantiles(spark.createDataFrame(pdf), "x", [0.1, 0.5, 0.99], ["g"], ["a", "b", "c"]).toPandas()
    got = got.sort_values("g").reset_index(drop=True)
    exp = pdf.groupby("g")["x"].quantile([0.1, 0.5, 0.99]).unstack().reset_index()
    np.testing.assert_allclose(got[["a", "b", "c"]].to_numpy(), exp[[0.1, 0.5, 0.99]].to_numpy(), rtol=1e-12)


def test_drop_duplicates_hot_group(spark):
    rng = np.random.default_rng(9)
    n = 3000
    pdf = pd.DataFrame({"k": np.where(rng.random(n) < 0.9, 0, rng.integers(1, 50, n)).astype("int64"),
                        "t": rng.permutation(n).astype("int64"), "v": rng.normal(size=n)})
    got = D.drop_duplicates(spark.createDataFrame(pdf), ["k"], ["t"]).toPandas().sort_values("k")
    exp = pdf.sort_values("t").drop_duplicates(subset=["k"]).sort_values("k")
    np.testing.assert_allclose(got["v"].to_numpy(), exp["v"].to_numpy())


def test_quantiles_hot_value(spark):
    rng = np.random.default_rng(8)
    n = 4000
    x = np.where(rng.random(n) < 0.4, 0.0, rng.normal(size=n).round(3))   # 40 % zeros
    pdf = pd.DataFrame({"x": x})
    got = quantiles(spark.createDataFrame(pdf), "x", [0.05, 0.3, 0.5, 0.75]).toPandas().iloc[0].to_numpy()
    exp = pdf["x"].quantile([0.05, 0.3, 0.5, 0.75]).to_numpy()
    np.testing.assert_allclose(got, exp, rtol=1e-12, atol=1e-12)

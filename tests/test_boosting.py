"""Histogram boosting against a plain rebuild of the same trees."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from flowframe.operators import boosting as B
from flowframe.operators import explain as X
from flowframe.operators import models as K


def table(spark, n=600, holes=True, seed=4):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, 4)), 1)
    y = 3 * x[:, 0] + x[:, 1] * (x[:, 2] > 0) + 0.2 * rng.normal(size=n)
    pdf = pd.DataFrame(x, columns=list("abcd")).assign(id=np.arange(n), y=y)
    if holes:
        pdf.loc[rng.random(n) < 0.2, "a"] = np.nan
    frame = spark.createDataFrame(pdf)
    return pdf, frame.withColumn("a", F.when(~F.isnan("a"), F.col("a")))


def plain(x, y, n_iter, rate, max_leaves, min_leaf):
    """Boosting by exhaustive search over rows, the leaf of greatest gain first."""
    p = np.full(len(y), y.mean())
    for _ in range(n_iter):
        r = y - p
        leaves = [np.arange(len(y))]
        while len(leaves) < max_leaves:
            best = (1e-9, None)
            for li, rows in enumerate(leaves):
                for j in range(x.shape[1]):
                    v, hole = x[rows, j], np.isnan(x[rows, j])
                    seen = np.unique(x[~np.isnan(x[:, j]), j])
                    for t in (seen[1:] + seen[:-1]) / 2:
                        for side in ((False, True) if hole.any() else (False,)):
                            left = (v <= t) | (hole & side)
                            if min(left.sum(), (~left).sum()) < min_leaf:
                                continue
                            g = lambda m: r[rows[m]].sum() ** 2 / m.sum()
                            gain = g(left) + g(~left) - r[rows].sum() ** 2 / len(rows)
                            if gain > best[0] + 1e-9:
                                best = (gain, (li, left))
            if best[1] is None:
                break
            li, left = best[1]
            rows = leaves.pop(li)
            leaves += [rows[left], rows[~left]]
        for rows in leaves:
            p[rows] += rate * r[rows].mean()
    return p


@pytest.mark.parametrize("holes", [False, True])
def test_trees_match_a_plain_search(spark, holes):
    pdf, df = table(spark, 300, holes)
    model = B.fit_histogram(df, list("abcd"), "y", n_iter=3, learning_rate=0.5, max_leaves=6, min_leaf=15)
    assert [sum(n[0] < 0 for n in t) for t in model.trees] == [6, 6, 6]
    got = model.transform(df).orderBy("id").toPandas()
    exp = plain(pdf[list("abcd")].to_numpy(), pdf["y"].to_numpy(), 3, 0.5, 6, 15)
    assert got["prediction"].to_numpy() == pytest.approx(exp, abs=1e-9)
    phi = X.tree_shap(model.leaves(), df, "id", list("abcd")).groupBy("id").agg((F.sum("phi") + F.max("base")).alias("s")).orderBy("id").toPandas()
    assert phi["s"].to_numpy() == pytest.approx(exp, abs=1e-9)


def test_error_is_no_worse_than_the_plain_form(spark):
    _, df = table(spark, 800, holes=False)
    train, test = df.where("id < 600"), df.where("id >= 600")
    model = B.fit_histogram(train, list("abcd"), "y", n_iter=25, learning_rate=0.2, max_leaves=8)
    own = model.transform(test).agg(F.avg((F.col("prediction") - F.col("y")) ** 2)).first()[0]
    other = K.gbt_regressor(25, 0.2, 3, label="y").fit(K.assemble(train, list("abcd"))).transform(K.assemble(test, list("abcd")))
    assert own <= 1.1 * other.agg(F.avg((F.col("prediction") - F.col("y")) ** 2)).first()[0]


def test_short_and_flat_tables(spark):
    _, df = table(spark, 60)
    none = B.fit_histogram(df.where("false"), list("abcd"), "y", n_iter=3)
    assert [r["prediction"] for r in none.transform(df).collect()] == [0.0] * 60
    assert none.transform(df.where("false")).count() == 0
    flat = B.fit_histogram(df.withColumn("y", F.lit(2.5)), list("abcd"), "y", n_iter=3)
    assert {r["prediction"] for r in flat.transform(df).collect()} == {2.5}
    one = B.fit_histogram(df.withColumn("k", F.lit(1.0)), ["k"], "y", n_iter=2)
    assert all(len(t) == 1 for t in one.trees)

"""Short series, zero labels, unknown levels and statistics of training rows only."""

import math

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from flowframe.operators import explain as X
from flowframe.operators import forecast as FC
from flowframe.operators import kernels as KM
from flowframe.operators import metrics as M
from flowframe.operators import models as K
from flowframe.operators import tuning as TU


def _series(spark):
    rows = [("long", f"2024-01-{d:02d}", float(d % 5)) for d in range(1, 21)] + [("one", "2024-01-01", 4.0)] + [
        ("three", f"2024-01-0{d}", 1.0 * d) for d in (1, 2, 3)]
    return spark.createDataFrame(rows, "k string, day string, v double").withColumn("day", F.to_date("day"))


@pytest.mark.parametrize("method,missing", [("naive", set()), ("drift", {"one"}), ("seasonal_naive", {"one", "three"})])
def test_forecast_of_short_series_is_missing(spark, method, missing):
    got = FC.forecast(_series(spark), ["k"], "day", "v", 3, method).toPandas()
    assert len(got) == 9
    for k, g in got.groupby("k"):
        first = g[g["step"] == 1]["point"].isna().all()
        assert first == (k in missing), (k, method)


def test_forecast_uses_the_whole_history_by_default(spark):
    rows = [("a", f"2024-{m:02d}-{d:02d}", float(m)) for m in (1, 2, 3) for d in range(1, 29)]
    df = spark.createDataFrame(rows, "k string, day string, v double").withColumn("day", F.to_date("day"))
    assert FC.forecast(df, ["k"], "day", "v", 1, "drift").first()["point"] == pytest.approx(3 + 2 / 83)
    assert FC.forecast(df, ["k"], "day", "v", 1, "drift", context=29).first()["point"] == pytest.approx(3 + 1 / 28)


def test_recursive_forecast_of_short_series_is_missing(spark):
    got = FC.recursive_forecast(_series(spark), ["k"], "day", "v", n_lags=5, horizon=2).toPandas()
    assert sorted(got["k"]) == ["long", "long", "one", "one", "three", "three"]
    assert got[got["k"] == "long"]["forecast"].notna().all() and got[got["k"] != "long"]["forecast"].isna().all()


def test_metrics_with_zero_and_constant_labels(spark):
    df = spark.createDataFrame([("a", 0.0, 1.0), ("a", 2.0, 1.0), ("b", 3.0, 3.0), ("b", 3.0, 5.0)], "k string, y double, p double")
    got = {r["k"]: r for r in M.regression_metrics(df, "y", "p", ["k"]).collect()}
    assert got["a"]["mape"] == 0.5 and got["a"]["r2"] == 0.0
    assert got["b"]["r2"] is None and got["b"]["mape"] == pytest.approx(1 / 3)
    one = spark.createDataFrame([(1, 0.3), (1, 0.4)], "y int, s double")
    assert M.roc_auc(one, "y", "s").first()[0] is None


def test_unknown_and_missing_levels_are_all_zeros(spark):
    train = spark.createDataFrame([(1.0, "x"), (2.0, "y"), (6.0, "z")], "n double, c string")
    model = Pipeline(stages=K.column_transformer(["n"], ["c"])).fit(train)
    new = spark.createDataFrame([(1.0, "x"), (2.0, "q"), (3.0, None), (6.0, "z")], "n double, c string")
    got = [r[0] for r in model.transform(new).select(vector_to_array("features")).collect()]
    sd = math.sqrt(((1 - 3) ** 2 + (2 - 3) ** 2 + (6 - 3) ** 2) / 3)
    assert [g[1:] for g in got] == [[1, 0, 0], [0, 0, 0], [0, 0, 0], [0, 0, 1]]
    assert [g[0] for g in got] == pytest.approx([(v - 3) / sd for v in (1, 2, 3, 6)])


def test_kernel_scaling_does_not_look_at_test_rows(spark):
    rows = [(float(i), float(i % 7), float(i * 2 + i % 7)) for i in range(60)]
    train = spark.createDataFrame(rows[:40], "a double, b double, y double")
    test = spark.createDataFrame(rows[40:], "a double, b double, y double")
    first = KM.rbf_regression(train, test, ["a", "b"], "y", landmarks=20).where("a = 41").first()["prediction"]
    shifted = test.unionByName(spark.createDataFrame([(1e6, 1e6, 0.0)], "a double, b double, y double"))
    again = KM.rbf_regression(train, shifted, ["a", "b"], "y", landmarks=20).where("a = 41").first()["prediction"]
    assert first == pytest.approx(again)


def test_penalty_is_set_by_the_training_rows_of_each_fold(spark):
    df = spark.createDataFrame([(i, float(i % 4), float(i)) for i in range(36)], "t int, x double, y double")
    seen = []

    def make(train):
        seen.append(train.count())
        return TU.scaled(K.linear_estimator("ols", label="y"))

    assert len(TU.ts_cross_val(df, ["t"], ["x"], "y", make, 5)) == 5
    assert sorted(seen) == [6, 12, 18, 24, 30]


def test_exact_shapley_values_of_a_forest(spark):
    rows = [(i, float(i % 3), float(i % 5), float(i % 7), float((i % 3) * (i % 5) + i % 7)) for i in range(80)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, y double")
    feats = ["a", "b", "c"]
    model = K.random_forest_regressor(10, 5, label="y").fit(K.assemble(df, feats))
    phi = X.exact_shap(model, df, "id", feats)
    total = phi.groupBy("id").agg((F.sum("phi") + F.first("base")).alias("t"))
    pred = model.transform(K.assemble(df, feats)).select("id", "prediction")
    assert total.join(pred, "id").where(F.abs(F.col("t") - F.col("prediction")) > 1e-9).count() == 0
    # a linear model's values are known: weight times distance from the mean
    lin = K.fit_linear(df, feats, "y", "ols")
    means = df.agg(*[F.avg(f).alias(f) for f in feats]).first()
    exact = {(r["id"], r["feature"]): r["phi"] for r in X.exact_shap(lin, df, "id", feats).collect()}
    for r in rows[:10]:
        for j, f in enumerate(feats):
            assert exact[r[0], f] == pytest.approx(float(lin.coefficients[j]) * (r[j + 1] - means[f]), abs=1e-8)


def test_grid_search_for_a_classifier_pipeline(spark):
    df = spark.createDataFrame([(i, float(i % 10), int(i % 10 > 4)) for i in range(120)], "id long, x double, y int")
    got = TU.grid_search(df, ["id"], ["x"], "y", TU.scaled(K.decision_tree(3, label="y")), {"maxDepth": [1, 3]}, metric="accuracy")
    assert got.columns == ["setting", "accuracy"] and got.count() == 2
    assert all(r["accuracy"] == 1.0 for r in got.collect())


def test_folds_of_a_grid_search_are_fitted_together(spark):
    import threading

    from pyspark.ml.evaluation import RegressionEvaluator
    from pyspark.ml.regression import LinearRegression
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder

    from flowframe.operators import split as SP
    meet, fits = threading.Barrier(3), []

    class Meeting(LinearRegression):
        def _fit(self, dataset):
            fits.append(1)
            if len(fits) <= 3:  # the three folds of the first setting wait for each other
                meet.wait(60)
            return super()._fit(dataset)

    df = spark.createDataFrame([(i, float(i), float(i * 3 % 17 + i)) for i in range(90)], "id long, x double, y double")
    got = TU.grid_search(df, ["id"], ["x"], "y", Meeting(labelCol="y"), {"regParam": [0.0, 5.0]})
    plain = LinearRegression(labelCol="y")
    maps = ParamGridBuilder().addGrid(plain.regParam, [0.0, 5.0]).build()
    cv = CrossValidator(estimator=plain, estimatorParamMaps=maps, numFolds=3, foldCol="_fold", evaluator=RegressionEvaluator(labelCol="y"))
    want = cv.fit(K.assemble(SP.kfold(df, ["id"], 3, 42, name="_fold"), ["x"])).avgMetrics
    assert sorted(r["rmse"] for r in got.collect()) == pytest.approx(sorted(want))
    assert len(fits) == 7  # six, and the best setting on all rows


def test_columns_by_type(spark):
    from flowframe.operators import select as S
    df = spark.sql("SELECT 1 AS i, 2.5D AS d, true AS b, 'x' AS s, array(1) AS a, DATE'2024-01-01' AS t")
    assert S.select_dtypes(df).columns == ["i", "d"]
    assert S.select_dtypes(df, ["bool", "datetime"]).columns == ["b", "t"]
    assert S.select_dtypes(df, exclude="number").columns == ["b", "s", "a", "t"]
    assert S.select_dtypes(df, "object", "object").columns == []
    with pytest.raises(ValueError):
        S.select_dtypes(df, "category")

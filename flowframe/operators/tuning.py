"""Cross-validation, model comparison, hyper-parameter search and permutation
importance (inventory K16-K19, J13).

Folds come from the deterministic split operators; each fit is a distributed
Spark ML job; the driver loops only over folds, models and settings (small,
fixed counts) and keeps their scores.
"""

from __future__ import annotations

import itertools
from concurrent.futures import ThreadPoolExecutor
from typing import Callable, Sequence

import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.regression import RandomForestRegressor
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowframe.operators import forest as FO
from flowframe.operators import order as O
from flowframe.operators import split as SP
from flowframe.operators.models import FEATURES, PopulationScaler, assemble
from flowframe.session import checkpoint

#: Most fits of a grid search at a time: the driver holds the model of each.
GRID_FITS = 8


def _rmse(pred: DataFrame, label: str) -> float:
    return float(pred.agg(F.sqrt(F.avg((F.col(label) - F.col("prediction")) ** 2))).first()[0])


def ts_folds(df: DataFrame, order, n_splits: int = 5) -> DataFrame:
    """The rows of every fold with their role, written once for all models and settings."""
    return checkpoint(SP.time_series_split(df, [], order, n_splits))


def scaled(estimator) -> Pipeline:
    """A scaler and a model as one estimator, so that every fold scales by its own training rows."""
    return Pipeline(stages=[PopulationScaler(FEATURES, "_scaled"), estimator.copy().setFeaturesCol("_scaled")])


def ts_cross_val(df: DataFrame, order, features: Sequence[str], label: str, make_estimator: Callable[[DataFrame], object],
                 n_splits: int = 5, parallelism: int = 4, folds: DataFrame | None = None) -> list[tuple[int, float]]:
    """``cross_val_score(pipe, cv=TimeSeriesSplit(n))``: for each fold, fit on
    the expanding past, score RMSE on the next block.  (``CrossValidator`` would
    train on future folds too, so it is not used for time series.)  Folds are
    fitted as concurrent Spark jobs, like ``CrossValidator(parallelism)``.
    ``make_estimator`` gets the fold's training rows, so penalties and scales look at
    nothing else."""
    folds = ts_folds(df, order, n_splits) if folds is None else folds

    def one(k):
        f = folds.where(F.col("fold") == k)
        tr = assemble(f.where(F.col("role") == "train"), features)
        te = assemble(f.where(F.col("role") == "test"), features)
        model = make_estimator(tr).fit(tr)
        return (k, _rmse(model.transform(te), label))

    with ThreadPoolExecutor(max(1, parallelism)) as ex:
        return list(ex.map(one, range(n_splits)))


def compare_models(df: DataFrame, order, features: Sequence[str], label: str,
                   models: dict[str, Callable], n_splits: int = 5) -> DataFrame:
    """Per model the time-series CV RMSE per fold; the best model (lowest
    mean RMSE) is flagged.  Output (model, fold, rmse, mean_rmse, best)."""
    rows = []
    folds = ts_folds(df, order, n_splits)
    with ThreadPoolExecutor(len(models)) as ex:
        res = ex.map(lambda kv: (kv[0], ts_cross_val(df, order, features, label, kv[1], n_splits, folds=folds)),
                     models.items())
        for name, scores in res:
            rows += [(name, fold, rmse) for fold, rmse in scores]
    spark = df.sparkSession
    t = spark.createDataFrame(rows, "model STRING, fold INT, rmse DOUBLE")
    means = t.groupBy("model").agg(F.avg("rmse").alias("mean_rmse"))
    best = means.agg(F.min_by("model", "mean_rmse").alias("_best"))
    return t.join(means, "model").withColumn("best", F.col("model") == best.scalar())


def grid_search(df: DataFrame, id_cols: Sequence[str], features: Sequence[str], label: str, estimator,
                grid: dict, folds: int = 3, seed: int = 42, parallelism: int | None = None, metric: str = "rmse") -> DataFrame:
    """``GridSearchCV(est, grid, cv=folds)`` over a ``ParamGridBuilder`` grid with
    deterministic hashed folds, stratified by the label for the classifier metrics ``accuracy``
    and ``f1``.  Fits and scores are those of Spark's ``CrossValidator``, which ends one fold before it
    begins the next; here the fits of all folds are concurrent Spark jobs (``parallelism``; else
    the cluster's cores, ``GRID_FITS`` at most), and the best setting is fitted to all rows at the end.
    ``estimator`` may be a pipeline ending in the model whose parameters the grid names.
    Forests of a training set that fits a task are grown in tasks by the same rules (with bootstrap draws of their own), all
    settings and folds in one job (:mod:`flowframe.operators.forest`).
    Output one row per setting: (setting, <metric>) sorted by the caller."""
    classify = metric in ("accuracy", "f1")
    d = SP.kfold(df, id_cols, folds, seed, label=label if classify else None, name="_fold")
    judge = (MulticlassClassificationEvaluator(labelCol=label, metricName=metric) if classify
             else RegressionEvaluator(labelCol=label, metricName=metric))
    tuned = estimator.getStages()[-1] if isinstance(estimator, Pipeline) else estimator
    b = ParamGridBuilder()
    for p, vals in grid.items():
        b = b.addGrid(tuned.getParam(p), list(vals))
    maps = b.build()
    rows = assemble(d, features)

    def listed(scores: Sequence[float]) -> DataFrame:
        found = [(", ".join(f"{k.name}={v}" for k, v in sorted(pm.items(), key=lambda kv: kv[0].name)), float(s))
                 for pm, s in zip(maps, scores)]
        return df.sparkSession.createDataFrame(found, f"setting STRING, {metric} DOUBLE")

    if metric == "rmse" and isinstance(estimator, RandomForestRegressor):
        rows = checkpoint(rows)
        sizes = {r["_fold"]: r["count"] for r in rows.groupBy("_fold").count().collect()}
        settings = [estimator.copy(pm) for pm in maps]
        if len(sizes) == folds > 1 and all(FO.fits(est, rows, sum(sizes.values())) for est in settings):
            data = checkpoint(FO.packed(rows, id_cols, label))
            by = {r["setting"]: r["rmse"] for r in FO.fold_errors(data, settings, folds).groupBy("setting").agg(F.avg("rmse").alias("rmse")).collect()}
            scores = [by[i] for i in range(len(maps))]
            checkpoint(FO.fitted(data, settings[int(np.argmin(scores))]))
            return listed(scores)
    parts = [(rows.where(F.col("_fold") != k).cache(), rows.where(F.col("_fold") == k).cache()) for k in range(folds)]

    def one(task):
        pm, (train, test) = task
        return float(judge.evaluate(estimator.fit(train, pm).transform(test)))

    try:
        with ThreadPoolExecutor(parallelism or max(1, min(GRID_FITS, df.sparkSession.sparkContext.defaultParallelism))) as ex:
            scores = np.array(list(ex.map(one, itertools.product(maps, parts)))).reshape(len(maps), folds).mean(axis=1)
    finally:
        for part in itertools.chain(*parts):
            part.unpersist()
    best = (np.argmax if judge.isLargerBetter() else np.argmin)(scores)
    estimator.fit(rows, maps[int(best)])
    return listed(scores)


def random_search(df: DataFrame, order, features: Sequence[str], label: str, make_estimator: Callable,
                  grid: dict, n_iter: int = 10, seed: int = 42, n_splits: int = 5) -> DataFrame:
    """``RandomizedSearchCV``: ``n_iter`` settings drawn without replacement
    from the grid with a seed, each scored by time-series CV (mean RMSE)."""
    keys = sorted(grid)
    settings = list(itertools.product(*[grid[k] for k in keys]))
    rng = np.random.default_rng(seed)
    pick = rng.choice(len(settings), size=min(n_iter, len(settings)), replace=False)
    folds = ts_folds(df, order, n_splits)

    def one(i):
        params = dict(zip(keys, settings[i]))
        scores = ts_cross_val(df, order, features, label, lambda tr: make_estimator(**params), n_splits, folds=folds)
        return (", ".join(f"{k}={params[k]}" for k in keys), float(np.mean([s for _, s in scores])))

    with ThreadPoolExecutor(4) as ex:
        rows = list(ex.map(one, sorted(int(p) for p in pick)))
    return df.sparkSession.createDataFrame(rows, "setting STRING, mean_rmse DOUBLE")


def permutation_importance(model, df: DataFrame, id_col: str, features: Sequence[str], label: str,
                           n_repeats: int = 10, seed: int = 42) -> DataFrame:
    """Drop of R^2 when one feature column is permuted, per (feature,
    repeat).  In variant (f, r) the row ranked p by ``xxhash64(id, seed, f, r)``
    gives its value of f to the row ranked p by id.  Only (variant, rank, value) is
    shuffled into order for the ``len(features) * n_repeats`` variants; the rows
    themselves move once, by rank, and are scored in one transform.  Output
    (feature, repeat, drop)."""
    d = checkpoint(O.positions(df.select(id_col, label, *features), [], [id_col], "_p"))
    base_r2 = _r2(model.transform(assemble(d, features)), label)
    values = F.array(*[F.struct(F.lit(fi).alias("_fi"), F.col(f).cast("double").alias("_pv")) for fi, f in enumerate(features)])
    donors = (d.select("_p", id_col, F.explode(values).alias("v")).select("_p", id_col, "v.*")
               .withColumn("_r", F.explode(F.sequence(F.lit(0), F.lit(n_repeats - 1)))))
    donors = donors.select("_fi", "_r", "_p", "_pv", F.xxhash64(F.col(id_col), F.lit(seed), F.col("_fi"), F.col("_r")).alias("_h"))
    moved = O.positions(donors, ["_fi", "_r"], ["_h", "_p"], "_q").select("_fi", "_r", F.col("_q").alias("_p"), "_pv")
    v = moved.join(d.drop(id_col), "_p")
    v = v.withColumns({f: F.when(F.col("_fi") == fi, F.col("_pv")).otherwise(F.col(f).cast("double"))
                       for fi, f in enumerate(features)})
    scored = model.transform(assemble(v, features))
    e = F.col(label) - F.col("prediction")
    r2 = scored.groupBy("_fi", "_r").agg((1 - F.try_divide(F.sum(e * e), F.var_pop(label) * F.count(F.lit(1)))).alias("_r2"))
    names = F.array(*[F.lit(f) for f in features])
    return r2.select(F.element_at(names, F.col("_fi") + 1).alias("feature"), F.col("_r").alias("repeat"),
                     (F.lit(base_r2) - F.col("_r2")).alias("drop"))


def _r2(pred: DataFrame, label: str) -> float:
    e = F.col(label) - F.col("prediction")
    found = pred.agg(1 - F.try_divide(F.sum(e * e), F.var_pop(label) * F.count(F.lit(1)))).first()[0]
    return float("nan") if found is None else float(found)

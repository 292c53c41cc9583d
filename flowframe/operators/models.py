"""Models, preprocessing pipelines and model-based feature selection
(inventory K1-K7, K9-K11, K13-K15, J10-J12) on Spark ML.

Fitting is distributed by Spark ML; only fitted parameters (coefficients,
importances, a handful of scalars) come back to the driver.  Parameter mapping
from the reference's defaults follows SURVEY section 8.
"""

from __future__ import annotations

import math
from typing import Sequence

import numpy as np
from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.clustering import BisectingKMeans, KMeans
from pyspark.ml.feature import (ElementwiseProduct, OneHotEncoder, PCA, StandardScaler, StringIndexer,
                                UnivariateFeatureSelector, VectorAssembler, VectorSlicer)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FEATURES = "features"

# Tree training runs one job per tree level; a larger node-group memory lets
# more nodes of all trees share each level's job, and cached node ids avoid
# re-walking the trees for every row.
TREE_TUNING = {"maxMemoryInMB": 1024, "cacheNodeIds": True}


def assemble(df: DataFrame, cols: Sequence[str], out: str = FEATURES) -> DataFrame:
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="keep").transform(df)


def _n_and_std(df: DataFrame, label: str) -> tuple[int, float]:
    r = df.agg(F.count(F.lit(1)).alias("n"), F.stddev_pop(label).alias("s")).first()
    return int(r["n"]), float(r["s"] or 0.0)


# ---------------------------------------------------------------- K1-K3 linear family

def linear_estimator(kind: str = "ols", alpha: float = 1.0, n: int | None = None,
                     y_std: float | None = None, label: str = "label") -> LinearRegression:
    """K1/K2: ordinary least squares, ridge (sum loss + alpha |w|^2) or lasso
    (mean loss + alpha |w|_1).  Spark scales the penalty by the label spread and
    uses a mean loss, hence ``regParam = alpha * std_pop(y) / n`` for ridge (S26)."""
    if kind == "ols":
        return LinearRegression(labelCol=label, solver="normal", regParam=0.0, standardization=False)
    if kind == "ridge":
        return LinearRegression(labelCol=label, solver="normal", elasticNetParam=0.0,
                                regParam=alpha * (y_std or 1.0) / max(n or 1, 1), standardization=False)
    if kind == "lasso":
        return LinearRegression(labelCol=label, elasticNetParam=1.0, regParam=alpha,
                                standardization=False, maxIter=1000, tol=1e-10)
    raise ValueError(kind)


def fit_linear(df: DataFrame, features: Sequence[str], label: str, kind: str = "ols", alpha: float = 1.0):
    n, s = _n_and_std(df, label)
    return linear_estimator(kind, alpha, n, s, label).fit(assemble(df, features))


def coefficients(model, features: Sequence[str], name: str) -> DataFrame:
    """Fitted linear coefficients as a small table (model, feature, coef)."""
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    rows = [(name, f, float(c)) for f, c in zip(features, model.coefficients)]
    rows.append((name, "(intercept)", float(model.intercept)))
    return spark.createDataFrame(rows, "model STRING, feature STRING, coef DOUBLE")


def random_fourier(df: DataFrame, cols: Sequence[str], n_components: int = 100, gamma: float | None = None,
                   seed: int = 42, prefix: str = "rff", fit_on: DataFrame | None = None) -> tuple[DataFrame, list[str]]:
    """RBF kernel features as columns for pipelines of Spark models (K17): random Fourier features
    ``sqrt(2/D) cos(w.x + b)`` with ``w ~ N(0, 2 gamma)`` (Rahimi & Recht 2007).
    ``gamma`` defaults to 1 / (d * var(X)) (the 'scale' rule); inputs are
    standardised first so the kernel width is comparable across columns, with the
    statistics of ``fit_on`` (the training rows; default: ``df``)."""
    d = len(cols)
    std = (df if fit_on is None else fit_on).agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)],
                 *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(cols)]).first()
    z = [(F.col(c) - std[f"m{i}"]) / (std[f"s{i}"] or 1.0) for i, c in enumerate(cols)]
    g = gamma if gamma is not None else 1.0 / d
    rng = np.random.default_rng(seed)
    W = rng.normal(0.0, math.sqrt(2 * g), size=(n_components, d))
    b = rng.uniform(0, 2 * math.pi, size=n_components)
    scale = math.sqrt(2.0 / n_components)
    names = [f"{prefix}_{k}" for k in range(n_components)]
    exprs = {}
    for k in range(n_components):
        lin = F.lit(float(b[k]))
        for i in range(d):
            lin = lin + F.lit(float(W[k, i])) * z[i]
        exprs[names[k]] = F.lit(scale) * F.cos(lin)
    return df.withColumns(exprs), names


# ---------------------------------------------------------------- K4, K5 trees

def random_forest_regressor(n_estimators: int = 100, max_depth: int | None = None, seed: int = 42,
                            min_samples_leaf: int = 1, label: str = "label") -> RandomForestRegressor:
    """K4: ``RandomForestRegressor``; depth None -> 30 (Spark's ceiling); all
    features considered at each split as in sklearn's regression default."""
    return RandomForestRegressor(labelCol=label, numTrees=n_estimators, maxDepth=max_depth or 30, seed=seed,
                                 minInstancesPerNode=min_samples_leaf, featureSubsetStrategy="all",
                                 **TREE_TUNING)


def gbt_regressor(n_estimators: int = 100, learning_rate: float = 0.1, max_depth: int = 3,
                  seed: int = 42, label: str = "label") -> GBTRegressor:
    """K5: gradient boosting, plain form (level by level); the histogram form is
    :func:`flowframe.operators.boosting.fit_histogram`."""
    return GBTRegressor(labelCol=label, maxIter=n_estimators, stepSize=learning_rate, maxDepth=max_depth,
                        seed=seed, **TREE_TUNING)


# ---------------------------------------------------------------- K6, K7, K9, K10 classifiers

def logistic_regression(n: int, C: float = 1.0, label: str = "label") -> LogisticRegression:
    """K6: ``LogisticRegression(C=1)``: ``regParam = 1 / (C n)``, no standardisation."""
    return LogisticRegression(labelCol=label, regParam=1.0 / (C * max(n, 1)), standardization=False,
                              maxIter=1000, tol=1e-9)


def decision_tree(max_depth: int = 5, label: str = "label") -> DecisionTreeClassifier:
    """K9: ``DecisionTreeClassifier(max_depth=5)``."""
    return DecisionTreeClassifier(labelCol=label, maxDepth=max_depth, seed=42)


def decision_tree_regressor(max_depth: int = 5, label: str = "label") -> DecisionTreeRegressor:
    """``DecisionTreeRegressor(max_depth=5)``."""
    return DecisionTreeRegressor(labelCol=label, maxDepth=max_depth, seed=42)


def random_forest_classifier(n_estimators: int = 100, max_depth: int | None = None, weight_col: str | None = None,
                             seed: int = 42, label: str = "label") -> RandomForestClassifier:
    """``RandomForestClassifier(class_weight=)``; balanced weights come from
    :func:`flowframe.operators.split.class_weights` as ``weightCol``."""
    kw = {"weightCol": weight_col} if weight_col else {}
    return RandomForestClassifier(labelCol=label, numTrees=n_estimators, maxDepth=max_depth or 30, seed=seed,
                                  featureSubsetStrategy="sqrt", **TREE_TUNING, **kw)


# ---------------------------------------------------------------- K11, K13 clustering

def kmeans(k: int = 3, seed: int = 42) -> KMeans:
    """``KMeans(n_clusters=3)``."""
    return KMeans(k=k, seed=seed)


def hierarchical(k: int = 3, seed: int = 42) -> BisectingKMeans:
    """Divisive clustering by bisecting k-means, for tables beyond the square cost of K13's
    :func:`flowframe.operators.agglomerate.agglomerate`."""
    return BisectingKMeans(k=k, seed=seed)


# ---------------------------------------------------------------- K14, K15 pipelines

class PopulationScaler(Estimator):
    """Centre and scale a vector by the population standard deviation (Spark's own
    scaler uses the sample one; S5).  The fitted model is a pipeline of Spark stages."""

    def __init__(self, inputCol: str, outputCol: str):
        super().__init__()
        self.columns = (inputCol, outputCol)

    def _fit(self, df: DataFrame) -> PipelineModel:
        source, target = self.columns
        middle = f"{target}_sample"
        sample = StandardScaler(inputCol=source, outputCol=middle, withMean=True, withStd=True).fit(df)
        n = df.count()
        factor = math.sqrt(n / (n - 1)) if n > 1 else 1.0
        again = ElementwiseProduct(scalingVec=Vectors.dense([factor] * sample.mean.size), inputCol=middle, outputCol=target)
        return PipelineModel([sample, again])


class FourierFeatures(Estimator):
    """RBF features of a vector column as a pipeline stage, scaled on the rows it is fitted on."""

    def __init__(self, features: Sequence[str], outputCol: str, n_components: int = 100, seed: int = 42):
        super().__init__()
        self.spec = (list(features), outputCol, n_components, seed)

    def _fit(self, df: DataFrame) -> "FourierModel":
        return FourierModel(self.spec, df)


class FourierModel(Transformer):
    def __init__(self, spec, train: DataFrame):
        super().__init__()
        self.spec, self.train = spec, train

    def _transform(self, df: DataFrame) -> DataFrame:
        features, out, n, seed = self.spec
        wide, names = random_fourier(df, features, n, seed=seed, fit_on=self.train)
        return assemble(wide, names, out).drop(*names)


def column_transformer(numeric: Sequence[str], categorical: Sequence[str], out: str = FEATURES) -> list:
    """Scale numeric columns (population std, centred) and one-hot encode
    categorical ones (unknown level -> all zeros), assembled to one vector."""
    stages = [VectorAssembler(inputCols=list(numeric), outputCol="_num", handleInvalid="keep"),
              PopulationScaler("_num", "_num_s")]
    oh = []
    for c in categorical:
        stages.append(StringIndexer(inputCol=c, outputCol=f"_{c}_i", handleInvalid="keep",
                                    stringOrderType="alphabetAsc"))
        oh.append(c)
    if oh:
        stages.append(OneHotEncoder(inputCols=[f"_{c}_i" for c in oh], outputCols=[f"_{c}_oh" for c in oh],
                                    dropLast=True, handleInvalid="error"))  # the indexer's slot for unknown levels is the last
    stages.append(VectorAssembler(inputCols=["_num_s", *[f"_{c}_oh" for c in oh]], outputCol=out))
    return stages


def scale_select_model(features: Sequence[str], estimator, k: int | None = None, label: str = "label",
                       task: str = "regression") -> Pipeline:
    """``Pipeline([scaler, SelectKBest(k), model])``."""
    stages = [VectorAssembler(inputCols=list(features), outputCol="_raw", handleInvalid="keep"),
              PopulationScaler("_raw", "_scaled")]
    src = "_scaled"
    if k:
        ftype = "continuous" if task == "regression" else "continuous"
        ltype = "continuous" if task == "regression" else "categorical"
        stages.append(UnivariateFeatureSelector(featuresCol="_scaled", outputCol="_sel", labelCol=label,
                                                selectionMode="numTopFeatures")
                      .setFeatureType(ftype).setLabelType(ltype).setSelectionThreshold(k))
        src = "_sel"
    estimator = estimator.copy().setFeaturesCol(src)
    stages.append(estimator)
    return Pipeline(stages=stages)


# ---------------------------------------------------------------- J10-J12 model-based selection

def rfe(df: DataFrame, features: Sequence[str], label: str, n_select: int = 5, seed: int = 42) -> DataFrame:
    """Recursive feature elimination, one feature per round: fit a forest,
    drop the feature of least importance.  Output (feature, eliminated_round,
    selected); a driver loop of ``len(features) - n_select`` distributed fits."""
    keep = list(features)
    gone = []
    while len(keep) > n_select:
        m = random_forest_regressor(50, 10, seed, label=label).fit(assemble(df, keep))
        imp = m.featureImportances.toArray()
        j = int(np.argmin(imp))
        gone.append((keep[j], len(gone) + 1))
        keep.pop(j)
    rows = [(f, r, False) for f, r in gone] + [(f, None, True) for f in keep]
    return df.sparkSession.createDataFrame(rows, "feature STRING, eliminated_round INT, selected BOOLEAN")


def select_from_model(df: DataFrame, features: Sequence[str], label: str, seed: int = 42) -> DataFrame:
    """``SelectFromModel(threshold='median')``: features whose forest
    importance is at least the median importance, sliced with ``VectorSlicer``."""
    a = assemble(df, features)
    m = random_forest_regressor(50, 10, seed, label=label).fit(a)
    imp = m.featureImportances.toArray()
    thr = float(np.median(imp))
    idx = [i for i, v in enumerate(imp) if v >= thr]
    out = VectorSlicer(inputCol=FEATURES, outputCol="selected", indices=idx).transform(a)
    return out.withColumn("selected", vector_to_array("selected")).drop(FEATURES)


def pca_variance(df: DataFrame, features: Sequence[str], variance: float = 0.95) -> DataFrame:
    """``PCA(n_components=0.95)``: centre the columns (Spark's PCA does not,
    S28), fit all components, keep the fewest whose explained variance reaches
    ``variance``, and project."""
    means = df.agg(*[F.avg(c).alias(c) for c in features]).first()
    c = df.withColumns({f: F.col(f) - F.lit(float(means[f] or 0.0)) for f in features})
    a = assemble(c, features)
    full = PCA(k=len(features), inputCol=FEATURES, outputCol="_pc").fit(a)
    cum = np.cumsum(full.explainedVariance.toArray())
    k = int(np.searchsorted(cum, variance - 1e-12) + 1)
    m = PCA(k=k, inputCol=FEATURES, outputCol="pcs").fit(a)
    return m.transform(a).withColumn("pcs", vector_to_array("pcs")).drop(FEATURES)


def save_load(model: PipelineModel, path: str) -> PipelineModel:
    """Persist a fitted pipeline and read it back."""
    model.write().overwrite().save(path)
    return PipelineModel.load(path)

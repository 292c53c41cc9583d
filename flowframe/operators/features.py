"""Feature engineering (inventory J1-J9, J14, J15).

Fitted parameters (levels, means, spreads, vocabularies) are DataFrames or scalar
subqueries computed on the executors; only bounded things reach the driver: the
list of category levels of a column that becomes columns (its size is checked).
"""

from __future__ import annotations

import glob
import math
import os
import zipfile
from functools import lru_cache
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowframe.operators import order as O
from flowframe.operators import windows as W
from flowframe.operators.order import as_list, join_on_keys
from flowframe.operators.stats import quantiles

TOKEN_PATTERN = r"(?U)\b\w\w+\b"   # fixed value: the vectorizer's default token rule


@lru_cache(maxsize=1)
def english_stop_words() -> tuple[str, ...] | None:
    """Spark ML's default English stop-word list, read from the Spark ML jar (the
    same list ``StopWordsRemover.loadDefaultStopWords('english')`` returns), so no
    JVM is needed to build oracle SQL.  None when no jar is found."""
    import pyspark
    dirs = [os.path.join(os.path.dirname(pyspark.__file__), "jars")]
    if os.environ.get("SPARK_HOME"):
        dirs.append(os.path.join(os.environ["SPARK_HOME"], "jars"))
    for d in dirs:
        for jar in glob.glob(os.path.join(d, "spark-mllib_*.jar")):
            with zipfile.ZipFile(jar) as z:
                return tuple(z.read("org/apache/spark/ml/feature/stopwords/english.txt").decode().split())
    return None


def _stop_words() -> list[str]:
    words = english_stop_words()
    if words is None:
        from pyspark.ml.feature import StopWordsRemover
        words = StopWordsRemover.loadDefaultStopWords("english")
    return list(words)


# ---------------------------------------------------------------- J1 TF-IDF

def tfidf_top_terms(df: DataFrame, id_col: str, text_col: str, max_features: int = 5,
                    stop_words: Sequence[str] | None = None) -> DataFrame:
    """``TfidfVectorizer(max_features, stop_words='english')`` in long sparse
    form ``(id, term, tfidf)``: lowercase tokens of two or more word characters,
    stop words removed, the ``max_features`` terms of highest corpus frequency
    (ties: term ascending), smoothed idf ``ln((1+N)/(1+df)) + 1``, rows scaled to
    unit L2 norm; zero weights are not emitted."""
    stops = list(stop_words if stop_words is not None else _stop_words())
    tok = df.select(id_col, F.explode(F.regexp_extract_all(F.lower(F.col(text_col)), F.lit(TOKEN_PATTERN), 0))
                    .alias("term"))
    tok = tok.where(~F.col("term").isin(stops))
    # counts combine before the shuffle; only tokens of the chosen terms meet their document
    chosen = (tok.groupBy("term").agg(F.count(F.lit(1)).alias("_total"))
                 .orderBy(F.col("_total").desc(), F.col("term")).limit(max_features).select("term"))
    tf = (tok.join(F.broadcast(chosen), "term").groupBy(id_col, "term").agg(F.count(F.lit(1)).alias("tf")))
    n_docs = df.agg(F.count(F.lit(1))).scalar()
    vocab = tf.groupBy("term").agg(F.count(F.lit(1)).alias("_df"))       # max_features rows
    idf = vocab.select("term", (F.log((F.lit(1.0) + n_docs) / (F.lit(1.0) + F.col("_df"))) + 1.0).alias("_idf"))
    w = tf.join(F.broadcast(idf), "term").withColumn("_w", F.col("tf") * F.col("_idf"))
    # at most max_features rows per document: a bounded window
    norm = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(Window.partitionBy(id_col)))
    return w.select(id_col, "term", (F.col("_w") / norm).alias("tfidf"))


# ---------------------------------------------------------------- J2-J5 encoders

def levels(df: DataFrame, col: str) -> list:
    """Sorted distinct non-NULL values of a categorical column.  Each becomes a column of
    the result, so the plan's width, not this list, is what limits their number."""
    vals = df.where(F.col(col).isNotNull()).select(col).distinct().orderBy(col)
    return [r[0] for r in vals.toLocalIterator()]


def get_dummies(df: DataFrame, col: str, drop_first: bool = True, prefix: str | None = None,
                levels_: Sequence | None = None) -> DataFrame:
    """``pd.get_dummies(columns=[col], drop_first=True)``: one 0/1 column per
    sorted level (the first dropped); missing -> all zeros (S25)."""
    lv = list(levels_) if levels_ is not None else levels(df, col)
    prefix = prefix or col
    use = lv[1:] if drop_first else lv
    cols = {f"{prefix}_{v}": (F.col(col) == F.lit(v)).cast("int") for v in use}
    return df.withColumns({k: F.coalesce(c, F.lit(0)) for k, c in cols.items()}).drop(col)


def one_hot(df: DataFrame, col: str, fitted_levels: Sequence, prefix: str | None = None) -> DataFrame:
    """``OneHotEncoder(handle_unknown='ignore')`` with levels fitted elsewhere:
    unknown or missing level -> all zeros; no level dropped."""
    prefix = prefix or col
    return df.withColumns({f"{prefix}_{v}": F.coalesce((F.col(col) == F.lit(v)).cast("int"), F.lit(0))
                           for v in fitted_levels})


def label_encode(df: DataFrame, col: str, name: str | None = None) -> DataFrame:
    """``LabelEncoder``: code = index of the value among sorted levels, from the
    scalable row index over the distinct values; no level passes the driver.  A missing
    value sorts after all others, as one more level."""
    name = name or f"{col}_label"
    codes = O.positions(df.select(col).distinct(), [], [col], name)
    return join_on_keys(df, codes.withColumn(name, F.col(name).cast("int")), [col], "left")


def ordinal_encode(df: DataFrame, col: str, categories: Sequence, name: str | None = None) -> DataFrame:
    """``OrdinalEncoder(categories=[order])``: code = position in the given
    order; an unknown level raises an error, as the encoder does."""
    name = name or f"{col}_ord"
    expr = None
    for i, v in enumerate(categories):
        cond = F.col(col) == F.lit(v)
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    expr = expr.when(F.col(col).isNull(), F.lit(None)).otherwise(
        F.raise_error(F.concat(F.lit(f"unknown category in {col}: "), F.col(col))))
    return df.withColumn(name, expr.cast("int"))


# ---------------------------------------------------------------- J6-J8 scalers

def standard_scale(df: DataFrame, cols: Sequence[str], suffix: str = "_std") -> DataFrame:
    """``StandardScaler``: (x - mean) / population std; zero spread -> divisor 1."""
    one = df.agg(*[F.avg(c).alias(f"m_{c}") for c in cols], *[F.stddev_pop(c).alias(f"s_{c}") for c in cols])
    out = {}
    for c in cols:
        m, s = one.select(f"m_{c}").scalar(), one.select(f"s_{c}").scalar()
        out[f"{c}{suffix}"] = (F.col(c) - m) / F.when(s == 0, F.lit(1.0)).otherwise(s)
    return df.withColumns(out)


def minmax_scale(df: DataFrame, cols: Sequence[str], suffix: str = "_mm") -> DataFrame:
    """``MinMaxScaler``: (x - min) / (max - min); constant column -> 0."""
    one = df.agg(*[F.min(c).alias(f"lo_{c}") for c in cols], *[F.max(c).alias(f"hi_{c}") for c in cols])
    out = {}
    for c in cols:
        lo, hi = one.select(f"lo_{c}").scalar(), one.select(f"hi_{c}").scalar()
        rng = hi - lo
        out[f"{c}{suffix}"] = (F.col(c) - lo) / F.when(rng == 0, F.lit(1.0)).otherwise(rng)
    return df.withColumns(out)


def robust_scale(df: DataFrame, cols: Sequence[str], suffix: str = "_rob") -> DataFrame:
    """``RobustScaler``: (x - median) / (q75 - q25) with exact quantiles."""
    out = {}
    for c in cols:
        q = quantiles(df, c, [0.25, 0.5, 0.75], names=["a", "m", "b"])
        a, m, b = (q.select(x).scalar() for x in ("a", "m", "b"))
        iqr = b - a
        out[f"{c}{suffix}"] = (F.col(c) - m) / F.when(iqr == 0, F.lit(1.0)).otherwise(iqr)
    return df.withColumns(out)


# ---------------------------------------------------------------- J9 univariate selection

def f_regression(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """``f_regression`` scores ``F = r^2 / (1 - r^2) * (n - 2)`` per feature,
    one aggregate pass; output (feature, f_score, rank)."""
    one = df.agg(F.count(F.lit(1)).alias("n"), *[F.corr(f, target).alias(f"r_{i}") for i, f in enumerate(features)])
    rows = [F.struct(F.lit(f).alias("feature"),
                     (F.try_divide(F.col(f"r_{i}") ** 2, 1 - F.col(f"r_{i}") ** 2) * (F.col("n") - 2)).alias("f_score"))
            for i, f in enumerate(features)]
    return _ranked(one.select(F.explode(F.array(*rows)).alias("e")).select("e.*"))


def f_classif(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """ANOVA F (``SelectKBest`` default): between-group over within-group mean
    squares from per-class count, sum and sum of squares."""
    g = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"),
                              *[F.sum(f).alias(f"s{i}") for i, f in enumerate(features)],
                              *[F.sum(F.col(f) * F.col(f)).alias(f"q{i}") for i, f in enumerate(features)])
    aggs = [F.sum("n").alias("N"), F.count(F.lit(1)).alias("k")]
    for i, _ in enumerate(features):
        aggs += [F.sum(f"s{i}").alias(f"S{i}"), F.sum(f"q{i}").alias(f"Q{i}"),
                 F.sum(F.col(f"s{i}") * F.col(f"s{i}") / F.col("n")).alias(f"B{i}")]
    t = g.agg(*aggs)
    rows = []
    for i, f in enumerate(features):
        ssb = F.col(f"B{i}") - F.col(f"S{i}") * F.col(f"S{i}") / F.col("N")
        ssw = F.col(f"Q{i}") - F.col(f"B{i}")
        fs = F.try_divide(F.try_divide(ssb, F.col("k") - 1), F.try_divide(ssw, F.col("N") - F.col("k")))
        rows.append(F.struct(F.lit(f).alias("feature"), fs.alias("f_score")))
    return _ranked(t.select(F.explode(F.array(*rows)).alias("e")).select("e.*"))


def _ranked(scores: DataFrame) -> DataFrame:
    # one row per feature: a handful of rows, ranked in one task by design
    w = Window.orderBy(F.col("f_score").desc_nulls_last(), F.col("feature"))
    return scores.withColumn("rank", F.row_number().over(w))


def select_k_best(scores: DataFrame, k: int) -> list[str]:
    """Names of the k best features (a k-row collect)."""
    return [r.feature for r in scores.where(F.col("rank") <= k).orderBy("rank").collect()]


# ---------------------------------------------------------------- J14, J15 forecast features

def forecast_features(df: DataFrame, keys, ts: str, target: str, lags: Sequence[int] = (1, 7, 30),
                      dropna: bool = True) -> DataFrame:
    """``create_features``: month, day, dayofweek (Mon=0), target lags; rows
    without a full lag history dropped."""
    d = df.withColumns({"month": F.month(ts), "day": F.dayofmonth(ts), "dayofweek": F.weekday(ts)})
    d = W.lags(d, keys, [ts], target, list(lags), [f"lag_{n}" for n in lags])
    return d.dropna(subset=[f"lag_{n}" for n in lags]) if dropna else d


def surge_label(df: DataFrame, keys, ts: str, target: str, q: float = 0.9, name: str = "surge") -> DataFrame:
    """``(y.shift(-1) > y.quantile(q)).astype(int)`` without the last row of
    each series (its next value is unknown)."""
    thr = quantiles(df, target, [q], names=["t"]).scalar()
    d = W.lags(df, keys, [ts], target, [-1], ["_next"])
    return d.where(F.col("_next").isNotNull()).withColumn(name, (F.col("_next") > thr).cast("int")).drop("_next")

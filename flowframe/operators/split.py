"""Leakage-free splits, folds, class weights and resampling.

Every split is a deterministic function of the data: a row's place comes from the
scalable row index over time (chronological splits) or over a seeded hash of its
id (shuffled splits), never from ``randomSplit``, so a re-run or a recomputed
partition gives the same assignment.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowframe.operators import order as O
from flowframe.operators.order import as_list, join_on_keys


def _counts(df: DataFrame, keys) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))


def chrono_split(df: DataFrame, keys, order, train_frac: float | None = 0.8,
                 test_last: int | None = None, role: str = "role") -> DataFrame:
    """First ``train_frac`` of each series (``iloc[:int(n*0.8)]``) is
    'train', the rest 'test'; or the last ``test_last`` rows are 'test'."""
    keys = as_list(keys)
    d = O.positions(df, keys, order, "_sp")
    n = _counts(df, keys)
    d = join_on_keys(d, n, keys) if keys else d.withColumn("_n", df.agg(F.count(F.lit(1))).scalar())
    cut = (F.col("_n") - F.lit(test_last)) if test_last is not None else F.floor(F.col("_n") * F.lit(train_frac))
    return d.withColumn(role, F.when(F.col("_sp") < cut, "train").otherwise("test")).drop("_sp", "_n")


def _hashed_index(df: DataFrame, id_cols: Sequence[str], seed: int, keys=None, name: str = "_hi") -> DataFrame:
    h = F.md5(F.encode(F.concat_ws(":", *[F.col(c).cast("string") for c in id_cols], F.lit(str(seed))), "UTF-8"))
    return O.positions(df.withColumn("_h", h), keys, ["_h", *id_cols], name).drop("_h")


def stratified_holdout(df: DataFrame, id_cols: Sequence[str], label: str, test_size: float = 0.2,
                       seed: int = 42, role: str = "role") -> DataFrame:
    """``train_test_split(stratify=y)``: ``ceil(test_size * n)`` test rows in
    total, split over classes by the floor of each class's proportional share
    plus one more for the classes with the largest remainders (ties to the
    smaller label, where the library draws at random).  Within a class the first
    rows of a seeded hash order are 'test'."""
    from pyspark.sql import Window
    d = _hashed_index(df, id_cols, seed, [label])
    cnt = _counts(df, [label])
    n = df.agg(F.count(F.lit(1))).scalar()
    n_test = F.ceil(n * F.lit(test_size))
    share = n_test * F.col("_n") / n
    alloc = cnt.withColumns({"_fl": F.floor(share), "_fr": share - F.floor(share)})
    # one row per class: a small table ranked as a whole
    w = Window.orderBy(F.col("_fr").desc(), F.col(label))
    alloc = alloc.withColumn("_rk", F.row_number().over(w)).withColumn(
        "_left", n_test - F.sum("_fl").over(Window.partitionBy()))
    alloc = alloc.select(label, (F.col("_fl") + (F.col("_rk") <= F.col("_left")).cast("long")).alias("_t"))
    d = join_on_keys(d, alloc, [label])
    return d.withColumn(role, F.when(F.col("_hi") < F.col("_t"), "test").otherwise("train")).drop("_hi", "_t")


def kfold(df: DataFrame, id_cols: Sequence[str], k: int = 5, seed: int = 42, label: str | None = None,
          name: str = "fold") -> DataFrame:
    """``KFold(k, shuffle=True)`` / ``StratifiedKFold``: fold = (index mod k)
    over a seeded hash order, within each class when ``label`` is given, so fold
    sizes differ by at most one (per class)."""
    d = _hashed_index(df, id_cols, seed, [label] if label else None)
    return d.withColumn(name, (F.col("_hi") % k).cast("int")).drop("_hi")


def time_series_split(df: DataFrame, keys, order, n_splits: int = 5) -> DataFrame:
    """``TimeSeriesSplit(n_splits)``: with ``s = n // (k+1)``, fold i tests
    positions ``[n-(k-i)s, n-(k-i-1)s)`` and trains on every earlier position.
    Output: one row per (row, fold) it belongs to, with ``fold`` and ``role``."""
    keys = as_list(keys)
    k = n_splits
    d = O.positions(df, keys, order, "_tp")
    n = _counts(df, keys)
    d = join_on_keys(d, n, keys) if keys else d.withColumn("_n", df.agg(F.count(F.lit(1))).scalar())
    s = F.floor(F.col("_n") / (k + 1))
    d = d.withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
    start = F.col("_n") - (F.lit(k) - F.col("fold")) * s
    end = start + s
    d = d.withColumn("role", F.when(F.col("_tp") < start, "train")
                     .when(F.col("_tp") < end, "test"))
    return d.where(F.col("role").isNotNull()).drop("_n").withColumnRenamed("_tp", "position")


def class_weights(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """``class_weight='balanced'``: ``n / (k * n_c)`` per class, attached to
    each row (a weight column for Spark ML ``weightCol``)."""
    c = _counts(df, [label])
    n = df.agg(F.count(F.lit(1))).scalar()
    k = df.agg(F.count_distinct(label)).scalar()
    c = c.withColumn(name, n / (k * F.col("_n"))).drop("_n")
    return join_on_keys(df, c, [label], "left")


def upsample_minority(df: DataFrame, id_cols: Sequence[str], label: str, minority, majority,
                      seed: int = 42) -> DataFrame:
    """``resample(minority, replace=True, n_samples=len(majority))``: draw i
    (i = 0..n_major-1) takes the minority row whose rank is the first 13 hex digits
    of ``md5(i:seed)`` modulo n_minor;
    the result is the majority rows plus exactly n_major drawn minority rows."""
    spark = df.sparkSession
    major = df.where(F.col(label) == F.lit(majority))
    minor = df.where(F.col(label) == F.lit(minority))
    n_major = major.count()          # one number: the size of the draw
    n_minor = minor.agg(F.count(F.lit(1))).scalar()
    idx = O.positions(minor, [], list(id_cols), "_mi")
    digits = F.substring(F.md5(F.encode(F.concat_ws(":", F.col("id").cast("string"), F.lit(str(seed))), "UTF-8")), 1, 13)
    draws = spark.range(n_major).select((F.conv(digits, 16, 10).cast("long") % n_minor).alias("_mi"))
    # each minority row is drawn about n_major / n_minor times; Spark broadcasts the index
    # by its size in bytes, beyond that AQE splits the skew
    return major.unionByName(draws.join(idx, "_mi").drop("_mi"))

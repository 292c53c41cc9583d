"""Inspection and profiling as tables (inventory B1-B9).

Each profile is one aggregation pass over the data (partial aggregation on the
executors), reshaped to one row per column; nothing is printed or collected.
Scalars that later rows depend on (histogram edges) are uncorrelated scalar
subqueries: Spark evaluates them once and ships the value to every task.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, BooleanType

from flowframe.operators.order import as_list, join_on_keys
from flowframe.operators.stats import quantiles


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NumericType) and not isinstance(f.dataType, BooleanType)]


def table_profile(df: DataFrame) -> DataFrame:
    """B1: ``shape``/``dtypes``/``info()``: one row per column with its type,
    non-NULL count and the table's row count, from a single aggregate."""
    cols = df.columns
    one = df.agg(F.count(F.lit(1)).alias("_n"),
                 *[F.count(F.col(f"`{c}`")).alias(f"_c{i}") for i, c in enumerate(cols)])
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    entries = [F.struct(F.lit(i).alias("position"), F.lit(c).alias("column"),
                        F.lit(types[c]).alias("dtype"), F.col(f"_c{i}").alias("non_null"))
               for i, c in enumerate(cols)]
    return (one.select(F.col("_n").alias("n_rows"), F.explode(F.array(*entries)).alias("e"))
               .select("e.position", "e.column", "e.dtype", "e.non_null", "n_rows"))


def describe(df: DataFrame, cols: Sequence[str] | None = None,
             percentiles: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """B2: ``describe(percentiles=)``: count, mean, std (ddof 1), min, exact
    interpolated percentiles, max; one row per numeric column.

    The columns are unpivoted to (column, value) so every statistic, the exact
    percentiles included, is one keyed pass for all columns together."""
    cols = list(cols or numeric_columns(df))
    ps = list(percentiles)
    pname = [f"p{int(round(p * 100))}" for p in ps]
    long = df.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in cols]).unpivot(
        [], cols, "column", "_v")
    basic = long.groupBy("column").agg(
        F.count("_v").alias("count"), F.avg("_v").alias("mean"), F.stddev_samp("_v").alias("std"),
        F.min("_v").alias("min"), F.max("_v").alias("max"))
    q = quantiles(long, "_v", ps, ["column"], pname)
    out = join_on_keys(basic, q, ["column"], "left")
    return out.select("column", "count", "mean", "std", "min", *pname, "max")


def describe_categorical(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``describe(include=['O'])``: count, unique, top, freq per column.
    Ties for the top value are broken by the smaller value (ours).  The columns
    are unpivoted so all of them are profiled by one keyed aggregation."""
    long = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in cols]).unpivot(
        [], list(cols), "column", "v").where(F.col("v").isNotNull())
    vc = long.groupBy("column", "v").agg(F.count(F.lit(1)).alias("f"))
    return vc.groupBy("column").agg(F.sum("f").alias("count"), F.count(F.lit(1)).alias("unique"),
                                    F.min_by("v", F.struct(F.negative("f"), "v")).alias("top"),
                                    F.max("f").alias("freq"))


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """``unique()`` (NULL included once, as in pandas)."""
    return df.select(col).distinct()


def nunique(df: DataFrame, cols: Sequence[str], approx: bool = False, rsd: float = 0.01) -> DataFrame:
    """``nunique()`` ignoring missing values; ``approx`` uses HyperLogLog++."""
    f = (lambda c: F.approx_count_distinct(c, rsd)) if approx else F.count_distinct
    return df.agg(*[f(c).alias(c) for c in cols])


def value_counts(df: DataFrame, col: str, normalize: bool = False, dropna: bool = True,
                 name: str = "count") -> DataFrame:
    """``value_counts(normalize=, dropna=)``; proportion divides by the
    counted total (a scalar subquery, no global window)."""
    src = df.where(F.col(col).isNotNull()) if dropna else df
    vc = src.groupBy(col).agg(F.count(F.lit(1)).alias(name))
    if normalize:
        total = src.agg(F.count(F.lit(1))).scalar()
        vc = vc.withColumn("proportion", F.col(name) / total)
    return vc


def missing_counts(df: DataFrame) -> DataFrame:
    """``isna().sum()``: NULL (and NaN) count per column."""
    cols = df.columns
    types = {f.name: f.dataType for f in df.schema.fields}

    def miss(c):
        x = F.col(f"`{c}`")
        if types[c].typeName() in ("double", "float"):
            return x.isNull() | F.isnan(x)
        return x.isNull()
    one = df.agg(*[F.sum(miss(c).cast("long")).alias(f"_m{i}") for i, c in enumerate(cols)])
    entries = [F.struct(F.lit(c).alias("column"), F.coalesce(F.col(f"_m{i}"), F.lit(0)).alias("missing"))
               for i, c in enumerate(cols)]
    return one.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def corr_matrix(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Pairwise-complete Pearson correlations, long form (a, b, r), one pass."""
    cols = list(cols or numeric_columns(df))
    aggs, entries = [], []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            if j < i:
                continue
            xa, xb = F.col(f"`{a}`").cast("double"), F.col(f"`{b}`").cast("double")
            both = xa.isNotNull() & xb.isNotNull()
            aggs.append(F.corr(F.when(both, xa), F.when(both, xb)).alias(f"r{i}_{j}"))
    one = df.agg(*aggs)
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            k = f"r{min(i, j)}_{max(i, j)}"
            entries.append(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(k).alias("r")))
    return one.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def histogram(df: DataFrame, col: str, bins: int = 20) -> DataFrame:
    """Equal-width bins on [min, max] (``plot.hist(bins=)`` data); the last
    bin is closed; every bin is present.  Output: bin (1..bins), lo, hi, count."""
    x = F.col(col).cast("double")
    src = df.where(x.isNotNull())
    lo = src.agg(F.min(x)).scalar()
    hi = src.agg(F.max(x)).scalar()
    b = F.least(F.floor((x - lo) / (hi - lo) * F.lit(bins)) + 1, F.lit(bins))
    b = F.when(lo == hi, F.lit(1)).otherwise(b)
    counts = src.groupBy(b.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    width = (hi - lo) / F.lit(bins)
    spine = (df.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias("bin")))
    out = join_on_keys(spine, counts, ["bin"], "left")
    return out.select("bin", (lo + (F.col("bin") - 1) * width).alias("lo"),
                      (lo + F.col("bin") * width).alias("hi"),
                      F.coalesce("count", F.lit(0)).alias("count"))


def box_stats(df: DataFrame, col: str, by=None) -> DataFrame:
    """``boxplot(column, by)`` data: q1, median, q3, whiskers (most extreme
    values inside 1.5 IQR of the quartiles) and the outlier count per group."""
    by = as_list(by)
    x = F.col(col).cast("double")
    src = df.where(x.isNotNull())
    q = quantiles(src, x, [0.25, 0.5, 0.75], by, ["q1", "median", "q3"])
    fence = q.withColumn("_lf", F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))) \
             .withColumn("_uf", F.col("q3") + 1.5 * (F.col("q3") - F.col("q1")))
    if by:
        j = join_on_keys(src.select(*by, x.alias("_x")), fence, by)
    else:
        # one group: the five numbers are scalar subqueries of the same aggregate
        j = src.select(x.alias("_x")).withColumns(
            {c: fence.select(c).scalar() for c in ("q1", "median", "q3", "_lf", "_uf")})
    inside = (F.col("_x") >= F.col("_lf")) & (F.col("_x") <= F.col("_uf"))
    return j.groupBy(*by, "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col("_x"))).alias("whisker_lo"),
        F.max(F.when(inside, F.col("_x"))).alias("whisker_hi"),
        F.sum((~inside).cast("long")).alias("outliers"))

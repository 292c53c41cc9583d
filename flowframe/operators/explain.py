"""Shapley attribution and its summaries (inventory K23, K24).

Exact attributions for linear models, for tree models of any number of features
(:mod:`flowframe.operators.trees`), and by all subsets for any fitted Spark ML model of
few features; permutation-sampling Shapley values (Strumbelj & Kononenko 2014) for any
model: every (row, sampled order, step) point on the path from the background (feature
means) to the row is scored in one distributed transform.  All return
(ids..., feature, value, phi, base).
"""

from __future__ import annotations

import math
from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowframe.operators.models import assemble
from flowframe.operators.trees import tree_shap


def linear_shap(df: DataFrame, id_cols, features: Sequence[str], coefs: Sequence[float],
                intercept: float) -> DataFrame:
    """K23 (linear): ``phi_j = w_j (x_j - mean_j)``, base = prediction at the
    means.  Long output (ids..., feature, value, phi, base)."""
    ids = [id_cols] if isinstance(id_cols, str) else list(id_cols)
    means = df.agg(*[F.avg(f).alias(f) for f in features])
    base = F.lit(float(intercept))
    for f, w in zip(features, coefs):
        base = base + F.lit(float(w)) * means.select(f).scalar()
    entries = [F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value"),
                        (F.lit(float(w)) * (F.col(f) - means.select(f).scalar())).alias("phi"))
               for f, w in zip(features, coefs)]
    return df.select(*ids, F.explode(F.array(*entries)).alias("e"), base.alias("base")) \
             .select(*ids, "e.feature", "e.value", "e.phi", "base")


def exact_shap(model, df: DataFrame, id_col: str, features: Sequence[str]) -> DataFrame:
    """K23 (any model, few features: each row is scored ``2^d`` times): Shapley values over all subsets: a subset
    takes its features from the row and the others from the background means.  One
    transform scores the subsets, one aggregate weighs them.  Output as
    :func:`sampling_shap`."""
    d = len(features)
    means = df.agg(*[F.avg(f).alias(f) for f in features]).first()
    rows = df.select(id_col, *features).withColumn("_mask", F.explode(F.sequence(F.lit(0), F.lit((1 << d) - 1))))
    held = [F.col("_mask").bitwiseAND(F.lit(1 << j)) != 0 for j in range(d)]
    point = [F.when(held[j], F.col(f).cast("double")).otherwise(F.lit(float(means[f]))).alias(f) for j, f in enumerate(features)]
    scored = model.transform(assemble(rows.select(id_col, "_mask", *point), features)).select(id_col, "_mask", "prediction")
    n = F.bit_count("_mask")
    share = [math.factorial(s) * math.factorial(d - s - 1) / math.factorial(d) for s in range(d)]
    weights = F.array(*[F.lit(w) for w in share])
    with_j = F.try_element_at(weights, n)              # subset without j has n - 1 features
    without_j = F.try_element_at(weights, n + 1)
    phi = [F.sum(F.when(held[j], F.coalesce(F.when(n > 0, with_j), F.lit(0.0))).otherwise(-F.coalesce(without_j, F.lit(0.0)))
                 * F.col("prediction")).alias(f"_phi{j}") for j in range(d)]
    base = F.max(F.when(F.col("_mask") == 0, F.col("prediction"))).alias("base")
    wide = scored.groupBy(id_col).agg(*phi, base)
    entries = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f"_phi{j}").alias("phi")) for j, f in enumerate(features)])
    long = wide.select(id_col, F.explode(entries).alias("e"), "base").select(id_col, "e.feature", "e.phi", "base")
    return _with_values(long, df, id_col, features)


def _with_values(long: DataFrame, df: DataFrame, id_col: str, features: Sequence[str]) -> DataFrame:
    """The row's own value of each attributed feature."""
    own = df.select(id_col, *[F.col(f).cast("double").alias(f"_v{j}") for j, f in enumerate(features)])
    value = F.coalesce(*[F.when(F.col("feature") == f, F.col(f"_v{j}")) for j, f in enumerate(features)], F.lit(None).cast("double"))
    return long.join(own, id_col).select(id_col, "feature", value.alias("value"), "phi", "base")


def shap_values(model, df: DataFrame, id_col: str, features: Sequence[str], n_orders: int = 16, seed: int = 42) -> DataFrame:
    """Exact for tree models, whatever the number of features; sampled orders for others."""
    if "Tree" in type(model).__name__ or "Forest" in type(model).__name__ or "GBT" in type(model).__name__:
        return tree_shap(model, df, id_col, features)
    return sampling_shap(model, df, id_col, features, n_orders, seed)


def sampling_shap(model, df: DataFrame, id_col: str, features: Sequence[str], n_orders: int = 16,
                  seed: int = 42) -> DataFrame:
    """K23 (any model): average over ``n_orders`` seeded feature orders of
    ``f(z_k) - f(z_{k-1})`` where ``z_k`` takes the first k features of the order
    from the row and the rest from the background means.  For every order the
    contributions sum to ``f(x) - f(background)`` exactly.  Output (id, feature,
    phi, base)."""
    d = len(features)
    means = df.agg(*[F.avg(f).alias(f) for f in features]).first()
    rows = df.select(id_col, *features).withColumn("_m", F.explode(F.sequence(F.lit(0), F.lit(n_orders - 1))))
    hs = [F.xxhash64(F.col(id_col), F.col("_m"), F.lit(j), F.lit(seed)) for j in range(d)]
    rows = rows.withColumns({f"_h{j}": hs[j] for j in range(d)})
    # rank of feature j in the order: how many features hash before it
    ranks = {}
    for j in range(d):
        r = F.lit(0)
        for i in range(d):
            if i != j:
                before = (F.col(f"_h{i}") < F.col(f"_h{j}")) | ((F.col(f"_h{i}") == F.col(f"_h{j}")) & F.lit(i < j))
                r = r + before.cast("int")
        ranks[f"_r{j}"] = r
    rows = rows.withColumns(ranks).withColumn("_k", F.explode(F.sequence(F.lit(0), F.lit(d))))
    point = {f: F.when(F.col(f"_r{j}") < F.col("_k"), F.col(f).cast("double"))
             .otherwise(F.lit(float(means[f]))) for j, f in enumerate(features)}
    # the feature added at step k (k >= 1) is the one whose rank is k - 1
    added = None
    for j, f in enumerate(features):
        c = F.when(F.col(f"_r{j}") == F.col("_k") - 1, F.lit(f))
        added = c if added is None else F.coalesce(added, c)
    pts = rows.select(id_col, "_m", "_k", added.alias("_feature"), *[point[f].alias(f) for f in features])
    scored = model.transform(assemble(pts, features)).select(id_col, "_m", "_k", "_feature", "prediction")
    w = Window.partitionBy(id_col, "_m").orderBy("_k")       # d+1 rows per window
    steps = scored.withColumn("_delta", F.col("prediction") - F.lag("prediction").over(w))
    base = steps.where(F.col("_k") == 0).agg(F.avg("prediction")).scalar()
    phi = steps.where(F.col("_k") > 0).groupBy(id_col, "_feature").agg(F.avg("_delta").alias("phi"))
    return _with_values(phi.select(id_col, F.col("_feature").alias("feature"), "phi", base.alias("base")), df, id_col, features)


def mean_abs_importance(shap: DataFrame) -> DataFrame:
    """K24 summary plot data: mean |phi| per feature, ranked; rank 1 is the top feature."""
    g = shap.groupBy("feature").agg(F.avg(F.abs("phi")).alias("mean_abs_phi"))
    # one row per feature: a handful of rows ranked together
    return g.withColumn("rank", F.row_number().over(Window.orderBy(F.col("mean_abs_phi").desc(), "feature")))


def dependence(shap: DataFrame, feature: str) -> DataFrame:
    """K24 dependence plot data: (value, phi) pairs of one feature."""
    return shap.where(F.col("feature") == feature).select("value", "phi")


def waterfall(shap: DataFrame, id_col: str, row_id) -> DataFrame:
    """K24 waterfall data of one row: contributions by decreasing |phi| with the
    running total from the base value."""
    one = shap.where(F.col(id_col) == F.lit(row_id))
    w = Window.orderBy(F.abs("phi").desc(), "feature")       # one row's features only
    return one.withColumn("step", F.row_number().over(w)).withColumn(
        "running", F.col("base") + F.sum("phi").over(w.rowsBetween(Window.unboundedPreceding, 0)))

"""Exact quantiles without a single-task buffer.

Spark's ``percentile``/``median`` aggregates keep every distinct value of a group
in one aggregation buffer, which a whole 100 TB column (or a hot group) cannot
fit.  Here the column is first reduced to its distinct values with their
multiplicities (a partial aggregate, so a value shared by a third of the rows
becomes one row).  The distinct values are cut into blocks with the sampled
bounds of :mod:`flowframe.operators.order`; summed multiplicities per block and
their prefix locate the few blocks that hold the needed ranks, and only those
are ordered, a running count giving each value its range of ranks.  For ``h = (n-1) q`` the values holding ranks ``floor(h)`` and
``ceil(h)`` are interpolated linearly, which is pandas' ``quantile`` (S7).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowframe.operators import order as O
from flowframe.operators.order import as_list, join_on_keys


def quantiles(df: DataFrame, col: str | Column, qs: Sequence[float], keys=None,
              names: Sequence[str] | None = None) -> DataFrame:
    """One row per group (``keys``) with exact interpolated quantiles of ``col``
    (NULLs ignored).  Output columns: keys, then ``names`` (default q0, q1, ...).

    Distinct values with multiplicities are cut into blocks by sampled bounds;
    the summed multiplicity per (group, block) and its prefix locate the blocks
    holding ranks ``floor(h)``/``ceil(h)``; only those blocks are ordered, with a
    running count giving each value its range of ranks."""
    keys = as_list(keys)
    qs = list(qs)
    names = list(names or [f"q{i}" for i in range(len(qs))])
    x = F.col(col) if isinstance(col, str) else col
    vals = df.select(*keys, x.cast("double").alias("_x")).where(F.col("_x").isNotNull())
    dv = vals.groupBy(*keys, "_x").agg(F.count(F.lit(1)).alias("_c"))
    spark = df.sparkSession
    n_blocks = O.conf_int(spark, O.BLOCKS_CONF, O.shuffle_partitions(spark))
    sk = O.sort_key(dv, keys, ["_x"])
    d = O.materialize(O.with_block(dv.withColumn("_sk", sk), "_sk", O.block_bounds(dv, sk, n_blocks),
                                   n_blocks).drop("_sk"))
    cnt = d.groupBy(*keys, "_blk").agg(F.sum("_c").alias("_bn"))
    wk = (O.Window.partitionBy(*keys) if keys else O.Window.partitionBy()).orderBy("_blk")
    cnt = cnt.select(*keys, "_blk", "_bn",
                     F.coalesce(F.sum("_bn").over(wk.rowsBetween(O.Window.unboundedPreceding, -1)),
                                F.lit(0)).alias("_off"),
                     F.sum("_bn").over(wk.rowsBetween(O.Window.unboundedPreceding,
                                                      O.Window.unboundedFollowing)).alias("_n"))
    targets = F.array(*[F.floor((F.col("_n") - 1) * F.lit(q)) for q in qs],
                      *[F.ceil((F.col("_n") - 1) * F.lit(q)) for q in qs])
    need = (cnt.select(*keys, "_blk", "_bn", "_off", "_n", F.explode(targets).alias("_t"))
               .where((F.col("_t") >= F.col("_off")) & (F.col("_t") < F.col("_off") + F.col("_bn")))
               .select(*keys, "_blk", "_off", "_n").distinct())
    picked = join_on_keys(d, need, [*keys, "_blk"])
    w = O.Window.partitionBy(*keys, "_blk").orderBy("_x").rowsBetween(O.Window.unboundedPreceding, 0)
    ranked = picked.withColumn("_cum", F.col("_off") + F.sum("_c").over(w))
    first = F.col("_cum") - F.col("_c")          # rank of the first copy of this value

    def value_at(rank: Column) -> Column:
        return F.max(F.when((first <= rank) & (rank < F.col("_cum")), F.col("_x")))

    aggs = []
    for i, q in enumerate(qs):
        h = (F.col("_n") - 1) * F.lit(q)
        aggs += [value_at(F.floor(h)).alias(f"_lo{i}"), value_at(F.ceil(h)).alias(f"_hi{i}"),
                 F.max(h - F.floor(h)).alias(f"_fr{i}")]
    g = ranked.groupBy(*keys).agg(*aggs)
    return g.select(*keys, *[
        (F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * F.col(f"_fr{i}")).alias(nm)
        for i, nm in enumerate(names)])


def quantile_scalar(df: DataFrame, col: str | Column, q: float) -> Column:
    """Exact quantile of the whole column as a scalar subquery."""
    return quantiles(df, col, [q], names=["q"]).scalar()


def quantile_array(df: DataFrame, col: str | Column, qs: Sequence[float]) -> Column:
    """Exact quantiles as one ARRAY<DOUBLE> scalar subquery."""
    t = quantiles(df, col, qs)
    return t.select(F.array(*[F.col(f"q{i}") for i in range(len(qs))])).scalar()

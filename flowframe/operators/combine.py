"""Joins and combination (inventory E1-E6)."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowframe.operators import order as O
from flowframe.operators.order import as_list, join_on_keys


def merge_left(df: DataFrame, dim: DataFrame, on: Sequence[str], null_safe: bool = False) -> DataFrame:
    """``pd.merge(df, master, on=, how='left')``; unmatched rows kept.

    The join strategy is left to Spark, which broadcasts by size in bytes.
    ``null_safe`` matches NULL keys with NULL keys as pandas does (S3)."""
    if null_safe:
        return join_on_keys(df, dim, list(on), "left")
    return df.join(dim, list(on), "left")


def merge_asof(left: DataFrame, right: DataFrame, on: str, by=None,
               right_order: str | None = None, right_on: str | None = None,
               prefix: str = "") -> DataFrame:
    """``merge_asof(direction='backward')``: each left row gets the last right
    row (same ``by`` keys) whose ``on`` value is <= its own; among right rows with
    the same time the last one in ``right_order`` wins.

    Both sides are tagged and unioned, ordered by (time, right-before-left,
    right_order); the right values are carried forward with the scalable
    forward fill, so a key with a third of all rows still spreads over many
    tasks.  One pass, no join.
    """
    by = as_list(by)
    right_on = right_on or on
    # the right time column is kept when its name differs from the left one
    rcols = [c for c in right.columns if c not in by and not (c == right_on and right_on == on)]
    ro = right_order or right_on
    return _asof_union(left, right, on, right_on, by, rcols, ro, prefix)


def _asof_union(left, right, on, right_on, by, rcols, ro, prefix):
    rtype = right.select(F.struct(*[F.col(f"`{c}`") for c in rcols]).alias("s")).schema[0].dataType
    otype = dict(right.dtypes)[ro]
    lcols = left.columns
    lpart = left.select(
        *[F.col(f"`{c}`") for c in lcols],
        F.col(on).cast("timestamp_ntz").alias("_t"), F.lit(1).alias("_side"),
        F.lit(None).cast(otype).alias("_ro"), F.lit(None).cast(rtype).alias("_rv"))
    rpart = right.select(
        *[(F.col(f"`{c}`") if c in by else F.lit(None).cast(dict(left.dtypes)[c])).alias(c) for c in lcols],
        F.col(right_on).cast("timestamp_ntz").alias("_t"), F.lit(0).alias("_side"),
        F.col(ro).alias("_ro"),
        F.struct(*[F.col(f"`{c}`") for c in rcols]).alias("_rv"))
    u = lpart.unionByName(rpart)
    u = O.positions(u, by, [F.col("_t"), F.col("_side"), F.col("_ro")], "_apos")
    u = O.forward_prefix(u, by, "_apos", [("_match", "last", "_rv")])
    out = u.where(F.col("_side") == 1)
    return out.select(*[F.col(f"`{c}`") for c in lcols],
                      *[F.col("_match")[c].alias(f"{prefix}{c}") for c in rcols])


def join_suffix(a: DataFrame, b: DataFrame, on: Sequence[str], lsuffix: str = "_left",
                rsuffix: str = "_right", how: str = "left") -> DataFrame:
    """``a.join(b, lsuffix, rsuffix)``: clashing non-key names get suffixes."""
    on = list(on)
    clash = (set(a.columns) & set(b.columns)) - set(on)
    a2 = a.withColumnsRenamed({c: f"{c}{lsuffix}" for c in clash})
    b2 = b.withColumnsRenamed({c: f"{c}{rsuffix}" for c in clash})
    return join_on_keys(a2, b2, on, how)


def concat_columns(a: DataFrame, b: DataFrame, a_order, b_order, on: Sequence[str] | None = None) -> DataFrame:
    """``pd.concat([a, b], axis=1)``: by a shared key when one exists, else by
    row position (full join on the scalable position; the shorter side is
    padded with NULL)."""
    if on:
        return join_on_keys(a, b, list(on), "full")
    pa = O.positions(a, [], a_order, "_cpos")
    pb = O.positions(b, [], b_order, "_cpos")
    return join_on_keys(pa, pb, ["_cpos"], "full").drop("_cpos")


def combine_first(a: DataFrame, b: DataFrame, on: Sequence[str]) -> DataFrame:
    """E5: ``a.combine_first(b)``: union of keys and columns, ``a``'s value unless
    missing, then ``b``'s."""
    on = list(on)
    cols = [c for c in a.columns if c not in on] + [c for c in b.columns if c not in on and c not in a.columns]
    ra = a.select(*on, *[F.col(c).alias(f"_a_{c}") for c in a.columns if c not in on])
    rb = b.select(*on, *[F.col(c).alias(f"_b_{c}") for c in b.columns if c not in on])
    j = join_on_keys(ra, rb, on, "full")
    out = []
    for c in cols:
        parts = [F.col(f"_{s}_{c}") for s, src in (("a", a), ("b", b)) if c in src.columns]
        out.append(F.coalesce(*parts).alias(c) if len(parts) > 1 else parts[0].alias(c))
    return j.select(*on, *out)


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """``pd.concat(axis=0)`` aligned by name; missing columns NULL."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out

"""Order-dependent work without a single task.

pandas rows have an order; Spark rows do not.  Every order-dependent operator in
flowframe therefore takes ``keys`` (series identity, may be empty) and ``order``
(sort columns, unique within a series).  A plain ``Window.partitionBy(keys)``
sends a whole series to one task, which breaks when there are no keys or when one
key holds a large share of the rows.  The helpers here keep every task bounded:

``positions``
    dense 0-based row position within each series.  Rows are cut into contiguous
    blocks of the ``(keys, order)`` sort key (bounds from a hash-chosen sample),
    so a large series is spread over many blocks; a row number inside ``(keys,
    block)`` plus the offset of the block inside its series (a prefix sum over a
    table with one row per ``(keys, block)``) gives the position.

``with_halo`` / ``segment_window``
    bounded row frames (lag, lead, rolling n rows).  Rows are cut into
    segments of ``B`` positions; the last ``before`` rows of a segment are copied
    into the next one (and the first ``after`` rows into the previous one) as a
    halo, the window runs per ``(keys, segment)``, halo rows are dropped.

``with_time_halo``
    bounded time-range frames (``rolling('7D')``): rows are cut into contiguous
    blocks of (keys, time) at sampled bounds; a row is copied into the later blocks
    that its window reaches.

``forward_prefix`` / ``backward_prefix``
    unbounded frames (expanding, forward/backward fill): a running aggregate
    inside each segment combined with an exclusive prefix over the small table
    of per-segment aggregates.

Segment length is read from the session conf ``flowframe.order.segmentRows``
(default 1,048,576) so tests can force many segments on small data.
"""

from __future__ import annotations

import math
from functools import reduce
from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowframe.session import checkpoint, conf_int, shuffle_partitions  # noqa: F401 (re-exported)

SEGMENT_CONF = "flowframe.order.segmentRows"
BLOCKS_CONF = "flowframe.order.blocks"
DEFAULT_SEGMENT_ROWS = 1 << 20

POS = "_pos"


def as_list(x) -> list:
    if x is None:
        return []
    if isinstance(x, (str, Column)):
        return [x]
    return list(x)


def as_order(order) -> list[Column]:
    return [F.col(o) if isinstance(o, str) else o for o in as_list(order)]


def qcol(alias: str, name: str) -> Column:
    return F.col(f"{alias}.`{name}`")


def join_on_keys(left: DataFrame, right: DataFrame, cols: Sequence[str],
                 how: str = "inner") -> DataFrame:
    """Equi-join on ``cols`` treating NULL = NULL (pandas ``merge`` semantics, S3).

    Aliases make the join safe when ``right`` is derived from ``left``.  Columns of
    ``right`` other than ``cols`` are appended to ``left``'s columns.
    """
    cols = list(cols)
    if not cols:
        raise ValueError("join_on_keys needs at least one key column")
    lt, rt = left.alias("_jl"), right.alias("_jr")
    cond = reduce(lambda a, b: a & b,
                  [qcol("_jl", c).eqNullSafe(qcol("_jr", c)) for c in cols])
    rest = [c for c in right.columns if c not in cols]
    if how in ("full", "full_outer", "outer", "right", "right_outer"):
        keys = [F.coalesce(qcol("_jl", c), qcol("_jr", c)).alias(c) for c in cols]
        lrest = [qcol("_jl", c) for c in left.columns if c not in cols]
        return lt.join(rt, cond, how).select(*keys, *lrest, *[qcol("_jr", c) for c in rest])
    return lt.join(rt, cond, how).select(*[qcol("_jl", c) for c in left.columns],
                                         *[qcol("_jr", c) for c in rest])


def _window(keys: Sequence[str], *extra: str):
    parts = [*keys, *extra]
    # An empty partition list is only used on tables with one row per block or
    # segment, whose size is bounded by the number of blocks, never by the data.
    return Window.partitionBy(*parts) if parts else Window.partitionBy()


def segment_rows(df: DataFrame) -> int:
    return conf_int(df.sparkSession, SEGMENT_CONF, DEFAULT_SEGMENT_ROWS)


def _order_items(order) -> list[tuple[Column, bool]]:
    """Order spec items: a name or Column (ascending) or ``(name, 'desc')``."""
    items = []
    for o in as_list(order):
        if isinstance(o, tuple):
            c, d = o
            items.append((F.col(c) if isinstance(c, str) else c, str(d).lower() != "desc"))
        else:
            items.append((F.col(o) if isinstance(o, str) else o, True))
    return items


def sort_key(df: DataFrame, keys, order) -> Column:
    """One STRUCT whose natural ordering is (keys, order) with missing values last.

    Each item contributes (is-missing flag, value with missing replaced); a
    descending numeric item is negated.  Comparing the struct is the total order
    used for blocks and for row numbers, so both always agree.
    """
    fields = []
    items = [(F.col(k), True) for k in as_list(keys)] + _order_items(order)
    for i, (c, asc) in enumerate(items):
        t = df.select(c.alias("_t")).schema[0].dataType.typeName()
        if t in ("string", "binary"):
            fill = F.lit("")
        elif t in ("timestamp_ntz", "timestamp", "date"):
            fill = F.lit("1970-01-01").cast(t if t != "timestamp" else "timestamp")
        elif t == "boolean":
            fill = F.lit(False)
        else:
            fill = F.lit(0)
        v = F.coalesce(c, fill)
        if not asc:
            v = _reversed(v, t)
        fields += [c.isNull().alias(f"n{i}"), v.alias(f"v{i}")]
    return F.struct(*fields)


def _reversed(v: Column, kind: str) -> Column:
    """A value that sorts opposite to ``v``, exact in ``v``'s own range."""
    if kind in ("string", "binary"):
        # hex keeps the byte order, complemented digits turn it around, and the end mark
        # (above every digit) puts a text after the longer texts that start with it
        digits = "0123456789ABCDEF"
        return F.concat(F.translate(F.hex(v if kind == "binary" else F.encode(v, "UTF-8")), digits, digits[::-1]), F.lit("~"))
    if kind in ("byte", "short", "integer", "long"):
        return F.bitwise_not(v.cast("long"))      # -v - 1: no overflow at the minimum
    if kind == "boolean":
        return ~v
    if kind in ("timestamp_ntz", "timestamp", "date"):
        return -epoch_micros(v)
    return -v


SERIES = "_series"


def with_series(df: DataFrame, keys) -> tuple[DataFrame, list[str]]:
    """Add one never-NULL struct column that stands for the keys (NULL = NULL), so that
    windows and joins on it share one hash partitioning.  No keys: no column."""
    keys = as_list(keys)
    if not keys:
        return df, []
    return df.withColumn(SERIES, sort_key(df, keys, [])), [SERIES]


def block_bounds(df: DataFrame, sk: Column, n_blocks: int, per_block_sample: int = 32) -> Column:
    """Sorted block boundaries (ARRAY of sort keys) as one scalar subquery.

    The sample is the ``n_blocks * per_block_sample`` rows with the smallest hash
    of their sort key (a bottom-k sample: one pass, per-task top-k then merge),
    so the bounds are the same however often and in whatever row order the input
    is evaluated.
    """
    m = max(n_blocks, 1) * per_block_sample
    sample = (df.select(sk.alias("_sk")).withColumn("_h", F.xxhash64("_sk"))
                .orderBy("_h", "_sk").limit(m))
    arr = sample.agg(F.sort_array(F.collect_list("_sk")).alias("a"))
    picks = F.transform(
        F.sequence(F.lit(1), F.lit(max(n_blocks - 1, 1))),
        lambda i: F.try_element_at(F.col("a"), (F.floor(i * F.size("a") / F.lit(n_blocks)) + 1).cast("int")))
    return arr.select(F.array_distinct(F.filter(picks, lambda x: x.isNotNull()))).scalar()


def with_block(df: DataFrame, sk: str, bounds: Column, n_blocks: int, name: str = "_blk") -> DataFrame:
    """Add ``name`` = number of bounds <= ``sk``, by a binary search unrolled into
    ceil(log2 n)+1 projection steps (higher-order functions cannot reference the
    bounds subquery)."""
    steps = max(1, int(math.ceil(math.log2(max(n_blocks, 2)))) + 1)
    # both ends are never NULL, by their types too: a filter that a later operator puts on the
    # number then infers no IS NOT NULL, which would be pushed below and repeat every step
    d = df.withColumns({"_lo": F.lit(0), "_hi": F.coalesce(F.size(bounds), F.lit(0))})
    for _ in range(steps):
        lo, hi = F.col("_lo"), F.col("_hi")
        mid = F.shiftright(lo + hi, 1)
        open_ = lo < hi
        right = open_ & F.coalesce(F.try_element_at(bounds, mid + 1) <= F.col(sk), F.lit(False))
        d = d.withColumns({"_lo": F.when(right, mid + 1).otherwise(lo),
                           "_hi": F.when(open_ & ~right, mid).otherwise(hi)})
    return d.withColumnRenamed("_lo", name).drop("_hi")


def positions(df: DataFrame, keys, order, name: str = POS,
              blocks: int | None = None) -> DataFrame:
    """Add a dense 0-based position of each row within its series.

    Rows are cut into ``blocks`` contiguous ranges of the (keys, order) sort key
    using sampled bounds; a row number inside ``(keys, block)`` plus the offset of
    the block inside its series (exclusive prefix sum over a table with one row
    per ``(keys, block)``) gives the position.  Block assignment is a pure
    function of the row, so the two branches (row numbers, block counts) agree
    even when evaluated separately or recomputed after an executor loss; no task
    holds more than about one block, whatever the size of a series.
    """
    keys = as_list(keys)
    spark = df.sparkSession
    n = blocks or conf_int(spark, BLOCKS_CONF, shuffle_partitions(spark))
    sk = sort_key(df, keys, order)
    bounds = block_bounds(df, sk, n)
    d = materialize(with_block(df.withColumn("_sk", sk), "_sk", bounds, n))
    d, series = with_series(d, keys)
    local = d.withColumn(
        "_lpos", F.row_number().over(_window(series, "_blk").orderBy("_sk")) - 1)
    blk = d.groupBy(*series, "_blk").agg(F.count(F.lit(1)).alias("_bn"))
    before = _window(series).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    blk = blk.select(*series, "_blk", F.coalesce(F.sum("_bn").over(before), F.lit(0)).alias("_off"))
    # the window's partitioning serves the join: the full-width rows move once
    out = local.join(blk, [*series, "_blk"])
    return (out.withColumn(name, (F.col("_off") + F.col("_lpos")).cast("long"))
               .drop("_sk", "_blk", "_lpos", "_off", SERIES))


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and continue from there.

    Ordered operators read their block-tagged input in two branches (row numbers
    and block counts); without this, each branch (and every later operator in a
    chain) would recompute the whole upstream plan.  ``checkpoint()`` is
    reliable storage, so it also survives executor loss and cuts the lineage.
    Set ``flowframe.order.materialize=false`` to keep plans lazy instead.
    """
    flag = df.sparkSession.conf.get("flowframe.order.materialize", "true")
    return checkpoint(df) if str(flag).lower() != "false" else df


def ensure_positions(df: DataFrame, keys, order, pos: str = POS) -> DataFrame:
    return df if pos in df.columns else positions(df, keys, order, pos)


# ---------------------------------------------------------------- bounded row frames

def with_halo(df: DataFrame, pos: str, before: int, after: int = 0,
              seg_rows: int | None = None) -> DataFrame:
    """Add ``_seg`` and ``_halo``; halo rows are copies that only serve as context."""
    B = max(seg_rows or segment_rows(df), 4 * (before + after) + 1)
    p = F.col(pos)
    seg = F.floor(p / F.lit(B)).cast("long")
    off = p - seg * F.lit(B)
    copies = F.array(
        F.struct(seg.alias("s"), F.lit(False).alias("h")),
        F.when(off >= F.lit(B - before), F.struct((seg + 1).alias("s"), F.lit(True).alias("h"))),
        F.when(off < F.lit(after), F.struct((seg - 1).alias("s"), F.lit(True).alias("h"))),
    )
    return (df.withColumn("__copy", F.explode(F.filter(copies, lambda x: x.isNotNull())))
              .withColumn("_seg", F.col("__copy.s")).withColumn("_halo", F.col("__copy.h"))
              .drop("__copy"))


def segment_window(keys, pos: str = POS):
    return _window(as_list(keys), "_seg").orderBy(pos)


def drop_halo(df: DataFrame) -> DataFrame:
    return df.filter(~F.col("_halo")).drop("_seg", "_halo")


def bounded(df: DataFrame, keys, pos: str, before: int, after: int, build) -> DataFrame:
    """Run ``build(window) -> {name: Column}`` over a frame of at most
    ``before`` rows back and ``after`` rows ahead, segment by segment."""
    h = with_halo(df, pos, before, after)
    w = segment_window(keys, pos)
    return drop_halo(h.withColumns(build(w)))


# ---------------------------------------------------------------- time-range frames

def epoch_micros(ts) -> Column:
    """Microseconds since 1970-01-01 of a TIMESTAMP_NTZ / DATE column, zone free."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.timestamp_diff("MICROSECOND",
                            F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"),
                            c.cast("timestamp_ntz"))


def with_time_halo(df: DataFrame, keys, t_us: str, width_us: int, blocks: int | None = None) -> DataFrame:
    """Blocks of (keys, ``t_us``) at sampled bounds, so a crowded span of time is as many
    blocks as its rows need.  A row belongs to its own block and, as a halo row, to every
    later block that starts within ``width_us`` of it."""
    n = blocks or conf_int(df.sparkSession, BLOCKS_CONF, shuffle_partitions(df.sparkSession))
    d = df.withColumn("_until", F.col(t_us) + F.lit(width_us - 1))
    bounds = block_bounds(df, sort_key(df, keys, [t_us]), n)
    d = d.withColumns({"_sk": sort_key(d, keys, [t_us]), "_sk2": sort_key(d, keys, ["_until"])})
    d = with_block(d, "_sk", bounds, n, "_own")
    d = with_block(d, "_sk2", bounds, n, "_reach")
    d = d.withColumn("_seg", F.explode(F.sequence("_own", F.greatest("_own", "_reach"))))
    return d.withColumn("_halo", F.col("_seg") != F.col("_own")).drop("_until", "_sk", "_sk2", "_own", "_reach")


# ---------------------------------------------------------------- unbounded frames

def _seg_col(df: DataFrame, pos: str) -> Column:
    return F.floor(F.col(pos) / F.lit(segment_rows(df))).cast("long")


def forward_prefix(df: DataFrame, keys, pos: str, specs: Iterable[tuple[str, str, str]]) -> DataFrame:
    """Running aggregates from the series start up to and including each row.

    ``specs``: (out_name, kind, column) with kind in ``sum``, ``count``, ``max``,
    ``min``, ``last`` (last non-NULL value).
    """
    return prefixes(df, keys, pos, forward=specs)


def backward_prefix(df: DataFrame, keys, pos: str, specs: Iterable[tuple[str, str, str]]) -> DataFrame:
    """Aggregates from each row to the series end; kind ``first`` = next non-NULL."""
    return prefixes(df, keys, pos, backward=specs)


_SEG_AGG = {
    "sum": lambda c: F.sum(c), "count": lambda c: F.count(c),
    "max": lambda c: F.max(c), "min": lambda c: F.min(c),
}


def prefixes(df: DataFrame, keys, pos: str, forward: Iterable = (), backward: Iterable = ()) -> DataFrame:
    """Forward and backward unbounded frames in one pass: a running aggregate
    inside each segment of ``B`` positions plus the exclusive prefix (suffix) of
    the small per-segment table, joined back once.

    The per-segment totals are read off the running aggregates themselves (the
    value at a segment's last row, or first row going backwards), so both sides
    of the join come from the same windowed plan and its exchange is reused."""
    keys = as_list(keys)
    d, series = with_series(df.withColumn("_seg", _seg_col(df, pos)), keys)
    run_cols, seg_aggs, prev_cols, combine = {}, [], [], {}
    jobs = [(s, True) for s in forward] + [(s, False) for s in backward]
    for i, ((name, kind, c), fwd) in enumerate(jobs):
        if fwd:
            inner = _window(series, "_seg").orderBy(pos).rowsBetween(Window.unboundedPreceding, 0)
            outer = _window(series).orderBy("_seg").rowsBetween(Window.unboundedPreceding, -1)
        else:
            inner = _window(series, "_seg").orderBy(pos).rowsBetween(0, Window.unboundedFollowing)
            outer = _window(series).orderBy("_seg").rowsBetween(1, Window.unboundedFollowing)
        r, s_, p = f"_r{i}", f"_s{i}", f"_p{i}"
        # segment total = running value at the segment's end (start when backward)
        seg_aggs.append((F.max_by(r, pos) if fwd else F.min_by(r, pos)).alias(s_))
        if kind in ("last", "first"):
            edge = F.last(c, ignorenulls=True) if fwd else F.first(c, ignorenulls=True)
            run_cols[r] = edge.over(inner)
            prev = (F.last(s_, ignorenulls=True) if fwd else F.first(s_, ignorenulls=True)).over(outer)
            prev_cols.append(prev.alias(p))
            combine[name] = F.coalesce(F.col(r), F.col(p))
        elif kind in ("sum", "count"):
            run_cols[r] = _SEG_AGG[kind](c).over(inner)
            prev_cols.append(F.sum(s_).over(outer).alias(p))
            if kind == "count":
                combine[name] = F.col(r) + F.coalesce(F.col(p), F.lit(0))
            else:
                combine[name] = F.when(F.col(r).isNull() & F.col(p).isNull(), F.lit(None)).otherwise(
                    F.coalesce(F.col(r), F.lit(0)) + F.coalesce(F.col(p), F.lit(0)))
        else:
            f = F.max if kind == "max" else F.min
            g = F.greatest if kind == "max" else F.least
            run_cols[r] = _SEG_AGG[kind](c).over(inner)
            prev_cols.append(f(s_).over(outer).alias(p))
            combine[name] = g(F.col(r), F.col(p))  # greatest/least skip NULL
    dw = d.withColumns(run_cols)
    segs = dw.groupBy(*series, "_seg").agg(*seg_aggs)
    segs = segs.select(*series, "_seg", *prev_cols)
    out = dw.join(segs, [*series, "_seg"])
    drop = [*run_cols, *[f"_p{i}" for i in range(len(jobs))], "_seg", SERIES]
    return out.withColumns(combine).drop(*drop)


def _edge_nonnull(c: str, pos: str, forward: bool) -> Column:
    """Value at the greatest (smallest) position among non-NULL values of ``c``."""
    s = F.struct(F.col(pos).alias("p"), F.col(c).alias("v"))
    s = F.when(F.col(c).isNotNull(), s)
    return (F.max(s) if forward else F.min(s))["v"]

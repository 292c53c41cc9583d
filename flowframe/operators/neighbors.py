"""Exact nearest neighbours and density clustering.

Neighbours: every row goes to a near one of a bounded sample of pivots; the rows of a pivot
lie in a ball around it and are packed on the executors into blocks of bounded size.
Query blocks first meet the nearest pivots that hold k rows, which bounds the distance of
every query's k-th neighbour; by the triangle inequality only pivots whose balls come
within that bound are joined with them then.  A task keeps only the k best candidates of
each query in a pair of blocks: no row per pair is made, and a task holds two blocks
and one slice of their distances.  Equal rows are one.

Density clustering: distinct coordinates with multiplicities on a grid whose cells have a
diagonal of ``eps``.  Cells with ``min_samples`` rows are all core and one cluster, so only
points of sparser cells are counted against nearby cells; clusters are connected components
of cells, whatever their diameter.  Cells split into finer boxes until their corners
decide, so two dense cells never make all pairs of their rows.
"""

from __future__ import annotations

import math
from itertools import product
from typing import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowframe.operators import order as O
from flowframe.operators.components import connected_components
from flowframe.operators.iterative import iterative_impute  # noqa: F401 (D13, offered here too)
from flowframe.session import checkpoint

#: Bytes of coordinates in a block, and cells of a slice of distances.
BLOCK_BYTES = 4 << 20
SLICE_CELLS = 1 << 21
#: Most pivots; a pivot with more rows than a block has several blocks.
PIVOTS = 1024
PIVOT_CHOICE = 8


def _vectors(df: DataFrame, id_col: str, feats: Column, payload: Column, dims: int, holes: bool) -> DataFrame:
    """(id, x, y) of the rows that can be compared: ``dims`` coordinates, all of them there
    or, with ``holes``, at least one."""
    d = df.select(F.col(id_col).cast("long").alias("id"), feats.alias("x"), payload.alias("y"))
    # NaN is a missing coordinate too
    d = d.where(F.size("x") == dims).withColumn("x", F.transform("x", lambda v: F.when(~F.isnan(v), v)))
    there = F.exists if holes else F.forall
    return d.where(there("x", lambda v: v.isNotNull()))


def _pivots(rows: DataFrame, n: int) -> np.ndarray:
    """Up to ``n`` whole vectors that lie far apart: of a sample of ``PIVOT_CHOICE`` times as many,
    chosen by hash (the driver holds no more), each time the one farthest from those chosen."""
    whole = rows.where(F.forall("x", lambda v: v.isNotNull()))
    found = whole.select("x", F.xxhash64("x").alias("h")).orderBy("h").limit(n * PIVOT_CHOICE).collect()
    x = np.array([r["x"] for r in found], dtype="float64")
    chosen, far = [], np.full(len(x), np.inf)
    while len(chosen) < min(n, len(x)) and far.max() > 0:
        chosen.append(int(np.argmax(far)))
        far = np.minimum(far, ((x - x[chosen[-1]]) ** 2).sum(axis=1))
    return x[chosen]


def _placed(rows: DataFrame, pivots: np.ndarray) -> DataFrame:
    """``rows`` with the number of a near pivot and the distance to it; -1 if a coordinate is missing."""
    shared = rows.sparkSession.sparkContext.broadcast(pivots)
    kind = dict(rows.dtypes)["y"]

    def place(batches):
        centres = shared.value
        size = (centres ** 2).sum(axis=-1)
        for pdf in batches:
            x = np.array([[np.nan if v is None else v for v in r] for r in pdf["x"]], dtype="float64").reshape(len(pdf), -1)
            whole = ~np.isnan(x).any(axis=1)
            best, far = np.full(len(x), -1), np.full(len(x), np.inf)
            step = max(1, SLICE_CELLS // max(1, len(centres)))
            for at in range(0, len(x) if len(centres) else 0, step):
                some = at + np.flatnonzero(whole[at:at + step])
                # any pivot will do: the distance to the chosen one is exact
                best[some] = np.argmin(size - 2 * x[some] @ centres.T, axis=1)
                far[some] = np.sqrt(((x[some] - centres[best[some]]) ** 2).sum(axis=1))
            yield pdf.assign(p=best, r=far)

    return rows.mapInPandas(place, f"id long, x array<double>, y {kind}, p long, r double")


def _packed(placed: DataFrame, sizes: dict[int, int], dims: int, block_rows: int) -> DataFrame:
    """Placed rows in blocks of one pivot and about ``block_rows`` rows: (p, block, ids, ys, xs)."""
    spark = placed.sparkSession
    # at most PIVOTS + 1 rows
    cuts = spark.createDataFrame([(p, -(-n // block_rows)) for p, n in sizes.items()] or [(-2, 1)], "p long, n int")
    d = placed.join(F.broadcast(cuts), "p").withColumn("block", F.pmod(F.xxhash64("id"), F.col("n")).cast("long"))

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id", kind="stable")
        x = np.array([[np.nan if v is None else v for v in r] for r in pdf["x"]], dtype="float64").reshape(len(pdf), dims)
        return pd.DataFrame({"p": [int(pdf["p"].iloc[0])], "block": [int(pdf["block"].iloc[0])], "ids": [pdf["id"].tolist()],
                             "ys": [pdf["y"].tolist()], "xs": [x.tobytes()]})

    kind = dict(d.dtypes)["y"]
    return checkpoint(d.select("p", "block", "id", "x", "y").groupBy("p", "block").applyInPandas(
        pack, f"p long, block long, ids array<long>, ys array<{kind}>, xs binary"))


def _reach(placed: DataFrame) -> dict[int, tuple[int, float]]:
    """Rows and radius of each pivot (at most PIVOTS + 1 rows)."""
    return {r["p"]: (r["n"], r["r"]) for r in placed.groupBy("p").agg(F.count(F.lit(1)).alias("n"), F.max("r").alias("r")).collect()}


def seed_pairs(q: dict, c: dict, pivots: np.ndarray, k: int) -> set[tuple[int, int]]:
    """For every query pivot, the nearest candidate pivots that hold ``k`` rows together."""
    found = set()
    for a in q:
        gap = lambda b: -1.0 if a < 0 or b < 0 else float(np.sqrt(((pivots[a] - pivots[b]) ** 2).sum()))
        held = 0
        for b in sorted((b for b in c if b >= 0 or a < 0), key=lambda b: (gap(b), b)):
            found.add((a, b))
            held += c[b][0]
            if held >= k and a >= 0:
                break
    return found


def open_pairs(q: dict, c: dict, pivots: np.ndarray, bound: dict[int, float]) -> set[tuple[int, int]]:
    """Pivot pairs that the triangle inequality leaves open: no query of ``a`` is farther from its
    k-th neighbour than ``bound[a]``, no row of ``b`` nearer than the gap between the two balls."""
    found = set()
    for a, (_, ra) in q.items():
        for b, (_, rb) in c.items():
            gap = 0.0 if a < 0 or b < 0 else float(np.sqrt(((pivots[a] - pivots[b]) ** 2).sum())) - ra - rb
            slack = 1e-9 * (abs(gap) + (0.0 if a < 0 or b < 0 else ra + rb))
            if gap - slack <= bound.get(a, np.inf):
                found.add((a, b))
    return found


def knn_topk(queries: DataFrame, cands: DataFrame, q_id: str, c_id: str, cols: Sequence[str],
             payload: str, k: int = 5, block_rows: int | None = None, nan_euclidean: bool = False,
             vector: str | None = None) -> DataFrame:
    """For every query row, its k nearest candidates as (q_id, rank, dist, c_id,
    payload); ties broken by candidate id.  Distances are Euclidean over
    ``cols`` (or the array column ``vector``); with ``nan_euclidean`` missing
    coordinates are skipped and the sum scaled by total/present (sklearn's
    nan_euclidean).

    Vectors have the length of the longest query vector; rows of either side that are null,
    of another length or, without ``nan_euclidean``, miss a coordinate (NULL or NaN) take no part.
    Equal candidates count by their ``k`` smallest ids and equal queries are searched
    once, so a hot group of equal rows is a few rows.
    """
    feats = F.col(vector).cast("array<double>") if vector else F.array(*[F.col(c).cast("double") for c in cols])
    dims = (queries.select(F.max(F.size(vector))).first()[0] or 0) if vector else len(cols)
    rows = block_rows or max(256, BLOCK_BYTES // (8 * max(1, dims)))
    ptype = dict(cands.dtypes)[payload]
    # a window limit: every task hands on at most k rows of a coordinate
    alike = F.row_number().over(Window.partitionBy("x").orderBy("id"))
    c_rows = checkpoint(_vectors(cands, c_id, feats, F.col(payload), dims, nan_euclidean)
                        .withColumn("_copy", alike).where(F.col("_copy") <= k).drop("_copy"))
    asked = checkpoint(_vectors(queries, q_id, feats, F.lit(0), dims, nan_euclidean))
    q_rows = asked.groupBy("x").agg(F.min("id").alias("id")).select("id", "x", F.lit(0).alias("y"))
    pivots = _pivots(c_rows, min(PIVOTS, max(1, -(-c_rows.count() // rows))))
    q_placed, c_placed = checkpoint(_placed(q_rows, pivots)), checkpoint(_placed(c_rows, pivots))
    q_reach, c_reach = _reach(q_placed), _reach(c_placed)
    q = _packed(q_placed, {p: n for p, (n, _) in q_reach.items()}, dims, rows)
    c = _packed(c_placed, {p: n for p, (n, _) in c_reach.items()}, dims, rows)
    spark = queries.sparkSession

    def top(batches):
        for pdf in batches:
            for row in pdf.itertuples(index=False):
                yield _block_top(row, dims, k, nan_euclidean)

    def met(pairs: set[tuple[int, int]]) -> DataFrame:
        """The k nearest in every pair of blocks of the given pivots."""
        near = spark.createDataFrame(sorted(pairs) or [(-2, -2)], "p long, cp long")
        both = (q.select("p", F.col("ids").alias("q_ids"), F.col("xs").alias("q_xs")).join(near, "p")
                .join(c.select(F.col("p").alias("cp"), "ids", "ys", "xs"), "cp"))
        found = both.select("q_ids", "q_xs", "ids", "ys", "xs").mapInPandas(top, f"_q long, _d double, _c long, _pl {ptype}")
        order = Window.partitionBy("_q").orderBy("_d", "_c")
        return found.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= k)

    seeds = seed_pairs(q_reach, c_reach, pivots, k)
    first = checkpoint(met(seeds))
    last = first.where(F.col("_rank") == k).select(F.col("_q").alias("id"), "_d")
    bounds = q_placed.join(last, "id", "left").groupBy("p").agg(F.max(F.coalesce("_d", F.lit(float("inf")))).alias("d"))
    rest = open_pairs(q_reach, c_reach, pivots, {r["p"]: r["d"] for r in bounds.collect()}) - seeds
    found = first.unionByName(met(rest)).drop("_rank")
    best = found.withColumn("_rank", F.row_number().over(Window.partitionBy("_q").orderBy("_d", "_c"))).where(F.col("_rank") <= k)
    lists = best.groupBy("_q").agg(F.collect_list(F.struct("_rank", "_d", "_c", "_pl")).alias("nn"))  # k entries
    answers = q_rows.select(F.col("id").alias("_q"), "x").join(lists, "_q").select("x", "nn")
    each = asked.select("id", "x").join(answers, "x").select("id", F.explode("nn").alias("n"))
    return each.select(F.col("id").alias(q_id), (F.col("n._rank") - 1).alias("rank"), F.col("n._d").alias("dist"),
                       F.col("n._c").alias(c_id + "_nn"), F.col("n._pl").alias(payload))


def _block_top(row, dims: int, k: int, nan_euclidean: bool) -> pd.DataFrame:
    """The k nearest rows of one candidate block for every row of one query block."""
    q_ids, ids = np.asarray(row.q_ids, dtype="int64"), np.asarray(row.ids, dtype="int64")
    ys = np.asarray(row.ys, dtype=object)
    q_all = np.frombuffer(row.q_xs).reshape(len(q_ids), dims)
    x = np.frombuffer(row.xs).reshape(len(ids), dims)
    x0, x_here = np.nan_to_num(x), ~np.isnan(x)
    middle = np.array([np.median(v[h]) if h.any() else 0.0 for v, h in zip(x0.T, x_here.T)])
    some = min(k + 16, len(ids))
    out = []

    def top(queries: np.ndarray, near: np.ndarray, wanted: np.ndarray) -> None:
        """Exact sums decide among the rows ``near`` that are ``wanted``."""
        q = q_all[queries]
        here = ~np.isnan(q)[:, None, :] & x_here[near]
        gap = np.where(here, np.nan_to_num(q)[:, None, :] - x0[near], 0.0)
        exact = (gap * gap).sum(axis=2)
        if nan_euclidean:
            exact = exact * dims / here.sum(axis=2)
        exact = np.where(wanted, exact, np.inf)
        order = np.lexsort((ids[near], exact), axis=1)[:, :k]
        d, c = np.take_along_axis(exact, order, 1), np.take_along_axis(near, order, 1)
        keep = np.isfinite(d)
        out.append(pd.DataFrame({"_q": np.broadcast_to(q_ids[queries][:, None], d.shape)[keep], "_d": np.sqrt(d[keep]),
                                 "_c": ids[c][keep], "_pl": ys[c][keep]}))

    # the fast formula cancels far from the origin: both sides are moved to the middle of
    # the block, and every row that its rounding error could put among the k stays
    step = max(1, SLICE_CELLS // max(1, len(ids)))
    with np.errstate(all="ignore"):
        xc = np.where(x_here, x0 - middle, 0.0)
        x_size = (xc ** 2).sum(axis=1)
        for at in range(0, len(q_ids), step):
            q = q_all[at:at + step]
            q_here = ~np.isnan(q)
            qc = np.where(q_here, np.nan_to_num(q) - middle, 0.0)
            both = q_here.astype(float) @ x_here.T.astype(float)
            rough = (qc ** 2) @ x_here.T + q_here @ (xc ** 2).T - 2 * qc @ xc.T
            error = 8 * (dims + 8) * np.finfo(float).eps * ((qc ** 2).sum(axis=1)[:, None] + x_size)
            if nan_euclidean:
                rough, error = rough * dims / both, error * dims / both
            known = both > 0 if nan_euclidean else both == dims
            limit = np.partition(np.where(known, rough + error, np.inf), min(k, len(ids)) - 1, axis=1)[:, min(k, len(ids)) - 1]
            open_ = known & ~(rough - error > limit[:, None])
            few = open_.sum(axis=1) <= some
            near = np.argpartition(~open_[few], some - 1, axis=1)[:, :some]
            top(at + np.flatnonzero(few), near, np.take_along_axis(open_[few], near, 1))
            for i in np.flatnonzero(~few):
                near = np.flatnonzero(open_[i])[None, :]
                top(np.array([at + i]), near, np.ones(near.shape, bool))
    return pd.concat(out)


def knn_classify(train: DataFrame, test: DataFrame, id_col: str, label: str, cols: Sequence[str] = (),
                 vector: str | None = None, k: int = 5, block_rows: int | None = None) -> DataFrame:
    """K8: ``KNeighborsClassifier(k)``: majority vote of the k nearest training
    rows, ties to the smallest label.  Output (id, predicted)."""
    nn = knn_topk(test, train, id_col, id_col, cols, label, k, block_rows, vector=vector)
    votes = nn.groupBy(id_col, label).agg(F.count(F.lit(1)).alias("_v"))
    return votes.groupBy(id_col).agg(F.min_by(label, F.struct(F.negative("_v"), F.col(label))).alias("predicted"))


def knn_impute(df: DataFrame, id_col: str, cols: Sequence[str], target: str, k: int = 5,
               block_rows: int | None = None) -> DataFrame:
    """``KNNImputer(n_neighbors=k)`` for one column: a missing ``target``
    takes the mean of the k nearest donors that have it (nan-Euclidean over
    ``cols``, unscaled); the column mean when no donor is comparable."""
    donors = df.where(F.col(target).isNotNull())
    need = df.where(F.col(target).isNull())
    feats = [c for c in cols if c != target]
    nn = knn_topk(need, donors, id_col, id_col, feats, target, k, block_rows, nan_euclidean=True)
    fill = nn.groupBy(id_col).agg(F.avg(target).alias("_fill"))
    out = O.join_on_keys(df, fill, [id_col], "left")
    mean = donors.agg(F.avg(target)).scalar()
    return out.withColumn(target, F.coalesce(F.col(target), F.col("_fill"), mean)).drop("_fill")


# ---------------------------------------------------------------- K12 density clustering

def _square(a: str, b: str) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, v: s + v)


def _cell_pairs(cells: DataFrame, dims: int, side: float, eps: float) -> DataFrame:
    """(a, b) of the occupied cells that can hold rows within ``eps``, both ways and
    with themselves.  The join key is the first three coordinates, shifted."""
    first = min(dims, 3)
    reach = math.ceil(eps / side)
    shifts = F.array(*[F.array(*[F.lit(v).cast("long") for v in o]) for o in product(range(-reach, reach + 1), repeat=first)])
    head = F.slice("cell", 1, first)
    left = cells.select(F.col("cell").alias("a"), F.explode(F.transform(shifts, lambda o: F.zip_with(head, o, lambda x, y: x + y))).alias("key"))
    right = cells.select(F.col("cell").alias("b"), head.alias("key"))
    gap = F.zip_with("a", "b", lambda x, y: F.greatest(F.abs(x - y) - 1, F.lit(0)).cast("double") * side)
    near = F.aggregate(gap, F.lit(0.0), lambda s, v: s + v * v) <= eps * eps * (1 + 1e-9)
    return left.join(right, "key").where(near).select("a", "b")


#: Rows of distinct coordinates on the two sides of a pair of boxes that are compared one by one;
#: boxes with more are split, each side into ``SPLIT`` ** dimensions boxes.
COMPARED = 256
SPLIT = 4


def _box(x, side: float) -> Column:
    return F.transform(x, lambda v: F.floor(v / F.lit(side)))


def _corners(a: Column, b: Column, side_a: float, side_b: float, nearest: bool) -> Column:
    """Square of the least (or greatest) distance of points of two boxes; a point is a box of side 0."""
    def gap(p, q):
        low_p, low_q = (p * F.lit(side_a or 1.0)), (q * F.lit(side_b or 1.0))
        if nearest:
            d = F.greatest(low_p - low_q - F.lit(side_b), low_q - low_p - F.lit(side_a), F.lit(0.0))
        else:
            d = F.greatest(low_p + F.lit(side_a) - low_q, low_q + F.lit(side_b) - low_p)
        return d * d
    return F.aggregate(F.zip_with(a, b, gap), F.lit(0.0), lambda s, v: s + v)


def _counted_within(points: DataFrame, rows: DataFrame, side: float, eps: float) -> DataFrame:
    """(id, b, k): how many of ``rows`` (cell, x, n: coordinates held by n rows) of cell ``b`` lie within
    ``eps`` of each of ``points`` (id, x, b), where any do.

    Boxes wholly inside count by their rows, boxes wholly outside by none; a box cut by the
    circle is compared row by row if it is small and split otherwise.  Counts of
    one point over boxes of all sizes add up.
    """
    e2, found = eps * eps, []
    open_, level = points.select("id", "x", "b"), side / 2
    inner = rows.select(F.col("cell").alias("b"), F.col("x").alias("y"), "n")
    previous = None
    while True:
        keyed = inner.withColumn("box", _box("y", level))
        boxes = keyed.groupBy("b", "box").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("distinct"))
        if previous is None:
            met = open_.join(boxes, "b")
        else:
            shrunk = previous
            met = (open_.withColumnRenamed("box", "outer")
                   .join(boxes.withColumn("outer", F.transform("box", lambda v: F.floor(v / F.lit(shrunk)))), ["b", "outer"]).drop("outer"))
        met = met.withColumns({"near": _corners(F.col("x"), F.col("box"), 0.0, level, True), "far": _corners(F.col("x"), F.col("box"), 0.0, level, False)})
        met = checkpoint(met.where(F.col("near") <= e2 * (1 + 1e-9)))
        inside = F.col("far") <= e2 * (1 - 1e-9)
        found.append(met.where(inside).select("id", "b", F.col("n").alias("k")))
        last = level < eps * 1e-9  # floats end here: compare what is left
        small = (F.col("distinct") <= COMPARED) | F.lit(last)
        cut = met.where(~inside & small).select("id", "x", "b", "box").join(keyed, ["b", "box"])
        found.append(cut.where(_square("x", "y") <= e2).select("id", "b", F.col("n").alias("k")))
        open_ = met.where(~inside & ~small).select("id", "x", "b", "box")
        if last or open_.isEmpty():
            every = found[0]
            for part in found[1:]:
                every = every.unionByName(part)
            return every.groupBy("id", "b").agg(F.sum("k").alias("k"))
        previous, level = SPLIT, level / SPLIT


def _linked_cells(core: DataFrame, link: DataFrame, side: float, eps: float) -> DataFrame:
    """The pairs of cells of ``link`` (a, b) with two rows of ``core`` (cell, x) within ``eps``.

    Pairs of boxes of the two cells are decided by their corners: near enough as a whole links the
    cells, too far ends the pair; small open boxes are compared row by row, others split.
    """
    e2, found = eps * eps, []
    open_, level, previous = link.select("a", "b"), side / 2, None
    while True:
        keyed = core.select("cell", "x", _box("x", level).alias("box"))
        boxes = keyed.groupBy("cell", "box").agg(F.count(F.lit(1)).alias("n"))
        outer = (lambda c: []) if previous is None else (lambda c: [F.transform("box", lambda v: F.floor(v / F.lit(SPLIT))).alias(c)])
        left = boxes.select(F.col("cell").alias("a"), F.col("box").alias("box_a"), F.col("n").alias("n_a"), *outer("out_a"))
        right = boxes.select(F.col("cell").alias("b"), F.col("box").alias("box_b"), F.col("n").alias("n_b"), *outer("out_b"))
        met = (open_.join(left, ["a"] if previous is None else ["a", "out_a"])
               .join(right, ["b"] if previous is None else ["b", "out_b"]))
        met = met.withColumns({"near": _corners(F.col("box_a"), F.col("box_b"), level, level, True),
                               "far": _corners(F.col("box_a"), F.col("box_b"), level, level, False)})
        met = checkpoint(met.where(F.col("near") <= e2 * (1 + 1e-9)))
        sure = met.where(F.col("far") <= e2 * (1 - 1e-9)).select("a", "b").distinct()
        unsure = met.join(sure, ["a", "b"], "left_anti")
        last = level < eps * 1e-9
        small = (F.col("n_a") + F.col("n_b") <= COMPARED) | F.lit(last)
        rows = (unsure.where(small).select("a", "b", "box_a", "box_b")
                .join(keyed.select(F.col("cell").alias("a"), F.col("box").alias("box_a"), "x"), ["a", "box_a"])
                .join(keyed.select(F.col("cell").alias("b"), F.col("box").alias("box_b"), F.col("x").alias("y")), ["b", "box_b"]))
        linked = checkpoint(sure.unionByName(rows.where(_square("x", "y") <= e2).select("a", "b").distinct()))
        found.append(linked)
        # a cell pair linked by any of its boxes needs no finer ones
        open_ = unsure.where(~small).join(linked, ["a", "b"], "left_anti").select(
            "a", "b", F.col("box_a").alias("out_a"), F.col("box_b").alias("out_b"))
        if last or open_.isEmpty():
            every = found[0]
            for part in found[1:]:
                every = every.unionByName(part)
            return every
        previous, level = SPLIT, level / SPLIT


def dbscan(df: DataFrame, id_col: str, cols: Sequence[str], eps: float = 0.5, min_samples: int = 5) -> DataFrame:
    """``DBSCAN(eps, min_samples)``, exact.

    Rows with equal coordinates are one point with a multiplicity, so a hot group is one row.

    1. core: at least ``min_samples`` rows (itself included) within ``eps``.  All
       rows of a cell are within ``eps`` of each other, so cells that full need no
       comparison; the points of other cells are counted against nearby cells, whole boxes
       at a time (:func:`_counted_within`);
    2. clusters: the core points of a cell belong together, so clusters are connected
       components of cells.  Two cells are linked if two of their core points are
       within ``eps``: ever finer boxes decide that by their corners, and points
       are compared only between small boxes (:func:`_linked_cells`);
    3. border points take the smallest cluster among core points within eps, others
       are noise (-1), as are rows with a missing coordinate.  Clusters are numbered
       by their smallest id, which is the order in which an index-order expansion
       discovers them.
    Output: ``id_col``, ``cluster``.
    """
    dims = len(cols)
    side = float(eps) / math.sqrt(dims) * (1 - 1e-9)
    every = df.select(id_col)
    x = F.array(*[F.col(c).cast("double") for c in cols])
    rows = df.select(F.col(id_col).alias("row"), x.alias("x")).where(~F.exists("x", lambda v: v.isNull() | F.isnan(v)))
    rows = checkpoint(rows)
    pts = checkpoint(rows.groupBy("x").agg(F.min("row").alias("id"), F.count(F.lit(1)).alias("n")).withColumn("cell", _box("x", side)))
    cells = pts.groupBy("cell").agg(F.sum("n").alias("held"))
    near = checkpoint(_cell_pairs(cells.select("cell"), dims, side, eps))
    sparse = pts.join(cells.where(F.col("held") < min_samples).select("cell"), "cell", "left_semi")
    around = checkpoint(sparse.select("id", "x", F.col("cell").alias("a")).join(near, "a").select("id", "x", "b"))

    counted = _counted_within(around, pts, side, eps).groupBy("id").agg(F.sum("k").alias("k")).where(F.col("k") >= min_samples)
    full = pts.join(cells.where(F.col("held") >= min_samples).select("cell"), "cell", "left_semi")
    core = checkpoint(full.select("id", "x", "cell").unionByName(
        sparse.join(counted.select("id"), "id", "left_semi").select("id", "x", "cell")))

    # links between cells that hold core points
    holds = core.select("cell").distinct()
    link = (near.where(F.col("a") < F.col("b")).join(holds.withColumnRenamed("cell", "a"), "a", "left_semi")
            .join(holds.withColumnRenamed("cell", "b"), "b", "left_semi"))
    linked = _linked_cells(core, link, side, eps)
    name = lambda c: F.concat_ws(",", F.transform(c, lambda v: v.cast("string")))
    roots = connected_components(linked.select(name("a").alias("a"), name("b").alias("b")))
    grouped = core.withColumn("node", name("cell")).join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    labels = grouped.groupBy("root").agg(F.min("id").alias("lab"))
    core_labels = checkpoint(grouped.join(labels, "root").select("id", "x", "cell", "lab"))

    border = around.join(core_labels.select("id"), "id", "left_anti")
    reached = _counted_within(border, core_labels.select("cell", "x", F.lit(1).cast("bigint").alias("n")), side, eps)
    cell_labels = core_labels.select(F.col("cell").alias("b"), "lab").distinct()  # all core points of a cell have one
    reached = reached.join(cell_labels, "b").groupBy("id").agg(F.min("lab").alias("lab"))
    labelled = core_labels.select("id", "lab").unionByName(reached)
    ranks = O.positions(labels.select("lab"), [], ["lab"], "cluster")
    numbered = labelled.join(ranks, "lab").select("id", F.col("cluster").cast("int").alias("cluster"))
    of_point = pts.join(numbered, "id").select("x", "cluster")
    out = rows.join(of_point, "x").select(F.col("row").alias(id_col), "cluster")
    return every.join(out, id_col, "left").withColumn("cluster", F.coalesce("cluster", F.lit(-1)))

"""Evaluation metrics over tables of label, prediction and score (M1-M7).

Each metric is one or two aggregation passes; keyed variants group by the keys.
"""

from __future__ import annotations

from typing import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowframe.operators import order as O
from flowframe.operators import tiles as TL
from flowframe.operators.order import as_list, join_on_keys
from flowframe.session import checkpoint


def regression_metrics(df: DataFrame, y: str, pred: str, keys=None) -> DataFrame:
    """M1: MSE, RMSE, MAE, R^2 (and MAPE) overall or per key.  Rows with a label of 0
    have no relative error and are left out of MAPE; R^2 of constant labels is NULL."""
    keys = as_list(keys)
    e = F.col(y) - F.col(pred)
    g = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.avg(e * e).alias("mse"), F.avg(F.abs(e)).alias("mae"),
        F.sum(e * e).alias("_sse"), F.var_pop(y).alias("_vy"),
        F.avg(F.try_divide(F.abs(e), F.abs(F.col(y)))).alias("mape"))
    return g.select(*keys, "n", "mse", F.sqrt("mse").alias("rmse"), "mae",
                    (1 - F.try_divide(F.col("_sse"), F.col("_vy") * F.col("n"))).alias("r2"), "mape")


def binary_metrics(df: DataFrame, y: str, pred: str, positive=1) -> DataFrame:
    """M2: accuracy and F1 of the positive class (0 when undefined)."""
    p = F.col(pred) == F.lit(positive)
    t = F.col(y) == F.lit(positive)
    g = df.agg(F.count(F.lit(1)).alias("n"), F.sum((F.col(y) == F.col(pred)).cast("long")).alias("_ok"),
               F.sum((p & t).cast("long")).alias("tp"), F.sum((p & ~t).cast("long")).alias("fp"),
               F.sum((~p & t).cast("long")).alias("fn"))
    f1 = F.coalesce(F.try_divide(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")), F.lit(0.0))
    return g.select((F.col("_ok") / F.col("n")).alias("accuracy"), f1.alias("f1"))


def roc_auc(df: DataFrame, y: str, score: str, positive=1) -> DataFrame:
    """M3: ROC AUC with tied scores sharing their average rank (rank-sum form).

    Rows are reduced to one row per distinct score (counts of positives and
    negatives); the number of rows below each score is an exclusive running sum
    over the distinct scores, computed with the scalable prefix (no global sort
    in one task)."""
    pos = (F.col(y) == F.lit(positive)).cast("long")
    g = df.groupBy(F.col(score).alias("_s")).agg(F.sum(pos).alias("_p"), F.count(F.lit(1)).alias("_c"))
    g = O.positions(g, [], ["_s"], "_gp")
    g = O.forward_prefix(g, [], "_gp", [("_upto", "sum", "_c")])
    below = F.col("_upto") - F.col("_c")
    ranks = g.select((F.col("_p") * (below + (F.col("_c") + 1) / 2.0)).alias("_rs"), "_p", "_c")
    t = ranks.agg(F.sum("_rs").alias("rs"), F.sum("_p").alias("n1"), F.sum("_c").alias("n"))
    n0 = F.col("n") - F.col("n1")
    return t.select(F.try_divide(F.col("rs") - F.col("n1") * (F.col("n1") + 1) / 2.0, F.col("n1") * n0).alias("roc_auc"))


def confusion_matrix(df: DataFrame, y: str, pred: str) -> DataFrame:
    """M5: one row per (label, predicted) pair over the label set, zeros included."""
    counts = df.groupBy(F.col(y).alias("label"), F.col(pred).alias("predicted")).agg(
        F.count(F.lit(1)).alias("count"))
    # the label set is small (classes); its pairs come from exploding it twice
    labels = df.select(F.col(y).alias("l")).union(df.select(F.col(pred).alias("l"))).agg(
        F.array_sort(F.collect_set("l")).alias("ls"))
    pairs = labels.select(F.explode("ls").alias("label"), "ls").select(
        "label", F.explode("ls").alias("predicted"))
    out = join_on_keys(pairs, counts, ["label", "predicted"], "left")
    return out.withColumn("count", F.coalesce("count", F.lit(0)))


def classification_report(df: DataFrame, y: str, pred: str) -> DataFrame:
    """M6: precision, recall, F1 and support per class, then 'accuracy',
    'macro avg' and 'weighted avg' rows; undefined ratios are 0."""
    cm = confusion_matrix(df, y, pred)
    tp = cm.where(F.col("label") == F.col("predicted")).select(F.col("label").alias("c"), F.col("count").alias("tp"))
    sup = cm.groupBy(F.col("label").alias("c")).agg(F.sum("count").alias("support"))
    npred = cm.groupBy(F.col("predicted").alias("c")).agg(F.sum("count").alias("npred"))
    t = join_on_keys(join_on_keys(tp, sup, ["c"]), npred, ["c"])
    z = lambda e: F.coalesce(e, F.lit(0.0))
    per = t.select(F.col("c").cast("string").alias("class"),
                   z(F.try_divide(F.col("tp"), F.col("npred"))).alias("precision"),
                   z(F.try_divide(F.col("tp"), F.col("support"))).alias("recall"),
                   z(F.try_divide(2 * F.col("tp"), F.col("support") + F.col("npred"))).alias("f1"),
                   F.col("support").cast("long").alias("support"), F.col("tp"))
    tot = per.agg(F.sum("support").alias("n"), F.sum("tp").alias("tp"), F.avg("precision").alias("mp"),
                  F.avg("recall").alias("mr"), F.avg("f1").alias("mf"),
                  F.sum(F.col("precision") * F.col("support")).alias("wp"),
                  F.sum(F.col("recall") * F.col("support")).alias("wr"),
                  F.sum(F.col("f1") * F.col("support")).alias("wf"))
    acc = F.col("tp") / F.col("n")
    summary = tot.select(F.explode(F.array(
        F.struct(F.lit("accuracy").alias("class"), acc.alias("precision"), acc.alias("recall"), acc.alias("f1"),
                 F.col("n").alias("support")),
        F.struct(F.lit("macro avg").alias("class"), F.col("mp").alias("precision"), F.col("mr").alias("recall"),
                 F.col("mf").alias("f1"), F.col("n").alias("support")),
        F.struct(F.lit("weighted avg").alias("class"), (F.col("wp") / F.col("n")).alias("precision"),
                 (F.col("wr") / F.col("n")).alias("recall"), (F.col("wf") / F.col("n")).alias("f1"),
                 F.col("n").alias("support")))).alias("r")).select("r.*")
    return per.drop("tp").unionByName(summary)


def silhouette_sq(df: DataFrame, id_col: str, vec: str, cluster: str) -> DataFrame:
    """M7 (squared Euclidean, ``silhouette_score(metric='sqeuclidean')``).

    ``sum_j |x - y_j|^2 = n_c |x|^2 - 2 x.S_c + Q_c`` with per-cluster count, vector
    sum and sum of squared norms, so each row meets the k cluster summaries
    instead of every other row: O(n k d) work, no pair of rows is ever formed.
    The Euclidean form (:func:`silhouette`) has no such shortcut.  ``a`` excludes the row itself (divide by n_c - 1); a row of a
    singleton cluster scores 0.
    """
    x = F.col(vec).cast("array<double>")
    base = df.select(F.col(id_col).alias("_id"), F.col(cluster).alias("_c"), x.alias("_x"),
                     F.aggregate(x, F.lit(0.0), lambda acc, v: acc + v * v).alias("_q"))
    comp = base.select("_c", F.posexplode("_x").alias("_d", "_v")).groupBy("_c", "_d").agg(F.sum("_v").alias("_sv"))
    sums = comp.groupBy("_c").agg(F.array_sort(F.collect_list(F.struct("_d", "_sv"))).alias("_S"))
    stats = base.groupBy("_c").agg(F.count(F.lit(1)).alias("_n"), F.sum("_q").alias("_qsum"))
    stats = join_on_keys(stats, sums, ["_c"]).select(
        F.col("_c").alias("_k"), "_n", "_qsum", F.transform("_S", lambda e: e["_sv"]).alias("_S"))
    # the cluster ids (k of them) are exploded onto every row, then the k
    # summaries are joined by id: k rows per input row, never n
    ks = stats.agg(F.collect_list("_k").alias("_ks")).scalar()
    per = base.select("*", F.explode(ks).alias("_k"))
    j = per.join(stats, "_k")  # k rows: AQE broadcasts it at run time
    dot = F.aggregate(F.zip_with("_x", "_S", lambda a, b: a * b), F.lit(0.0), lambda acc, v: acc + v)
    tot = F.col("_n") * F.col("_q") - 2 * dot + F.col("_qsum")
    own = F.col("_k") == F.col("_c")
    r = j.groupBy("_id").agg(
        F.max(F.when(own & (F.col("_n") > 1), F.try_divide(tot, F.col("_n") - 1))).alias("a"),
        F.max(F.when(own, F.col("_n") == 1)).alias("_single"),
        F.min(F.when(~own, tot / F.col("_n"))).alias("b"))
    sil = F.when(F.col("_single"), F.lit(0.0)).otherwise(
        F.coalesce(F.try_divide(F.col("b") - F.col("a"), F.greatest(F.col("a"), F.col("b"))), F.lit(0.0)))
    return r.agg(F.avg(sil).alias("silhouette"))


#: Numbers in one tile's sums by cluster and in a piece of them, and the share of the squared
#: norms below which a squared distance is taken from the differences.
SUM_CELLS = 1 << 22
PIECE_CELLS = 1 << 17
NEAR = 1e-6


def silhouette(df: DataFrame, id_col: str, vec: str, cluster: str, tile_rows: int = TL.TILE_ROWS) -> DataFrame:
    """M7: ``silhouette_score(X, labels)``, Euclidean and exact.

    Every distance is needed, so the cost grows with the square of the rows: tiles of at most
    ``tile_rows`` rows meet in pairs, each pair once, and a pair gives, for each row of either tile, its
    sum of distances to the rows of each cluster in the other - one block of numbers per piece of
    a tile, never a row per pair - which are summed per piece.  Distances come from matrix products; where two
    rows are so near that a product would round, from the differences.  Equal rows of a
    cluster meet once, with their number.  ``a`` excludes the row itself; a row of a
    singleton cluster scores 0, as does one with a = b = 0; rows whose vector or cluster is NULL take no part;
    of vectors of different lengths only those of the greatest do.  Use
    :func:`silhouette_sq` where the square is too much.
    """
    # single precision stays so until a task reads it
    single = df.schema[vec].dataType.simpleString() == "array<float>"
    kind = "float32" if single else "float64"
    x = F.col(vec) if single else F.col(vec).cast("array<double>")
    rows = df.select(F.col(cluster).alias("_c"), x.alias("_x")).where("_c is not null and _x is not null")
    dims = rows.agg(F.max(F.size("_x"))).first()[0] or 0
    points = rows.where(F.size("_x") == dims).groupBy("_c", "_x").agg(F.count(F.lit(1)).cast("double").alias("_w"))
    points = checkpoint(points.withColumn("_row", F.monotonically_increasing_id()))
    # clusters are numbered; k of them
    numbered = checkpoint(points.select("_c").distinct().withColumn("_k", F.row_number().over(Window.orderBy("_c")) - 1))
    n, k = points.count(), numbered.count()
    most = TL.rows_per_tile(n, dims, tile_rows)
    tiles = TL.tiles_of(n, min(most, max(256, SUM_CELLS // max(1, k))))
    piece_rows = max(16, min(1024, PIECE_CELLS // max(1, k)))
    placed = join_on_keys(points, numbered, ["_c"]).select(
        "_k", "_x", "_w", F.pmod(F.xxhash64("_row"), F.lit(tiles)).cast("long").alias("_tile"))

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"tile": [int(pdf["_tile"].iloc[0])], "ks": [pdf["_k"].tolist()], "ws": [pdf["_w"].tolist()],
                             "xs": [TL.matrix(pdf["_x"], kind).tobytes()]})

    packed = checkpoint(placed.groupBy("_tile").applyInPandas(pack, "tile long, ks array<int>, ws array<double>, xs binary"))
    left, right = (packed.select(F.col("tile").alias(side), *[F.col(c).alias(f"{side}_{c}") for c in ("ks", "ws", "xs")]) for side in "lr")

    def weights(ks: np.ndarray, ws: np.ndarray) -> np.ndarray:
        hot = np.zeros((len(ks), k))
        hot[np.arange(len(ks)), ks] = ws
        return hot

    def pieces(tile: int, total: np.ndarray, sizes: np.ndarray, ks: np.ndarray | None, ws: np.ndarray | None) -> pd.DataFrame:
        """Sums of a tile against another one in pieces, the other's cluster sizes as their last line; a tile
        against itself brings its rows' clusters and numbers."""
        cuts = range(0, len(total), piece_rows)
        return pd.DataFrame({"tile": tile, "piece": [at // piece_rows for at in cuts],
                             "sums": [np.vstack([total[at:at + piece_rows], sizes]).tobytes() for at in cuts],
                             "ks": [None if ks is None else ks[at:at + piece_rows].tolist() for at in cuts],
                             "ws": [None if ws is None else ws[at:at + piece_rows].tolist() for at in cuts]})

    def sums(batches):
        for pdf in batches:
            for t in pdf.itertuples(index=False):
                a, b = (np.frombuffer(v, kind).reshape(-1, dims).astype("float64") for v in (t.l_xs, t.r_xs))
                (ak, bk), (aw, bw) = (np.asarray(t.l_ks), np.asarray(t.r_ks)), (np.asarray(t.l_ws), np.asarray(t.r_ws))
                hot_a, hot_b = weights(ak, aw), weights(bk, bw)
                one, two, p, q = TL.augmented(a, b)
                total, back = np.empty((len(a), k)), np.zeros((len(b), k))
                step = max(1, TL.SLICE_CELLS // len(b))
                for at in range(0, len(a), step):
                    d = one[at:at + step] @ two.T
                    near = NEAR * (p[at:at + step] + q.max())
                    few = np.flatnonzero(d.min(axis=1) < near)
                    i, j = np.nonzero(d[few] < near[few, None])
                    d[few[i], j] = TL.exact_squares(a, b, few[i] + at, j)
                    np.sqrt(d, out=d)
                    total[at:at + step] = d @ hot_b
                    if t.l != t.r:
                        back += (hot_a[at:at + step].T @ d).T
                same = t.l == t.r
                yield pieces(t.l, total, hot_b.sum(axis=0), ak if same else None, aw if same else None)
                if not same:
                    yield pieces(t.r, back, hot_a.sum(axis=0), None, None)

    def score(pdf: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(v).reshape(-1, k) for v in pdf["sums"])
        total, sizes = total[:-1], total[-1]
        own = pdf[pdf["ks"].notna()].iloc[0]
        ks, ws, at = np.asarray(own["ks"], int), np.asarray(own["ws"]), np.arange(len(total))
        with np.errstate(divide="ignore", invalid="ignore"):
            a = total[at, ks] / (sizes[ks] - 1)
            mean = total / sizes
            mean[at, ks] = np.inf
            b = mean.min(axis=1)
            s = (b - a) / np.maximum(a, b)
        s = np.where((sizes[ks] > 1) & np.isfinite(b) & (np.maximum(a, b) > 0), s, 0.0)
        return pd.DataFrame({"s": [float((s * ws).sum())], "n": [float(ws.sum())]})

    parts = TL.tile_pairs(left, right, tiles, tiles, half=True).mapInPandas(sums, "tile long, piece int, sums binary, ks array<int>, ws array<double>")
    scored = parts.groupBy("tile", "piece").applyInPandas(score, "s double, n double")
    return scored.agg(F.try_divide(F.sum("s"), F.sum("n")).alias("silhouette"))

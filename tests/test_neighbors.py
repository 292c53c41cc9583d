"""Nearest neighbours far from the origin against sums over all pairs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowframe.operators.neighbors import knn_topk


def brute(queries, rows, k, nan_euclidean):
    out = {}
    for i, q in queries:
        found = []
        for j, x in rows:
            gaps = [(a - b) ** 2 for a, b in zip(q, x) if a is not None and b is not None]
            if len(gaps) == len(q) or (nan_euclidean and gaps):
                found.append((float(np.sqrt(sum(gaps) * (len(q) / len(gaps)))), j))
        out[i] = [j for _, j in sorted(found)[:k]]
    return out


@pytest.mark.parametrize("nan_euclidean", [False, True])
def test_large_coordinates_keep_their_nearest(spark, nan_euclidean):
    rng = random.Random(5)
    # seconds of an epoch, 40 rows at one place, an outlier, and gaps in the second column
    rows = [(i, (1.7e9 + (i * 7919) % 3000, 4.0)) for i in range(3000)]
    rows += [(3000 + i, (1.7e9 + 50.0, 4.0)) for i in range(40)] + [(3040, (1e15, 4.0)), (3041, (None, None)), (3042, (1.7e9, None))]
    queries = [(i, (1.7e9 + rng.randrange(3000), 4.0)) for i in range(20)] + [(20, (1.7e9 + 50.0, 4.0)), (21, (1.7e9 + 7.0, None))]
    frame = lambda found: spark.createDataFrame([(i, *x) for i, x in found], "id long, a double, b double").withColumn("y", F.lit(1))
    for block_rows in (None, 700):
        got = {}
        for r in knn_topk(frame(queries), frame(rows), "id", "id", ["a", "b"], "y", 5, block_rows, nan_euclidean).orderBy("rank").collect():
            got.setdefault(r["id"], []).append(r["id_nn"])
        assert got == {i: v for i, v in brute(queries, rows, 5, nan_euclidean).items() if v}


def test_far_pivots_are_never_joined(spark):
    from flowframe.operators import neighbors as NB
    rng = np.random.default_rng(3)
    centres = rng.uniform(-1000, 1000, (24, 3))
    x = np.vstack([c + rng.normal(size=(60, 3)) for c in centres])
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    frame = lambda found: spark.createDataFrame(found, "id long, v array<double>").withColumn("y", F.lit(1))
    asked = rows[::7]
    got = {}
    for r in knn_topk(frame(asked), frame(rows), "id", "id", [], "y", 5, 40, vector="v").orderBy("rank").collect():
        got.setdefault(r["id"], []).append(r["id_nn"])
    assert got == brute(asked, rows, 5, False)
    # the pivots that were joined, of all pairs
    c = NB._vectors(frame(rows), "id", F.col("v"), F.col("y"), 3, False)
    pivots = NB._pivots(c, 36)
    reach = NB._reach(NB._placed(c, pivots))
    seeds = NB.seed_pairs(reach, reach, pivots, 5)
    bound = {p: 2 * r for p, (_, r) in reach.items()}
    joined = seeds | NB.open_pairs(reach, reach, pivots, bound)
    assert len(joined) < 0.2 * len(reach) ** 2


def test_equal_rows_ties_and_other_lengths(spark):
    rows = [(i, [1.0, 2.0]) for i in range(500)] + [(500 + i, [1.0, 3.0 + i]) for i in range(50)]
    odd = [(900, [1.0, 2.0, 3.0]), (901, None), (902, [float("nan"), 2.0]), (903, [None, 2.0]), (904, [])]
    frame = lambda found: spark.createDataFrame(found, "id long, v array<double>").withColumn("y", F.col("id") % 2)
    for block in (60,):
        got = knn_topk(frame(rows + odd), frame(rows + odd), "id", "id", [], "y", 7, block, vector="v").collect()
        assert {r["id"] for r in got} == {900}  # the longest query vectors decide
        got = knn_topk(frame(rows), frame(rows + odd), "id", "id", [], "y", 7, block, vector="v").orderBy("id", "rank").collect()
        found = {}
        for r in got:
            found.setdefault(r["id"], []).append(r["id_nn"])
        assert found[499] == list(range(7)) and found[500] == [500, 0, 1, 2, 3, 4, 5] and len(found) == 550
    assert knn_topk(frame(rows).where("false"), frame(rows), "id", "id", [], "y", 7, vector="v").count() == 0
    assert knn_topk(frame(rows), frame(rows).where("false"), "id", "id", [], "y", 7, vector="v").count() == 0

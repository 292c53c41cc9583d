"""Exact top-k against brute force."""

import math
import random

import numpy as np
import pytest

from flowframe.llm import topk
from flowframe.llm.catalog import QUERIES, SQL
from tests.conftest import SF_SMALL
from tools.check_oracles import compare, duck


def brute(rows, asked, k):
    clean = [(i, [math.floor(64 * x) for x in v]) for i, v in rows
             if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    queries = {}
    for i, v in clean:
        if asked(i):
            queries[i] = min(v, queries.get(i, v))
    out = []
    for q, v in queries.items():
        scored = sorted((-sum(a * b for a, b in zip(v, c)), i) for i, c in clean if i != q)[:k]
        out += [(q, n, i, -s) for n, (s, i) in enumerate(scored, 1)]
    return sorted(out)


def test_small_blocks_with_ties_and_odd_vectors(llm, monkeypatch):
    for name, value in (("BLOCK_ROWS", 16), ("SLICE_ROWS", 8), ("QUERY_ROWS", 4)):
        monkeypatch.setattr(topk, name, value)
    rng = random.Random(5)
    rows = [(i, [rng.gauss(0, 1 + 3 * (i % 7 == 0)) for _ in range(6)]) for i in range(160)]
    rows += [(200 + i, [0.5, -0.25, 1.0, 0.0, 0.1, 2.0]) for i in range(60)]
    rows += [(300, None), (320, [None, 1.0]), (340, [float("nan")] * 6), (360, [float("inf")] * 6), (None, [1.0] * 6), (380, []),
             (400, [1.0, 2.0]), (420, [0.0] * 6), (20, [9.0] * 6), (3, [1.0] * 6), (3, [1.0] * 6)]
    frame = llm.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id bigint, embedding array<double>, rank int, score int")
    for k in (1, 5, 300):
        got = topk.top_k(frame, frame.where("vec_id % 20 = 0"), k)
        assert got.columns == ["query_id", "rank", "vec_id", "score"]
        assert sorted(map(tuple, got.collect())) == brute(rows, lambda i: i % 20 == 0, k)
    empty = frame.limit(0)
    assert topk.top_k(empty, empty).count() == 0


def test_large_components_stay_exact():
    big = 1 << 27
    rng = np.random.default_rng(1)
    q, c = (rng.integers(-big, big, (n, 8)) for n in (3, 50))
    assert (topk.products(q, c) == np.array([[sum(int(a) * int(b) for a, b in zip(x, y)) for y in c] for x in q])).all()


@pytest.mark.parametrize("name", ["op3_exact_top_k", "op5_url_filter", "op8_mix_sources"])
def test_query_matches_sql(llm, name):
    status, message = compare(llm, duck(SF_SMALL), name, QUERIES[name], SQL[name], SF_SMALL)
    assert status == "OK", message

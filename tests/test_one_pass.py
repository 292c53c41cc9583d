"""Operators that fold, merge or scan instead of gathering: D13, U1, A2, M7, I8."""

import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from flowframe.functions import text as TX
from flowframe.operators import group as G
from flowframe.operators import iterative as IT
from flowframe.operators import metrics as M
from flowframe.sources import io


def holes(spark, n=500, seed=1):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, 2))
    x = np.column_stack([1e4 + 50 * base[:, 0], base[:, 0] - base[:, 1] + 0.1 * rng.normal(size=n), 3 + base[:, 1] + 0.1 * rng.normal(size=n), base.sum(axis=1)])
    lost = rng.random(x.shape) < [0.3, 0.2, 0.1, 0.0]
    pdf = pd.DataFrame(x, columns=list("abcd")).mask(lost).assign(id=np.arange(n), e=None)
    df = spark.createDataFrame(pdf.drop(columns="e")).withColumn("e", F.lit(None).cast("double"))
    return pdf, df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in "abcd"})


def dense(pdf, rounds, bayesian):
    """Column by column over the whole matrix, by the plain regressions."""
    x = pdf[list("abcd")].to_numpy(float)
    lost = np.isnan(x)
    mean, scale = np.nanmean(x, axis=0), np.nanstd(x, axis=0)
    z = np.where(lost, 0.0, (x - mean) / scale)
    order = sorted((j for j in range(4) if lost[:, j].any()), key=lambda j: lost[:, j].sum())
    for _ in range(rounds):
        for j in order:
            rest = [k for k in range(4) if k != j]
            a, y = z[~lost[:, j]][:, rest], z[~lost[:, j], j]
            if bayesian:
                c, m, ym = a - a.mean(axis=0), a.mean(axis=0), y.mean()
                noise, weight, old = 1 / (y.var() + np.finfo(float).eps), 1.0, None
                solve = lambda: np.linalg.solve(c.T @ c + weight / noise * np.eye(3), c.T @ (y - ym))
                s = np.linalg.svd(c, compute_uv=False) ** 2
                for _ in range(300):
                    w = solve()
                    used = (noise * s / (weight + noise * s)).sum()
                    weight = (used + 2e-6) / (w @ w + 2e-6)
                    noise = (len(y) - used + 2e-6) / (((y - ym - c @ w) ** 2).sum() + 2e-6)
                    if old is not None and np.abs(old - w).sum() < 1e-3:
                        break
                    old = w
                w = solve()
                z[lost[:, j], j] = ym + (z[lost[:, j]][:, rest] - m) @ w
            else:
                w = np.linalg.lstsq(np.column_stack([np.ones(len(a)), a]), y, rcond=None)[0]
                z[lost[:, j], j] = w[0] + z[lost[:, j]][:, rest] @ w[1:]
    return z * scale + mean


@pytest.mark.parametrize("bayesian", [False, True])
@pytest.mark.filterwarnings("ignore:iterative_impute")
def test_pattern_moments_agree_with_the_plain_form(spark, bayesian):
    pdf, df = holes(spark)
    exp = dense(pdf, 4, bayesian)
    got = IT.iterative_impute(df, "id", list("abcde"), max_iter=4, tol=0.0, bayesian=bayesian).orderBy("id").toPandas()
    assert got["e"].isna().all()
    assert got[list("abcd")].to_numpy(float) == pytest.approx(exp, rel=1e-7, abs=1e-7)
    single = IT.by_columns(df, "id", list("abcd"), max_iter=4, tol=0.0, bayesian=bayesian).orderBy("id").toPandas()
    assert single[list("abcd")].to_numpy(float) == pytest.approx(exp, rel=1e-7, abs=1e-7)


def test_a_round_is_two_passes_at_most_whatever_the_columns(spark, monkeypatch):
    pdf, df = holes(spark, 200)
    seen = []
    real = IT._round
    monkeypatch.setattr(IT, "_round", lambda patterns, order, bayesian: (seen.append(len(patterns)), real(patterns, order, bayesian))[1])
    out = IT.iterative_impute(df, "id", list("abcd"), max_iter=20)
    assert 1 < len(seen) < 20 and set(seen) == {seen[0]} and out.where("a is null or b is null or c is null").count() == 0


def test_a_hot_group_is_folded_in_many_tasks(spark):
    rows = spark.range(6000, numPartitions=12).select(F.when(F.col("id") % 10 < 7, F.lit(0)).when(F.col("id") % 10 < 9, F.col("id") % 5 + 1).alias("k"),
                                                      (F.col("id") % 97).cast("double").alias("x"))
    from pyspark import TaskContext
    # a state is (count, sum, the tasks that saw rows)
    update = lambda s, pdf: (s[0] + len(pdf), s[1] + float(pdf["x"].sum()), s[2] | {TaskContext.get().partitionId()})
    merge = lambda a, b: (a[0] + b[0], a[1] + b[1], a[2] | b[2])
    finish = lambda s: {"n": s[0], "mean": s[1] / s[0], "tasks": len(s[2])}
    got = G.group_fold(rows, ["k"], lambda: (0, 0.0, frozenset()), update, merge, finish, "n bigint, mean double, tasks bigint", join=False)
    exp = {r["k"]: (r["n"], r["m"]) for r in rows.groupBy("k").agg(F.count("*").alias("n"), F.avg("x").alias("m")).collect()}
    found = {r["k"]: (r["n"], pytest.approx(r["mean"])) for r in got.collect()}
    assert found == exp and None in exp
    assert next(r["tasks"] for r in got.collect() if r["k"] == 0) == 12
    joined = G.group_fold(rows, ["k"], lambda: (0, 0.0, frozenset()), update, merge, finish, "n bigint, mean double, tasks bigint")
    assert joined.columns == ["k", "x", "n", "mean", "tasks"] and joined.count() == 6000 and joined.where("n is null").count() == 0


def test_a_group_of_scattered_rows_is_updated_once_a_batch(spark):
    rows = spark.range(8000, numPartitions=8).select(F.when(F.col("id") % 200 > 0, F.col("id") % 200).alias("k"), F.col("id").alias("x"))
    update = lambda s, pdf: (s[0] + len(pdf), s[1] + int(pdf["x"].sum()), s[2] + 1)
    merge = lambda a, b: tuple(u + v for u, v in zip(a, b))
    finish = lambda s: {"n": s[0], "total": s[1], "calls": s[2]}
    got = G.group_fold(rows, ["k"], lambda: (0, 0, 0), update, merge, finish, "n bigint, total bigint, calls bigint", join=False).collect()
    exp = {r["k"]: (r["n"], r["t"]) for r in rows.groupBy("k").agg(F.count("*").alias("n"), F.sum("x").alias("t")).collect()}
    assert {r["k"]: (r["n"], r["total"]) for r in got} == exp and len(got) == 200
    assert max(r["calls"] for r in got) <= 2


def test_headers_are_read_in_one_job(spark, tmp_path):
    for i in range(60):
        head = "a,b" if i % 3 else "b,c,a"
        rows = [f"{i},{j}\n" if i % 3 else f"{j},9,{i}\n" for j in range(3)]
        (tmp_path / f"part{i:03d}.csv").write_text(f"{head}\n" + "".join(rows))
    sc = spark.sparkContext
    sc.setJobGroup("headers", "")
    found = io.csv_headers(spark, io.list_files(spark, str(tmp_path)))
    assert {k: len(v) for k, v in found.items()} == {"a,b": 40, "b,c,a": 20}
    jobs = len(sc.statusTracker().getJobIdsForGroup("headers"))
    sc.setJobGroup("", "")
    assert jobs <= 4  # listing, and one query of two stages under adaptive execution
    got = io.load_csv_dir(spark, str(tmp_path))
    assert got.count() == 180 and got.where("c = 9").count() == 60 and {r["a"] for r in got.collect()} == {str(i) for i in range(60)}
    (tmp_path / "none.csv").write_text("\n1,2\n")
    with pytest.raises(ValueError, match="none.csv"):
        io.load_csv_dir(spark, str(tmp_path))


def test_euclidean_silhouette_of_small_tiles(spark):
    rng = np.random.default_rng(2)
    x = np.vstack([rng.normal(c, 1, (20, 3)) for c in (0, 3, 9)] + [np.full((1, 3), 40.0)])
    label = [0] * 20 + [1] * 20 + [2] * 20 + [7]
    d = np.sqrt(((x[:, None] - x) ** 2).sum(-1))
    lab = np.array(label)
    s = []
    for i in range(61):
        own = (lab == lab[i]).sum() - 1
        a = d[i][lab == lab[i]].sum() / own if own else None
        b = min(d[i][lab == c].mean() for c in set(label) - {lab[i]})
        s.append((b - a) / max(a, b) if own else 0.0)
    rows = [(i, v.tolist(), c) for i, (v, c) in enumerate(zip(x, label))] + [(99, None, 1), (98, [1.0, 2.0, 3.0], None), (97, [1.0], 1)]
    df = spark.createDataFrame(rows, "id long, v array<double>, c int")
    for tile in (7, 4096):
        assert M.silhouette(df, "id", "v", "c", tile).first()[0] == pytest.approx(np.mean(s))
    assert M.silhouette(df.where("false"), "id", "v", "c").first()[0] is None


def test_euclidean_silhouette_takes_each_pair_of_tiles_once(spark, monkeypatch):
    made, tile_pairs = [], M.TL.tile_pairs

    def counted(*args, **kw):
        made.append((args[2], tile_pairs(*args, **kw)))
        return made[-1][1]

    monkeypatch.setattr(M.TL, "tile_pairs", counted)
    rng = np.random.default_rng(4)
    x = np.repeat(rng.normal(0, 1, (40, 4)), 3, axis=0)
    x[::3] += rng.normal(0, 1e-7, (40, 4))  # near copies, far from 0
    x += 1e3
    lab = rng.integers(0, 3, 120)
    d = np.sqrt(((x[:, None] - x) ** 2).sum(-1))
    s = []
    for i in range(120):
        a = d[i][lab == lab[i]].sum() / ((lab == lab[i]).sum() - 1)
        b = min(d[i][lab == c].mean() for c in {0, 1, 2} - {lab[i]})
        s.append((b - a) / max(a, b))
    df = spark.createDataFrame([(i, v.tolist(), int(c)) for i, (v, c) in enumerate(zip(x, lab))], "id long, v array<double>, c int")
    assert M.silhouette(df, "id", "v", "c", 20).first()[0] == pytest.approx(np.mean(s), abs=1e-9)
    (tiles, pairs), = made
    assert tiles > 3 and pairs.count() == tiles * (tiles + 1) // 2


@pytest.mark.parametrize("pattern", [r"(?P<a>[a-z]+)(?P<d>\d)?", r"([a-z]+)(\d*)", r"(?:(x+)|(\d*y))", r"(?P<k>\w)=(\d+)?"])
def test_groups_that_take_no_part_are_missing(spark, pattern):
    texts = ["ab1 c d22", "", "xx y 3y xy", "k=1 j= z=33", None, "é=5"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, s string")
    got = df.select("i", F.posexplode(TX.extract_all(F.col("s"), pattern)).alias("match", "m")).select("i", "match", "m.*").orderBy("i", "match")
    exp = pd.Series(texts).str.extractall(pattern).reset_index()
    names = [c if isinstance(c, str) else f"_{c}" for c in exp.columns[2:]]
    assert got.columns == ["i", "match", *names]
    rows = [tuple(None if pd.isna(v) else v for v in r) for r in exp.itertuples(index=False)]
    assert [tuple(r) for r in got.collect()] == rows
    with pytest.raises(ValueError):
        TX.extract_all(F.col("s"), re.sub(r"\((?!\?:)(\?P<\w>)?", "(?:", pattern))

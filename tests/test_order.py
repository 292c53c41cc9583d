"""Ordering core: positions, halo windows and prefixes against pandas, including
a series that holds most of the rows (hot key) and an unkeyed series."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from flowframe.operators import order as O
from flowframe.operators import windows as W


T0 = dt.datetime(2024, 1, 1)


def _skewed(spark, n=3000):
    rng = np.random.default_rng(7)
    key = np.where(rng.random(n) < 0.7, 0, rng.integers(1, 20, n))   # key 0 holds ~70 %
    t = rng.permutation(n)
    x = np.where(rng.random(n) < 0.2, np.nan, rng.normal(size=n))
    pdf = pd.DataFrame({"k": key.astype("int64"), "t": t.astype("int64"), "x": x})
    return pdf, spark.createDataFrame(pdf).withColumn("x", F.when(~F.isnan("x"), F.col("x")))


def test_positions_match_rank_with_hot_key(spark):
    pdf, df = _skewed(spark)
    got = O.positions(df, ["k"], ["t"], "p").toPandas().sort_values(["k", "t"]).reset_index(drop=True)
    exp = pdf.sort_values(["k", "t"]).reset_index(drop=True)
    exp["p"] = exp.groupby("k").cumcount()
    assert (got["p"].to_numpy() == exp["p"].to_numpy()).all()


def test_hot_key_spreads_over_blocks(spark):
    pdf, df = _skewed(spark)
    sk = O.sort_key(df, ["k"], ["t"])
    bounds = O.block_bounds(df, sk, 8)
    blocks = O.with_block(df.withColumn("_sk", sk), "_sk", bounds, 8)
    per = blocks.where("k = 0").groupBy("_blk").count().toPandas()
    assert len(per) >= 4                      # the hot key is cut into several blocks
    assert per["count"].max() < 0.5 * (pdf["k"] == 0).sum()


def test_unkeyed_positions(spark):
    pdf, df = _skewed(spark)
    got = O.positions(df, [], ["t"], "p").select("t", "p").toPandas()
    assert (got.sort_values("t")["p"].to_numpy() == np.arange(len(pdf))).all()


def test_lags_and_rolling_cross_segments(spark):
    pdf, df = _skewed(spark)
    out = W.lags(df, ["k"], ["t"], "x", [1, 3, -2], ["l1", "l3", "f2"])
    out = W.rolling_rows(out, ["k"], ["t"], "x", 4, ["mean"], prefix="r4")
    got = out.toPandas().sort_values(["k", "t"]).reset_index(drop=True)
    e = pdf.sort_values(["k", "t"]).reset_index(drop=True)
    g = e.groupby("k")["x"]
    np.testing.assert_allclose(got["l1"], g.shift(1), equal_nan=True)
    np.testing.assert_allclose(got["l3"], g.shift(3), equal_nan=True)
    np.testing.assert_allclose(got["f2"], g.shift(-2), equal_nan=True)
    np.testing.assert_allclose(got["r4_mean"], g.transform(lambda s: s.rolling(4).mean()), equal_nan=True)


def test_prefixes_ffill_bfill_expanding(spark):
    pdf, df = _skewed(spark)
    d = O.positions(df, ["k"], ["t"], "p")
    d = O.prefixes(d, ["k"], "p", forward=[("ff", "last", "x"), ("mx", "max", "x"), ("s", "sum", "x")],
                   backward=[("bf", "first", "x")])
    got = d.toPandas().sort_values(["k", "t"]).reset_index(drop=True)
    e = pdf.sort_values(["k", "t"]).reset_index(drop=True)
    g = e.groupby("k")["x"]
    np.testing.assert_allclose(got["ff"], g.ffill(), equal_nan=True)
    np.testing.assert_allclose(got["bf"], g.bfill(), equal_nan=True)
    np.testing.assert_allclose(got["mx"], g.transform(lambda s: s.expanding().max()), equal_nan=True)
    exp_sum = g.transform(lambda s: s.expanding().sum())
    np.testing.assert_allclose(got["s"], exp_sum, equal_nan=True)


def test_ewm_matches_pandas(spark):
    pdf, df = _skewed(spark, 600)
    got = W.ewm_mean(df, ["k"], ["t"], "x", span=7, name="e").toPandas().sort_values(["k", "t"])
    e = pdf.sort_values(["k", "t"])
    exp = e.groupby("k")["x"].transform(lambda s: s.ewm(span=7).mean())
    np.testing.assert_allclose(got["e"].to_numpy(), exp.to_numpy(), rtol=1e-12, equal_nan=True)


def test_rolling_time_matches_pandas(spark):
    rng = np.random.default_rng(3)
    n = 400
    ts = pd.Timestamp("2024-01-01") + pd.to_timedelta(np.sort(rng.choice(60 * 24, n, replace=False)), unit="h")
    pdf = pd.DataFrame({"ts": ts, "x": rng.normal(size=n)})
    df = spark.createDataFrame(pdf).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    got = W.rolling_time(df, [], "ts", "x", 7, ["mean", "std"], prefix="r", blocks=9).toPandas().sort_values("ts")
    exp = pdf.set_index("ts")["x"].rolling("7D")
    np.testing.assert_allclose(got["r_mean"].to_numpy(), exp.mean().to_numpy(), rtol=1e-9)
    np.testing.assert_allclose(got["r_std"].to_numpy(), exp.std().to_numpy(), rtol=1e-9, equal_nan=True)


def test_rolling_time_without_key_in_one_crowded_span(spark):
    """All rows within less than one window: blocks cut by rows, not by spans of time."""
    rng = np.random.default_rng(9)
    seconds = np.sort(rng.choice(3 * 86_400, 600, replace=False))
    pdf = pd.DataFrame({"ts": pd.Timestamp("2024-03-01") + pd.to_timedelta(seconds, unit="s"), "x": rng.normal(size=600)})
    df = spark.createDataFrame(pdf).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    got = W.rolling_time(df, [], "ts", "x", 7, ["mean"], prefix="r", blocks=8).toPandas().sort_values("ts")
    assert len(got) == 600
    assert np.allclose(got["r_mean"], pdf.set_index("ts")["x"].rolling("7D").mean())


def test_descending_text_and_large_integers(spark):
    from flowframe.operators import sort as S
    rows = [("b", 5), ("a", 2 ** 53 + 1), ("ab", 2 ** 53), ("", 1), ("é", -2 ** 63), (None, 2 ** 53 + 2), ("abc", None), ("b", 4)]
    df = spark.createDataFrame(rows, "s string, n bigint")
    got = S.sort_values(df, ["s", "n"], ascending=False, rank_col="r").orderBy("r").collect()
    assert [(r["s"], r["n"]) for r in got] == [("é", -2 ** 63), ("b", 5), ("b", 4), ("abc", None), ("ab", 2 ** 53), ("a", 2 ** 53 + 1), ("", 1), (None, 2 ** 53 + 2)]
    got = S.sort_values(df, ["n"], ascending=False, rank_col="r").orderBy("r").collect()
    assert [r["n"] for r in got] == [2 ** 53 + 2, 2 ** 53 + 1, 2 ** 53, 5, 4, 1, -2 ** 63, None]


@pytest.fixture
def many_blocks(spark):
    """The default number of shuffle partitions as the number of blocks."""
    held = spark.conf.get(O.BLOCKS_CONF)
    spark.conf.set(O.BLOCKS_CONF, "200")
    yield spark
    spark.conf.set(O.BLOCKS_CONF, held)


def test_plan_size_does_not_grow_with_the_blocks(many_blocks):
    """A later branch that prunes the rolled column must not repeat the block search."""
    spark = many_blocks
    rows = [(i % 3, T0 + dt.timedelta(hours=7 * i), float(i)) for i in range(400)]
    df = spark.createDataFrame(rows, "k int, t timestamp_ntz, x double")
    sizes = {}
    for blocks in (8, 200):
        spark.conf.set(O.BLOCKS_CONF, str(blocks))
        rolled = W.rolling_time(df, ["k"], "t", "x", 7)
        got = W.group_demean(rolled, ["k"], "x")
        sizes[blocks] = len(got._jdf.queryExecution().optimizedPlan().toString())
    assert sizes[200] < 4 * sizes[8] < 1_000_000
    exp = pd.DataFrame(rows, columns=["k", "t", "x"])
    exp["m"] = exp["x"] - exp.groupby("k")["x"].transform("mean")
    exp["r"] = exp.set_index("t").groupby("k")["x"].rolling("7D").mean().reset_index().sort_values(["t"]).set_index(exp.sort_values("t").index)["x"]
    out = {(r["k"], r["t"]): (r["x_roll7d_mean"], r["x_demeaned"]) for r in got.collect()}
    for _, r in exp.iterrows():
        a, b = out[r["k"], r["t"].to_pydatetime()]
        assert a == pytest.approx(r["r"]) and b == pytest.approx(r["m"])


def test_flagship_at_the_default_number_of_blocks(many_blocks):
    import duckdb

    from flowframe.plans.q_flagship import FLAGSHIP_SQL, daily_revenue_features
    path = "/root/testdata/sf0.001/orders.parquet"
    got = sorted(tuple(r) for r in daily_revenue_features(many_blocks.read.parquet(path)).collect())
    con = duckdb.connect()
    con.execute(f"create view orders as select * from '{path}'")
    exp = sorted(con.execute(FLAGSHIP_SQL).fetchall())
    assert len(got) == len(exp)
    for a, b in zip(got, exp):
        assert a[0] == b[0] and a[1:] == pytest.approx(b[1:], abs=0.011)


@pytest.mark.parametrize("alpha", [1e-6, 0.02, 0.999999, 1.0])
def test_ewm_has_no_horizon(spark, alpha, monkeypatch):
    """Many segments of 16 rows and several levels of folds, long gaps included."""
    monkeypatch.setattr(W, "FOLD", 3)
    n = 700
    x = np.random.default_rng(5).normal(size=n) + 100
    x[[*range(0, 20), *range(60, 62), *range(200, 560)]] = np.nan
    key = np.where(np.arange(n) % 5 == 0, 1, 0)
    pdf = pd.DataFrame({"k": key, "t": np.arange(n), "x": x, "seg": 1})
    df = spark.createDataFrame(pdf).withColumn("x", F.when(~F.isnan("x"), F.col("x")))
    for keys in ([], ["k"]):
        out = W.ewm_mean(df, keys, ["t"], "x", alpha=alpha, name="e")
        assert out.columns == ["k", "t", "x", "seg", "e"]
        got = out.toPandas().sort_values("t")["e"].to_numpy(float)
        groups = pdf.groupby("k")["x"] if keys else pdf.assign(k=0).groupby("k")["x"]
        exp = groups.transform(lambda v: v.ewm(alpha=alpha).mean()).to_numpy()
        assert (np.isnan(got) == np.isnan(exp)).all()
        assert got[~np.isnan(exp)] == pytest.approx(exp[~np.isnan(exp)], rel=1e-12)

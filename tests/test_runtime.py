"""Runtime behaviour that matters on a cluster: lazy and materialized ordering
agree, broadcasts only under a proven bound, checkpoints go to the session's
folder."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from flowframe.operators import order as O
from flowframe.session import ensure_checkpoint_dir


def test_lazy_and_materialized_positions_agree(spark):
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame({"k": rng.integers(0, 3, 1500), "t": rng.permutation(1500)})
    df = spark.createDataFrame(pdf)
    a = O.positions(df, ["k"], ["t"], "p").toPandas().sort_values(["k", "t"])["p"].to_numpy()
    spark.conf.set("flowframe.order.materialize", "false")
    try:
        b = O.positions(df, ["k"], ["t"], "p").toPandas().sort_values(["k", "t"])["p"].to_numpy()
    finally:
        spark.conf.set("flowframe.order.materialize", "true")
    assert (a == b).all()


def test_position_join_reuses_the_window_partitioning(spark):
    """Block offsets join on the window's own keys: the rows are not exchanged again."""
    df = spark.range(500).selectExpr("id % 3 AS k", "id AS t", "uuid() AS wide")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = O.positions(df, ["k"], ["t"], "p")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    moved = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x]
    assert not any("coalesce" in x for x in moved)
    # the rows once, the table of block counts three times (counts, prefix sums, join)
    assert len(moved) == plan.count("Exchange hashpartitioning(_series") == 4


def test_checkpoint_dir_from_session(spark):
    d = ensure_checkpoint_dir(spark)
    assert d and spark.sparkContext.getCheckpointDir()
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        assert conf.rstrip("/").split("/")[-1] in spark.sparkContext.getCheckpointDir()


def test_checkpoint_folder_is_asked_for_on_a_cluster(spark, monkeypatch):
    import pytest

    from flowframe import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())

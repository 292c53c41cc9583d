"""Session helpers: building a local session for tests and reading cluster settings."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, app: str = "flowframe",
              shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """Return the active session or build one (tests, bench).

    On a cluster the session is built by the launcher; we only read its settings.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    defaults = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.driver.memory": "16g",
        # remove checkpoint files once nothing references the checkpointed data
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    if shuffle_partitions:
        defaults["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    defaults.update(conf)
    for k, v in defaults.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the shared checkpoint folder named by ``spark.checkpoint.dir``.

    Only when the session names none (local tests) do we create a scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return configured
    if not re.fullmatch(r"local(\[.*\])?", sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    local = tempfile.mkdtemp(prefix="flowframe-ckpt-")
    sc.setCheckpointDir(local)
    return local


def conf_int(spark: SparkSession, key: str, default: int) -> int:
    v = spark.conf.get(key, None)
    return int(v) if v not in (None, "") else default


def shuffle_partitions(spark: SparkSession) -> int:
    return conf_int(spark, "spark.sql.shuffle.partitions", 200)


def checkpoint(df):
    """``df.checkpoint()`` into the session's checkpoint folder (reliable storage:
    survives executor loss and cuts the lineage).  Never ``localCheckpoint``."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()

"""Sources and sinks (inventory A1-A8)."""

from __future__ import annotations

import uuid
from typing import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from flowframe.session import ensure_checkpoint_dir

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's parquet tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint location (never machine-local
    on a cluster: ``spark.checkpoint.dir`` names a shared file system there)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/flowframe-io/{name}-{uuid.uuid4().hex[:12]}"


# ---------------------------------------------------------------- A1, A2 CSV

def read_csv(spark: SparkSession, path: str | Sequence[str], schema: StructType | str | None = None,
             header: bool = True, encoding: str = "UTF-8", parse_dates: Iterable[str] = (),
             timestamp_format: str | None = None) -> DataFrame:
    """A1: ``pd.read_csv(path, parse_dates=, encoding=)``.

    Give ``schema`` in production; without it every column is read as string
    (no inference pass) and ``parse_dates`` columns become TIMESTAMP_NTZ.
    """
    r = spark.read.option("header", header).option("encoding", encoding).option("mode", "PERMISSIVE")
    if schema is not None:
        r = r.schema(schema)
    if timestamp_format:
        r = r.option("timestampNTZFormat", timestamp_format)
    df = r.csv(path)
    for c in parse_dates:
        if schema is None or dict((f.name, f.dataType.simpleString()) for f in df.schema)[c] == "string":
            df = df.withColumn(c, F.try_to_timestamp(F.col(c), F.lit(timestamp_format))
                               .cast("timestamp_ntz") if timestamp_format
                               else F.col(c).try_cast("timestamp_ntz"))
    return df


def list_files(spark: SparkSession, data_dir: str, pattern: str = "*.csv") -> list[str]:
    """File names under ``data_dir`` matching a glob, listed by Spark's file index
    (works on any Hadoop file system).  Only paths reach the driver."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", pattern)
             .option("recursiveFileLookup", True)
             .load(data_dir).select("path"))
    return sorted(r.path for r in files.collect())


def csv_headers(spark: SparkSession, files: Sequence[str]) -> dict[str, list[str]]:
    """The files of each distinct first line, by one job: every file is one task that reads up to
    its first line, and lines are grouped on the executors."""
    # a file is never cut and never shares a task with another one
    sizes = {"spark.sql.files.maxPartitionBytes": str(1 << 62), "spark.sql.files.openCostInBytes": str(1 << 62)}
    held = {k: spark.conf.get(k) for k in sizes}

    def first(batches):
        for batch in batches:
            if batch.num_rows:
                yield batch.slice(0, 1)
                return

    try:
        for k, v in sizes.items():
            spark.conf.set(k, v)
        lines = spark.read.text(list(files)).select("value", F.col("_metadata.file_path").alias("path"))
        found = lines.mapInArrow(first, "value string, path string").groupBy("value").agg(F.sort_array(F.collect_list("path")).alias("paths"))
        return {r["value"]: r["paths"] for r in found.collect()}
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)


def load_csv_dir(spark: SparkSession, data_dir: str, pattern: str = "*.csv",
                 schema: StructType | None = None, parse_dates: Iterable[str] = ()) -> DataFrame:
    """A2: every matching CSV file, columns aligned **by name**; error if none match or if one
    begins with a blank line.  Files of no bytes are skipped.

    A single ``read.csv(glob)`` aligns by position, so files are grouped by their
    header line (:func:`csv_headers`) and each group is read once; groups are unioned by name.
    """
    files = list_files(spark, data_dir, pattern)
    if not files:
        raise FileNotFoundError(f"no file matches {pattern!r} in {data_dir}")
    groups = csv_headers(spark, files)
    if sum(map(len, groups.values())) < len(files) or any(not h.strip() for h in groups):
        plain = lambda path: path.split(":", 1)[-1].lstrip("/")  # noqa: E731 (a file system may write file:/ or file:///)
        headed = {plain(f) for h, fs in groups.items() if h.strip() for f in fs}
        raise ValueError(f"{next((f for f in files if plain(f) not in headed), files[0])} has no header line")
    parts = [read_csv(spark, fs, schema=schema, parse_dates=parse_dates)
             for h, fs in sorted(groups.items())]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def write_csv(df: DataFrame, path: str, header: bool = True, mode: str = "overwrite") -> str:
    """A3: ``to_csv(index=False)``; keep a key/time column as an ordinary column."""
    df.write.mode(mode).option("header", header).csv(path)
    return path


# ---------------------------------------------------------------- A4, A5 JSON

def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """A4: ``to_json(orient='records')`` as JSON lines (one record per line)."""
    df.write.mode(mode).json(path)
    return path


def write_json_records(df: DataFrame, path: str, rows_per_file: int = 50_000) -> str:
    """``to_json(orient='records')`` layout: each file holds one JSON array of
    records.  The number of files follows the row count, so no file (and no
    task building it) holds more than about ``rows_per_file`` records."""
    n = df.count()
    files = max(1, -(-n // rows_per_file))
    chunks = (df.repartition(files).withColumn("_chunk", F.spark_partition_id())
                .groupBy("_chunk").agg(F.to_json(F.collect_list(F.struct(*df.columns))).alias("value")))
    chunks.write.mode("overwrite").partitionBy("_chunk").text(path)
    return path


def read_json(spark: SparkSession, path: str, schema: StructType | str | None = None,
              multiline: bool = False) -> DataFrame:
    """A5: ``pd.read_json``; ``multiline=True`` reads one JSON array of records per file."""
    r = spark.read.option("multiLine", multiline)
    if schema is not None:
        r = r.schema(schema)
    out = r.json(path)
    # files written by write_json_records sit in _chunk=<n> folders
    return out.drop("_chunk") if "_chunk" in out.columns else out


# ---------------------------------------------------------------- A6 Parquet

def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: Sequence[str] = ()) -> str:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


# ---------------------------------------------------------------- A7, A8

def date_range(spark: SparkSession, start: str, end: str, freq: str = "D",
               name: str = "date") -> DataFrame:
    """``pd.date_range(start, end, freq='D'|'MS')`` as a one-column DATE table."""
    step = {"D": "INTERVAL 1 DAY", "MS": "INTERVAL 1 MONTH", "W": "INTERVAL 7 DAYS"}[freq]
    lo = F.to_date(F.lit(start))
    if freq == "MS":
        lo = F.trunc(lo, "MM")
        lo = F.when(lo < F.to_date(F.lit(start)), F.add_months(lo, 1)).otherwise(lo)
    return spark.range(1).select(F.explode(F.sequence(lo, F.to_date(F.lit(end)), F.expr(step))).alias(name))


def spine_of(df: DataFrame, ts: str, freq: str = "D", name: str = "date") -> DataFrame:
    """A7 over data: every day (or month start) between the min and max of ``ts``."""
    step = {"D": "INTERVAL 1 DAY", "MS": "INTERVAL 1 MONTH"}[freq]
    lo, hi = F.min(F.to_date(ts)), F.max(F.to_date(ts))
    if freq == "MS":
        lo, hi = F.trunc(lo, "MM"), F.trunc(hi, "MM")
    b = df.agg(lo.alias("_lo"), hi.alias("_hi"))
    return b.select(F.explode(F.sequence("_lo", "_hi", F.expr(step))).alias(name))


def small_table(spark: SparkSession, rows: list, schema: StructType | str) -> DataFrame:
    """An in-line dimension table (``pd.DataFrame({...})`` master)."""
    return spark.createDataFrame(rows, schema)

"""Shared helpers: table access, bounded Arrow batches, decimal hash shares."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from flowframe.session import ensure_checkpoint_dir

#: Text bytes that one step of a Python task holds at a time.
STEP_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id, folds: int):
    """crc32 of the id as text, modulo ``folds`` (a null id counts as the empty text)."""
    return F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8")) % folds


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not use yet (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    name = stem
    while name.lower() in taken:
        name += "_"
    return name


def steps(batch: pa.RecordBatch, column: int = 0, most: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Zero-copy slices of ``batch`` whose text in ``column`` has about ``most`` bytes.

    A single longer text is a slice of its own: texts are never cut.
    """
    sizes = pc.binary_length(batch.column(column)).fill_null(0).to_pylist()
    start = held = 0
    for i, n in enumerate(sizes):
        if i > start and held + n > most:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < len(sizes):
        yield batch.slice(start)


def map_text(df: DataFrame, text: str, added: str, step: Callable[[pa.Array], list[pa.Array]],
             setup: Callable[[], object] | None = None, most: int = STEP_BYTES) -> DataFrame:
    """``df`` with the columns ``added`` (a DDL string) that ``step`` computes from ``text``.

    ``step`` gets the texts of a bounded slice as one string array and returns one
    array per added column.  With ``setup``, ``step`` gets its result first; it runs
    once a task.  A slice has about ``most`` bytes of text.  Nulls stay null in the array: the step gives them their meaning.
    """
    kept = [F.col(f"`{c}`") for c in df.columns if c != text]
    fields = df.select(F.col(f"`{text}`").cast("string").alias(text), *kept)
    new_fields = StructType.fromDDL(added).fields
    schema = StructType([*fields.schema.fields, *new_fields])
    names = [f.name for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = setup() if setup else None
        for batch in batches:
            for part in steps(batch, most=most):
                texts = part.column(0)
                new = step(state, texts) if setup else step(texts)
                yield pa.RecordBatch.from_arrays([*part.columns, *new], names=names)

    out = fields.mapInArrow(run, schema)
    order = [*df.columns, *[f.name for f in new_fields]]
    return out.select(*[F.col(f"`{c}`") for c in order])


#: A key is hot if it has more than this share (1 / HOT_SHARE) of all rows.
HOT_SHARE = 500


def join_spread(left: DataFrame, right: DataFrame, key: str, count: str, total: int) -> DataFrame:
    """``left`` joined with ``right``, one row a ``key`` with the ``count`` of its rows.

    The counts add up to ``total``, so fewer than HOT_SHARE keys can be hot; exactly
    those are broadcast, and no hot key gathers its rows in one task.
    """
    hot = F.col(count) * HOT_SHARE > F.lit(total)
    added = [c for c in right.columns if c not in (key, count)]
    few = right.where(hot).select(key, F.lit(True).alias("__hot"), *[F.col(c).alias(f"__hot_{c}") for c in added])
    marked = left.join(F.broadcast(few), key, "left")
    warm = marked.where("__hot").select(*left.columns, *[F.col(f"__hot_{c}").alias(c) for c in added])
    cold = marked.where("__hot is null").select(*left.columns).join(right.where(~hot).select(key, *added), key)
    return warm.unionByName(cold.select(*left.columns, *added))


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once an application, so that Python tasks can
    import it wherever the driver was started."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="flowframe-code-")) / "flowframe_code.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for path in sorted(package.rglob("*.py")):
            archive.write(path, path.relative_to(package.parent))
    sc.addPyFile(str(target))
    _SHIPPED.add(sc.applicationId)


def stored(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet in the shared checkpoint folder and read back: cuts the
    lineage, survives lost executors, and gives the planner the real size."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)

"""SimHash near-duplicates by deletion-variant signatures.

A fingerprint has 64 bits: bit b is 1 if it is set in more than half of the XXH64
values (seed 42) of the text's word shingles.  Two fingerprints link at ``distance``
or fewer differing bits.

Search: the bits are cut into ``distance // 2 + 1`` segments, fewer than the
``distance + 1`` that exact segment matching needs.  If two fingerprints differ in at
most ``distance`` bits, one segment differs in at most one bit.  Each fingerprint is
indexed under every segment as it is, and under every segment with one bit wiped out
(a wildcard).  Pairs that share a signature are found by one equality join - with the
wildcard bit 0 on one side and 1 on the other, so that a pair meets once a segment -
and verified by the bit count of their XOR.

Defined results: a null or empty text has no shingle and fingerprint zero, which links
like any other; fewer words than the shingle length give one shingle of all words;
repeated rows each get a row back; rows with a null id take part, and the class id is
the smallest id that is not null (null if the class has none); an empty table gives an
empty result; other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowframe.llm.common import free_name, map_text
from flowframe.llm.components import connected_components
from flowframe.session import checkpoint

BITS = 64
#: Shingle hashes held at a time: a long text's votes are summed block by block.
VOTE_ROWS = 1 << 16


def shingle_spans(text: bytes, shingle: int) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The words joined by single spaces, and start and end of every shingle in it."""
    words = text.lower().split()
    if not words:
        return b"", np.zeros(0, np.int64), np.zeros(0, np.int64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - shingle + 1)
    return b" ".join(words), starts[:n], ends[len(words) - n:]


def fingerprint(text: bytes | None, shingle: int = 3) -> int:
    """The 64-bit SimHash of one text, unsigned."""
    joined, starts, ends = shingle_spans(text or b"", shingle)
    n = len(starts)
    if not n:
        return 0
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, VOTE_ROWS):
        spans = zip(starts[at:at + VOTE_ROWS].tolist(), ends[at:at + VOTE_ROWS].tolist())
        hashes = np.array([digest(joined[a:b], 42) for a, b in spans], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = 3,
                 out: str = "fingerprint") -> DataFrame:
    """``docs`` with the signed 64-bit fingerprint of each whole text."""

    def step(texts: pa.Array) -> list[pa.Array]:
        data = texts.cast(pa.binary())
        prints = np.array([fingerprint(x.as_py(), shingle) for x in data], dtype=np.uint64)
        return [pa.array(prints.view(np.int64))]

    return map_text(docs, text, f"`{out}` bigint", step)


def segments(distance: int) -> list[tuple[int, int]]:
    """(first bit, width) of each of the ``distance // 2 + 1`` segments."""
    n = distance // 2 + 1
    cuts = [BITS * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _variants(distance: int) -> Column:
    """Array of (signature, bit): the exact segments, then one wildcard each.

    The wildcard bit is -1 for exact segments.  Everything that identifies the
    variant (segment, wildcard position) is part of the signature.
    """
    fp, out = F.col("fp"), []
    for k, (first, width) in enumerate(segments(distance)):
        ones = (1 << width) - 1
        seg = F.shiftrightunsigned(fp, first).bitwiseAND(F.lit(ones if ones < 1 << 63 else -1))
        out.append(F.struct(F.lit(k * 65).alias("variant"), seg.alias("rest"), F.lit(-1).alias("bit")))
        for j in range(width):
            one = 1 << j if j < 63 else -(1 << 63)
            out.append(F.struct(F.lit(k * 65 + 1 + j).alias("variant"),
                                seg.bitwiseAND(F.lit(~one)).alias("rest"),
                                F.shiftrightunsigned(seg, j).bitwiseAND(F.lit(1)).cast("int").alias("bit")))
    return F.array(*out)


def linked_fingerprints(prints: DataFrame, distance: int = 3) -> DataFrame:
    """All pairs a < b of the distinct ``fp`` that differ in at most ``distance`` bits."""
    one = prints.select("fp", F.explode(_variants(distance)).alias("v")).select("fp", "v.*")
    # both sides read one exchange: same columns, same key
    left = one.select("variant", "rest", F.col("bit").alias("bit_a"), F.col("fp").alias("a"))
    right = one.select("variant", "rest", F.col("bit").alias("bit_b"), F.col("fp").alias("b"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance
    met = F.when(F.col("bit_a") < 0, F.col("a") < F.col("b")).otherwise(F.col("bit_a") < F.col("bit_b"))
    pairs = left.join(right, ["variant", "rest"]).where(met & near)
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    shingle: int = 3, distance: int = 3) -> DataFrame:
    """One row per row of ``docs``: its id, ``fingerprint`` (16 hex digits) and ``component_id``.

    The class graph has one node per distinct fingerprint, so a large group of exact
    copies is a single node; copies meet again only in the last join, whose docs side
    is salted.
    """
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    printed = checkpoint(fingerprints(rows, "text", shingle, "fp").select("doc_id", "fp"))
    found = attach(printed, classes(printed, distance))
    return found.select(F.col("doc_id").alias(doc_id),
                        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def classes(printed: DataFrame, distance: int = 3) -> DataFrame:
    """(fp, root, component_id) of every distinct ``fp`` of ``printed`` (doc_id, fp).

    ``root`` names the class (its smallest fingerprint), ``component_id`` is the
    smallest id in it.
    """
    nodes = checkpoint(printed.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = connected_components(linked_fingerprints(nodes.select("fp"), distance))
    marked = checkpoint(nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
                        .select("fp", F.coalesce("root", "fp").alias("root"), "least"))
    # salted minima need no join for fingerprints that are a class alone
    linked = roots.select("root").distinct()
    least = marked.join(linked, "root").groupBy("root").agg(F.min("least").alias("component_id"))
    return marked.join(least, "root", "left").select("fp", "root", F.coalesce("component_id", "least").alias("component_id"))


def attach(printed: DataFrame, found: DataFrame, salts: int = 16) -> DataFrame:
    """``printed`` with the class of its ``fp``; a hot fingerprint is spread over ``salts`` keys."""
    spread = printed.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(salts)).cast("int"))
    each = found.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return spread.join(each, ["fp", "salt"]).drop("salt")


def deduplicate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                shingle: int = 3, distance: int = 3) -> DataFrame:
    """``docs`` with one row of each class: the smallest id (nulls last), then the
    smallest row hash; of wholly equal rows one stays."""
    row_key = F.xxhash64(*[F.col(f"`{f.name}`") for f in docs.schema.fields if f.dataType.typeName() != "map"])
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"),
                       row_key.alias("row_key"))
    printed = checkpoint(fingerprints(rows, "text", shingle, "fp").drop("text"))
    found = attach(printed, classes(printed, distance).select("fp", "root"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_key")).alias("keep")
    kept = found.groupBy("root", F.pmod("row_key", F.lit(64))).agg(first).groupBy("root").agg(F.min("keep").alias("keep"))
    # one row per class; equal rows have one fingerprint, hence one class: the key is unique
    row, keep_id, keep_no_id, keep_row, copy = (free_name(docs, x) for x in ("__row", "__keep_id", "__keep_no_id", "__keep_row", "__copy"))
    kept = kept.select(F.coalesce("keep.doc_id", F.lit(0)).alias(keep_id), F.col("keep.no_id").alias(keep_no_id),
                       F.col("keep.row_key").alias(keep_row))
    own = F.col(f"`{doc_id}`")
    same = (F.coalesce(own, F.lit(0)) == F.col(keep_id)) & (own.isNull() == F.col(keep_no_id)) & (F.col(row) == F.col(keep_row))
    out = docs.withColumn(row, row_key).join(kept, same)
    if not printed.groupBy("doc_id", "row_key").count().where("count > 1").isEmpty():  # the join returned each of the equal rows
        first = F.row_number().over(Window.partitionBy(keep_id, keep_no_id, keep_row).orderBy(row))
        out = out.withColumn(copy, first).where(F.col(copy) == 1)
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])

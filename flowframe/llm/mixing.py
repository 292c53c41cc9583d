"""Mixing sources to target weights by Poisson replication.

Every source gets a repetition rate, so that the expected output has the target share
of each source: rate = total * weight / size.  A document's count is the inverse of the
Poisson distribution function with that mean at a number in [0, 1) hashed from the seed
and the document's id, so a rerun - or a rerun task - draws the same counts.  Documents
are exploded by their count and shuffled globally by a hash of seed, id and copy number.

The size of a document is its number of code points plus one.  A rate above
``PART_RATE`` is drawn as a sum of independent parts, because exp(-rate) would underflow.

Defined results: a null text counts as empty; null is a source of its own, apart from
the empty name; a null id is hashed like the empty text; rows with the same id draw the
same count; a source without a given weight has weight 0 and vanishes; an empty table
gives an empty result; further columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowframe.llm.common import free_name, stored

PART_RATE = 500.0
#: Hex digits of a hash that make a number in [0, 1): 52 bits are exact in a double.
DIGITS = 13


def unit(*parts: Column) -> Column:
    """A number in [0, 1) from the md5 of the parts joined by colons."""
    digest = F.md5(F.encode(F.concat_ws(":", *parts), "UTF-8"))
    return F.conv(F.substring(digest, 1, DIGITS), 16, 10).cast("double") / F.lit(float(16 ** DIGITS))


def source_sizes(docs: DataFrame, source: str = "source", text: str = "text") -> DataFrame:
    """(source, size): code points plus one a document, summed per source."""
    size = F.sum(F.coalesce(F.char_length(F.col(f"`{text}`").cast("string")), F.lit(0)) + 1)
    return docs.groupBy(F.col(f"`{source}`").alias("source")).agg(size.cast("double").alias("size"))


def damped_weights(sizes: DataFrame) -> DataFrame:
    """Weights in proportion to the square root of a source's size."""
    return sizes.select("source", F.sqrt("size").alias("weight"))


def rates(sizes: DataFrame, weights: DataFrame) -> DataFrame:
    """(source, parts, cdf): the distribution function of one part's Poisson count."""
    totals = sizes.agg(F.sum("size").alias("total"))
    given = weights.select(F.col("source").alias("to"), F.col("weight").cast("double").alias("weight"))
    wanted = sizes.join(given, F.col("source").eqNullSafe(F.col("to"))).drop("to")
    norm = wanted.agg(F.sum("weight").alias("weights"))
    # totals and norm have one row each
    rated = wanted.join(F.broadcast(totals)).join(F.broadcast(norm)).select(
        "source", (F.col("total") * (F.col("weight") / F.col("weights")) / F.col("size")).alias("rate"))
    parts = F.greatest(F.ceil(F.col("rate") / PART_RATE), F.lit(1))
    rated = rated.where("rate > 0").select("source", parts.cast("int").alias("parts"), (F.col("rate") / parts).alias("mean"))
    last = F.ceil(F.col("mean") + 12 * F.sqrt("mean") + 30).cast("int")
    start = F.struct(F.exp(-F.col("mean")).alias("p"), F.array(F.exp(-F.col("mean"))).alias("cdf"))

    def grow(acc: Column, k: Column) -> Column:
        p = acc["p"] * F.col("mean") / k
        return F.struct(p.alias("p"), F.concat(acc["cdf"], F.array(F.element_at(acc["cdf"], -1) + p)).alias("cdf"))

    cdf = F.aggregate(F.sequence(F.lit(1), last), start, grow, lambda acc: acc["cdf"])
    return rated.select("source", "parts", cdf.alias("cdf"))


def mix(docs: DataFrame, weights: DataFrame | None = None, seed: int = 0, doc_id: str = "doc_id",
        source: str = "source", text: str = "text", salts: int = 16) -> DataFrame:
    """``docs`` repeated to the target ``weights`` (source, weight) and shuffled.

    Without ``weights``: damped ones.  Adds ``copy`` (from 1) and ``mix_key``, the
    position in the global shuffle.  Rates come from a written table, so the planner
    broadcasts them only if their real size allows; beyond that the join key of a hot
    source is spread over ``salts`` keys.
    """
    sizes = stored(source_sizes(docs, source, text))
    table = stored(rates(sizes, damped_weights(sizes) if weights is None else weights))
    salt, parts, cdf, n, key = (free_name(docs, x) for x in ("__salt", "__parts", "__cdf", "__n", "__source"))
    copy, mix_key = free_name(docs, "copy"), free_name(docs, "mix_key")
    own_id = F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit(""))
    spread = docs.withColumn(salt, F.pmod(F.xxhash64(own_id), F.lit(salts)).cast("int"))
    each = table.select(F.col("source").alias(key), F.col("parts").alias(parts), F.col("cdf").alias(cdf),
                        F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias(salt))
    own_salt = free_name(docs, "__own_salt")
    joined = spread.withColumnRenamed(salt, own_salt).join(
        each, F.col(f"`{source}`").eqNullSafe(F.col(key)) & (F.col(own_salt) == F.col(salt))).drop(own_salt)

    def draw(part: Column) -> Column:
        u = unit(F.lit(str(seed)), own_id, part.cast("string"))
        return F.size(F.filter(F.col(cdf), lambda c: c <= u))

    count = F.aggregate(F.sequence(F.lit(1), F.col(parts)), F.lit(0), lambda acc, part: acc + draw(part))
    counted = joined.withColumn(n, count).where(F.col(n) > 0).drop(cdf, parts, key, salt)
    copies = counted.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(n)))).drop(n)
    place = F.conv(F.substring(F.md5(F.encode(F.concat_ws(":", F.lit(str(seed)), F.lit("copy"), own_id,
                                                        F.col(copy).cast("string")), "UTF-8")), 1, 15), 16, 10).cast("bigint")
    placed = copies.withColumn(mix_key, place)
    return placed.repartition(F.col(mix_key)).sortWithinPartitions(mix_key)


ORACLE = """
WITH RECURSIVE sizes AS (
  SELECT source, CAST(sum(coalesce(length(text), 0) + 1) AS DOUBLE) AS size FROM documents GROUP BY source),
rated AS (
  SELECT source, (SELECT sum(size) FROM sizes) * (sqrt(size) / (SELECT sum(sqrt(size)) FROM sizes)) / size AS rate FROM sizes),
part AS (
  SELECT source, CAST(greatest(ceil(rate / 500.0), 1) AS INTEGER) AS parts, rate / greatest(ceil(rate / 500.0), 1) AS mean FROM rated),
cdf AS (
  SELECT source, 0 AS k, exp(-mean) AS p, exp(-mean) AS c FROM part
  UNION ALL
  SELECT cdf.source, k + 1, p * mean / (k + 1), c + p * mean / (k + 1)
  FROM cdf JOIN part ON cdf.source IS NOT DISTINCT FROM part.source WHERE k < ceil(mean + 12 * sqrt(mean) + 30)),
cdfs AS (SELECT source, list(c) AS cs FROM cdf GROUP BY source),
drawn AS (
  SELECT d.*, list_sum(list_transform(range(1, p.parts + 1), lambda i: len(list_filter(f.cs, lambda c:
      c <= CAST('0x' || substr(md5('11:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || i), 1, 13) AS BIGINT) / 4503599627370496.0)))) AS n
  FROM documents d JOIN part p ON d.source IS NOT DISTINCT FROM p.source
  JOIN cdfs f ON d.source IS NOT DISTINCT FROM f.source),
copies AS (SELECT * EXCLUDE (n), unnest(range(1, CAST(n AS BIGINT) + 1)) AS copy FROM drawn)
SELECT * EXCLUDE (copy), CAST(copy AS INTEGER) AS copy,
  CAST('0x' || substr(md5('11:copy:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || copy), 1, 15) AS BIGINT) AS mix_key
FROM copies
"""

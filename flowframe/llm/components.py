"""Distributed connected components over an edge table.

Alternating star contraction: the large-star step links every larger neighbour of a
node to the node's smallest neighbour, the small-star step does the same for the
smaller neighbours, until the edge set stands still; then every node is linked to the
smallest node of its component.  Smallest neighbours come from partially aggregated
minima, never from gathered neighbour lists.  A node with very many edges is not
joined through one key: at most ``2 * HOT_SHARE`` nodes can hold a ``1 / HOT_SHARE``
share of the edge ends, so exactly those go by broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowframe.session import checkpoint

#: A node is hot if it holds more than this share (1 / HOT_SHARE) of all edge ends.
HOT_SHARE = 500


def _with_least(ends: DataFrame, total: int) -> DataFrame:
    """``ends`` (u, v) with ``m``, the smallest of u and all its v."""
    least = ends.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"))
    least = least.withColumn("m", F.least("u", "m"))
    hot = F.col("n") * HOT_SHARE > F.lit(total)
    # fewer than HOT_SHARE rows whatever the input: each holds over 1 / HOT_SHARE of the ends
    few = F.broadcast(least.where(hot).select("u", F.col("m").alias("hot_m")))
    marked = ends.join(few, "u", "left")
    by_key = (marked.where(F.col("hot_m").isNull()).select("u", "v")
              .join(least.where(~hot).select("u", "m"), "u"))
    return marked.where(F.col("hot_m").isNotNull()).select("u", "v", F.col("hot_m").alias("m")).unionByName(by_key)


def _tidy(edges: DataFrame) -> DataFrame:
    """Distinct edges from the smaller (a) to the larger (b) node."""
    return (edges.where(F.col("a") != F.col("b"))
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count(F.lit(1)), F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0))).first()
    return int(row[0]), int(row[1])


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); root is the smallest node.

    Self-loops alone give no row; null ends are ignored; no edge gives an empty result.
    The loop ends only when the edges are stars, whatever the number of rounds.
    """
    edges = checkpoint(_tidy(edges.select("a", "b").where(F.col("a").isNotNull() & F.col("b").isNotNull())))
    state = _state(edges)
    while state[0]:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        large = _with_least(both, 2 * state[0]).where(F.col("v") > F.col("u")).select(
            F.col("m").alias("a"), F.col("v").alias("b"))
        large = checkpoint(_tidy(large))
        down = large.select(F.col("b").alias("u"), F.col("a").alias("v"))
        small = _with_least(down, state[0]).select("u", "v", "m")
        pairs = small.select(F.col("m").alias("a"), F.explode(F.array("u", "v")).alias("b"))
        edges = checkpoint(_tidy(pairs))
        now = _state(edges)
        if now == state:
            break
        state = now
    rooted = edges.select(F.col("b").alias("node"), F.col("a").alias("root"))
    return rooted.unionByName(edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())

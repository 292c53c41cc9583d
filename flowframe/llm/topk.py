"""Exact top-k inner-product search over norm-sorted blocks.

Candidates are range-partitioned by descending length (ties spread by a hash of the id)
and packed into blocks; queries are packed the same way.  Every query block first meets
the block of the longest candidates, which gives each query a threshold: its k-th best
score so far.  By Cauchy-Schwarz a block whose longest vector times the query's length
stays below the threshold cannot hold a result, so that pair of blocks is never joined.

Within a pair, candidates go in slices of descending length.  Vectors are rotated by
the SVD basis of all candidates, so that the first coordinates carry most of the
product: the partial sum over them plus the product of the residual lengths bounds a
score from above.  What the bound leaves is scored exactly on the integer components.

Components are floor(64 * x).  Defined results: null vectors, vectors with a null or
non-finite component and rows with a null id take no part; vectors of different length
compare as if padded with zeros; rows that share the query's id are not its candidates;
an id repeated among the queries asks once, with its smallest vector; a repeated
candidate id gives one result a row; ties go to the smaller id; fewer than k candidates
give all of them; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowframe.llm.common import stored

BLOCK_ROWS = 4096
#: Candidates scored at a time against a query block; also bounds a slice's score matrix.
SLICE_ROWS = 1024
QUERY_ROWS = 1024
#: Above this share of surviving (query, candidate) pairs one dense product is cheaper.
DENSE_SHARE = 0.05
LAST_ID = np.iinfo(np.int64).max
BLOCK_DDL = "block bigint, n int, dims int, longest double, ids binary, data binary"


def whole_numbers(vector: Column) -> Column:
    """floor(64 * x) of every component; null unless all components are finite."""
    good = vector.isNotNull() & ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    return F.when(good, F.transform(vector, lambda x: F.floor(F.lit(64.0) * x.cast("double"))))


def blocks(vectors: DataFrame, rows: int) -> DataFrame:
    """Blocks of (id, x), by descending length over the whole table; numbered so too."""
    length = F.aggregate("x", F.lit(0.0), lambda a, v: a + v.cast("double") * v.cast("double"))
    sized = vectors.withColumn("length", length)
    n = max(1, -(-sized.count() // rows))
    tie = F.xxhash64("id")
    ranged = sized.repartitionByRange(n, F.col("length").desc(), tie).sortWithinPartitions(F.col("length").desc(), tie)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, k = TaskContext.get().partitionId(), 0
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                piece = batch.slice(at, rows)
                lists = piece.column("x")
                lens = np.diff(lists.offsets.to_numpy())
                dims = int(lens.max(initial=0))
                data = np.zeros((len(lens), dims), np.int64)
                data[np.arange(dims) < lens[:, None]] = lists.flatten().to_numpy()
                ids = piece.column("id").to_numpy()
                small = next(t for t in (np.int8, np.int16, np.int32, np.int64)
                             if not data.size or (data.min() >= np.iinfo(t).min and data.max() <= np.iinfo(t).max))
                yield pa.RecordBatch.from_pylist([{
                    "block": (part << 32) + k, "n": len(ids), "dims": dims,
                    "longest": float(np.sqrt(piece.column("length").to_numpy().max())),
                    "ids": ids.tobytes(), "data": data.astype(small).tobytes()}], schema=SCHEMA)
                k += 1

    return stored(ranged.select("id", "x", "length").mapInArrow(pack, BLOCK_DDL))


SCHEMA = pa.schema([("block", pa.int64()), ("n", pa.int32()), ("dims", pa.int32()), ("longest", pa.float64()),
                    ("ids", pa.binary()), ("data", pa.binary())])


def unpack(n: int, dims: int, ids: bytes, data: bytes) -> tuple[np.ndarray, np.ndarray]:
    kinds = {1: np.int8, 2: np.int16, 4: np.int32, 8: np.int64}
    kind = kinds[len(data) // (n * dims)] if n * dims else np.int64
    return np.frombuffer(ids, np.int64), np.frombuffer(data, kind).reshape(n, dims).astype(np.int64)


def gram(candidates: DataFrame) -> DataFrame:
    """Sums of products of every two components, one row a task (dims x dims numbers)."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((0, 0))
        for batch in batches:
            for row in batch.to_pylist():
                x = unpack(row["n"], row["dims"], row["ids"], row["data"])[1].astype(float)
                d = max(len(total), row["dims"])
                grown = np.zeros((d, d))
                grown[:len(total), :len(total)] = total
                grown[:row["dims"], :row["dims"]] += x.T @ x
                total = grown
        i, j = np.indices(total.shape)
        yield pa.RecordBatch.from_arrays([pa.array(i.ravel().astype(np.int32)), pa.array(j.ravel().astype(np.int32)),
                                          pa.array(total.ravel())], names=["i", "j", "v"])

    return candidates.mapInArrow(add, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))


def rotation(candidates: DataFrame) -> np.ndarray:
    """The right singular vectors of all candidates, strongest first (dims x dims)."""
    cells = gram(candidates).toPandas()
    d = int(cells["i"].max()) + 1 if len(cells) else 0
    g = np.zeros((d, d))
    g[cells["i"], cells["j"]] = cells["v"]
    return np.linalg.eigh(g)[1][:, ::-1] if d else g


def products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers, dense."""
    most = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * max(1, q.shape[1])
    if most < 2.0 ** 53:  # every partial sum is exact in a double, and BLAS is fast
        return (q.astype(float) @ c.T.astype(float)).astype(np.int64)
    return q @ c.T


def search(q_ids: np.ndarray, q: np.ndarray, c_ids: np.ndarray, c: np.ndarray, basis: np.ndarray,
           k: int, floor: np.ndarray, floor_id: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best of ``c`` for each row of ``q`` that rank before (``floor``, ``floor_id``).

    Returns scores and ids (rows x k) and a mask of the cells in use.  ``c`` is sorted
    by descending length.
    """
    d = max(q.shape[1], c.shape[1], len(basis))
    q, c = (np.pad(x, ((0, 0), (0, d - x.shape[1]))) for x in (q, c))
    turn = np.eye(d)
    turn[:len(basis), :len(basis)] = basis
    head = -(-d // 4)
    qr, cr = q.astype(float) @ turn[:, :head], c.astype(float) @ turn[:, :head]
    q_len, c_len = (np.sqrt((x.astype(float) ** 2).sum(axis=1)) for x in (q, c))
    q_rest, c_rest = (np.sqrt(np.maximum(0, n ** 2 - (x ** 2).sum(axis=1)) + 1e-9 * n ** 2) for n, x in ((q_len, qr), (c_len, cr)))
    best = np.full((len(q), k), np.iinfo(np.int64).min)
    best_ids = np.full((len(q), k), np.iinfo(np.int64).max)
    used = np.zeros((len(q), k), bool)
    bar, bar_id = floor.astype(float).copy(), floor_id.copy()
    slack = 1e-6 * (1 + q_len * c_len.max(initial=0))
    for at in range(0, len(c), SLICE_ROWS):
        s = slice(at, at + SLICE_ROWS)
        rows = np.flatnonzero(q_len * c_len[s].max() + slack >= bar)  # descending length: later slices only shrink
        if not len(rows):
            break
        bound = qr[rows] @ cr[s].T + q_rest[rows, None] * c_rest[None, s] + slack[rows, None]
        open_ = (bound >= bar[rows, None]) & (q_ids[rows, None] != c_ids[None, s])
        hit = open_.any(axis=1)
        rows, open_ = rows[hit], open_[hit]
        if not len(rows):
            continue
        if open_.mean() > DENSE_SHARE:
            scores = products(q[rows], c[s])
        else:
            i, j = np.nonzero(open_)
            scores = np.zeros(open_.shape, np.int64)
            scores[i, j] = np.einsum("ij,ij->i", q[rows][i], c[s][j])
        level = bar[rows, None]
        open_ &= (scores > level) | ((scores == level) & (c_ids[None, s] < bar_id[rows, None]))
        hit = open_.any(axis=1)
        rows, open_, scores = rows[hit], open_[hit], scores[hit]
        if not len(rows):
            continue
        # closed cells sort last; ids break ties
        every = np.concatenate([best[rows], scores], axis=1)
        ids = np.concatenate([best_ids[rows], np.broadcast_to(c_ids[s], scores.shape)], axis=1)
        live = np.concatenate([used[rows], open_], axis=1)
        order = np.lexsort((ids, -every, ~live), axis=-1)[:, :k]
        best[rows], best_ids[rows], used[rows] = (np.take_along_axis(x, order, 1) for x in (every, ids, live))
        full = rows[used[rows].all(axis=1)]
        bar[full], bar_id[full] = best[full, -1], best_ids[full, -1]
    return best, best_ids, used


def _pair(row: dict, basis: np.ndarray, k: int, floor: np.ndarray, floor_id: np.ndarray):
    q_ids, q = unpack(row["q_n"], row["q_dims"], row["q_ids"], row["q_data"])
    c_ids, c = unpack(row["n"], row["dims"], row["ids"], row["data"])
    return q_ids, q, search(q_ids, q, c_ids, c, basis, k, floor, floor_id)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20, vec_id: str = "vec_id",
          vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score) of the k best inner products of each query."""
    def clean(df: DataFrame) -> DataFrame:
        x = df.select(F.col(f"`{vec_id}`").cast("bigint").alias("id"), whole_numbers(F.col(f"`{vector}`")).alias("x"))
        return x.where(F.col("id").isNotNull() & F.col("x").isNotNull())

    candidates = blocks(clean(vectors), BLOCK_ROWS)
    asked = blocks(clean(queries).groupBy("id").agg(F.min("x").alias("x")), QUERY_ROWS).select(
        F.col("block").alias("q_block"), F.col("n").alias("q_n"), F.col("dims").alias("q_dims"),
        F.col("ids").alias("q_ids"), F.col("data").alias("q_data"))
    basis = rotation(candidates)
    first = candidates.agg(F.min("block")).first()[0]
    result = "query_id bigint, vec_id bigint, score bigint"
    if first is None:
        return vectors.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")

    def seed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                q_ids, q, (best, ids, used) = _pair(row, basis, k, np.full(row["q_n"], -np.inf), np.full(row["q_n"], LAST_ID))
                full = used.all(axis=1)
                bar = np.where(full, best[:, -1].astype(float), -np.inf)
                length = np.sqrt((q.astype(float) ** 2).sum(axis=1))
                # the shortest candidate length that could still beat a query's threshold
                need = np.where(length > 0, bar / np.where(length > 0, length, 1), np.where(bar > 0, np.inf, -np.inf))
                yield pa.RecordBatch.from_pylist([{
                    "q_block": row["q_block"], "q_n": row["q_n"], "q_dims": row["q_dims"], "q_ids": row["q_ids"],
                    "q_data": row["q_data"], "need": float(need.min(initial=np.inf)) * (1 - 1e-9) - 1e-6, "bar": bar.tobytes(), "bar_id": np.where(full, ids[:, -1], LAST_ID).tobytes(),
                    "best": best.tobytes(), "best_ids": ids.tobytes(), "used": used.tobytes()}], schema=seeds)

    seeds = pa.schema([("q_block", pa.int64()), ("q_n", pa.int32()), ("q_dims", pa.int32()), ("q_ids", pa.binary()),
                       ("q_data", pa.binary()), ("need", pa.float64()), ("bar", pa.binary()), ("bar_id", pa.binary()), ("best", pa.binary()),
                       ("best_ids", pa.binary()), ("used", pa.binary())])
    ddl = ("q_block bigint, q_n int, q_dims int, q_ids binary, q_data binary, need double, bar binary, bar_id binary, "
           "best binary, best_ids binary, used binary")
    # one block of BLOCK_ROWS vectors, the same for every query block
    longest = F.broadcast(candidates.where(F.col("block") == first))
    seeded = stored(spread(asked.withColumn("block", F.lit(first))).join(longest, "block").mapInArrow(seed, ddl))

    def unroll(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shape = (row["q_n"], k)
                yield found(np.frombuffer(row["q_ids"], np.int64), *(
                    np.frombuffer(row[x], t).reshape(shape) for x, t in (("best", np.int64), ("best_ids", np.int64), ("used", bool))))

    def rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                q_ids, _, best = _pair(row, basis, k, np.frombuffer(row["bar"], np.float64), np.frombuffer(row["bar_id"], np.int64))
                yield found(q_ids, *best)

    # which pairs of blocks can hold a result: numbers only, joined by bucket, not crossed in one task
    buckets = 32
    heads = candidates.where(F.col("block") != first).select("block", "longest", F.pmod(F.xxhash64("block"), F.lit(buckets)).alias("bucket"))
    needs = seeded.select("q_block", "need", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(buckets - 1).cast("bigint"))).alias("bucket"))
    meet = needs.join(heads, "bucket").where(F.col("longest") >= F.col("need")).select("q_block", "block")
    pairs = meet.join(seeded.drop("need", "best", "best_ids", "used"), "q_block").join(candidates, "block")
    rows = seeded.select("q_ids", "q_n", "best", "best_ids", "used").mapInArrow(unroll, result).unionByName(
        pairs.mapInArrow(rest, result))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))
    ranked = rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def spread(df: DataFrame) -> DataFrame:
    """One query block a task at best: blocks are few and each is much work."""
    return df.repartition(F.col("q_block"))


def found(q_ids: np.ndarray, best: np.ndarray, ids: np.ndarray, used: np.ndarray) -> pa.RecordBatch:
    query = np.broadcast_to(q_ids[:, None], used.shape)
    return pa.RecordBatch.from_arrays([pa.array(x[used]) for x in (query, ids, best)], names=["query_id", "vec_id", "score"])


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
ranked AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM ranked)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM numbered WHERE rank <= 20
"""

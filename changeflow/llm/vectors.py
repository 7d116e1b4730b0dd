"""Queries against all rows in blocks: what both vector searches share.

Rows are dealt to shards and queries to blocks by hash, both of bounded size,
and every (shard, block) pair is one task's work: it builds the shard's index
and answers the block's queries from it. What a task returns are each query's
best k in the shard, so the last step sorts k rows for each query and shard.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHARD_ROWS = 16_384     # expected rows of a shard at most
BLOCK_QUERIES = 16_384  # expected queries of a block at most
MIN_SHARDS = 24         # so that small tables use all cores


def usable(vectors: DataFrame, vec_id: str, vector: str, nonzero: bool) -> DataFrame:
    """(vec_id, v) of the vectors that take part: no null, no non-finite component, not empty, an id."""
    v = F.col("v")
    fine = (F.col("vec_id").isNotNull() & v.isNotNull() & (F.size(v) > 0)
            & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    if nonzero:
        fine &= F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("v"))
    return rows.filter(F.coalesce(fine, F.lit(False)))


def matrix(column: pa.ChunkedArray, dtype: type = np.float64) -> np.ndarray:
    """A list column of equal lengths as rows of a matrix."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(dtype).reshape(len(flat), -1)


def best_in_blocks(rows: DataFrame, queries: DataFrame, answer: Callable[..., tuple[np.ndarray, ...]], score: str, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k best by what ``answer`` finds in every shard.

    ``answer(ids, vectors, query_ids, query_vectors)`` gives (query position,
    row position, score) arrays with at most k rows for a query, its own id
    left out. Vectors of another length than the query's don't meet it. A query
    id that repeats is answered once, for its smallest vector.
    """
    asked = queries.groupBy("vec_id").agg(F.min("v").alias("v"))
    shards = max(MIN_SHARDS, math.ceil(rows.count() / SHARD_ROWS))
    blocks = max(1, math.ceil(asked.count() / BLOCK_QUERIES))

    def numbers(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    left = rows.select("vec_id", "v", F.size("v").alias("d"), F.pmod(F.xxhash64("vec_id", "v"), F.lit(shards)).cast("int").alias("shard"),
                       numbers(blocks).alias("block"))
    right = asked.select("vec_id", "v", F.size("v").alias("d"), F.pmod(F.xxhash64(F.lit("q"), "vec_id"), F.lit(blocks)).cast("int").alias("block"),
                         numbers(shards).alias("shard"))

    def cell(a: pa.Table, b: pa.Table) -> pa.Table:
        got = []
        if a.num_rows and b.num_rows:
            ids, asks = a.column("vec_id").to_numpy(), b.column("vec_id").to_numpy()
            # In order of id, so that ties go to the smaller one.
            to_row, to_ask = np.argsort(ids, kind="stable"), np.argsort(asks, kind="stable")
            q, r, s = answer(ids[to_row], matrix(a.column("v"))[to_row], asks[to_ask], matrix(b.column("v"))[to_ask])
            got = [asks[to_ask][q], ids[to_row][r], s]
        else:
            got = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        kind = pa.int64() if score == "long" else pa.float64()
        return pa.table([pa.array(got[0], pa.int64()), pa.array(got[1], pa.int64()), pa.array(got[2]).cast(kind)],
                        ["query_id", "vec_id", "score"])

    by = ("shard", "block", "d")
    found = left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(cell, f"query_id long, vec_id long, score {score}")
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


def best_of(scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k largest, larger first and ties by position."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        some = np.flatnonzero(scores >= least)
    else:
        some = np.arange(len(scores))
    return some[np.argsort(-scores[some], kind="stable")][:k]

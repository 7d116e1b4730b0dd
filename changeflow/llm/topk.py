"""Exact top-k inner products by norm-sorted, pruned partial sums.

Within a shard vectors are processed by descending length. A rotation (the
singular vectors of the whole table, from its 64 x 64 Gram matrix) puts most of
an inner product into the first components. For a chunk of rows, the partial
sum over those components plus the product of both residual lengths bounds the
score (Cauchy-Schwarz); only rows whose bound reaches the query's k-th best
score so far are scored in full, and once the largest remaining length times
the query's falls below it, the query is done.

Components are integers, floor(scale * x), so scores are whole numbers; they
are exact in double precision while below 2 ** 53, and computed in Python
integers beyond.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeflow.llm.common import staged
from changeflow.llm.vectors import best_in_blocks, best_of, matrix, usable

HEAD = 0.25       # share of the rotated components in the partial sum
CHUNK = 512       # rows that are bounded at a time
SLACK = 1e-9      # relative, for the rotation's rounding; exact scores decide


def gram(rows: DataFrame) -> dict[int, np.ndarray]:
    """Gram matrix of the vectors for each length; each task returns one small matrix."""

    def partial(it):
        sums: dict[int, np.ndarray] = {}
        for t in it:
            lengths = t.column("v").value_lengths().to_numpy()
            for d in np.unique(lengths):
                x = matrix(t.column("v").filter(pa.array(lengths == d)))
                sums[int(d)] = sums.get(int(d), 0) + x.T @ x
        for d, g in sums.items():
            i, j = np.divmod(np.arange(g.size), d)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(g.size, d)), pa.array(i), pa.array(j), pa.array(g.ravel())], ["d", "i", "j", "g"])

    out: dict[int, np.ndarray] = {}
    for r in rows.select("v").mapInArrow(partial, "d long, i long, j long, g double").groupBy("d", "i", "j").agg(F.sum("g").alias("g")).collect():
        out.setdefault(r["d"], np.zeros((r["d"], r["d"])))[r["i"], r["j"]] = r["g"]
    return out


def rotation(g: np.ndarray) -> np.ndarray:
    """Right singular vectors, strongest first."""
    values, axes = np.linalg.eigh(g)
    return axes[:, np.argsort(-values)]


def _answer(turns: dict[int, np.ndarray], k: int):
    def answer(ids, rows, asks, asked):
        turn = turns[rows.shape[1]]
        head = max(1, round(HEAD * rows.shape[1]))
        length = np.sqrt((rows * rows).sum(axis=1))
        by = np.argsort(-length, kind="stable")
        y, z = rows[by] @ turn, asked @ turn
        long, far = length[by], np.sqrt((asked * asked).sum(axis=1))
        tail = np.sqrt(np.maximum((y[:, head:] ** 2).sum(axis=1), 0))
        far_tail = np.sqrt(np.maximum((z[:, head:] ** 2).sum(axis=1), 0))
        whole = float(long[0] if len(long) else 0) * float(far.max(initial=0)) >= 2 ** 53
        best: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(asks)
        least = np.full(len(asks), -np.inf)
        for at in range(0, len(by), CHUNK):
            some = by[at:at + CHUNK]
            open_ = np.flatnonzero(far * long[at] * (1 + SLACK) >= least)
            if not len(open_):
                break
            bound = z[open_, :head] @ y[at:at + CHUNK, :head].T
            bound += far_tail[open_, None] * tail[None, at:at + CHUNK]
            bound += SLACK * far[open_, None] * long[None, at:at + CHUNK] + SLACK
            hits = bound >= least[open_, None]
            for n, i in enumerate(open_):
                got = some[hits[n]]
                got = got[ids[got] != asks[i]]
                if not len(got):
                    continue
                if whole:
                    score = np.array([sum(int(a) * int(b) for a, b in zip(rows[r], asked[i], strict=True)) for r in got])
                else:
                    score = (rows[got] @ asked[i]).astype(np.int64)
                pos, val = np.concatenate((best[i][0], got)), np.concatenate((best[i][1], score))
                order = np.argsort(pos, kind="stable")  # positions are in order of id
                pos, val = pos[order], val[order]
                top = best_of(val, k)
                best[i] = (pos[top], val[top])
                if len(top) == k:
                    least[i] = val[top[-1]]
        q = np.repeat(np.arange(len(asks)), [len(p) for p, _ in best])
        return q, np.concatenate([p for p, _ in best]), np.concatenate([s for _, s in best]).astype(np.int64)

    return answer


def top_k(vectors: DataFrame, every: int = 100, k: int = 10, scale: int = 1024, vec_id: str = "vec_id",
          vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score long): each query's k highest integer inner products, exactly.

    Queries are the rows whose id is divisible by ``every``; ties go to the
    smaller id. Null and empty vectors, those with a null or non-finite
    component, and rows without an id take no part; zero vectors do. A row
    never meets its own id; other repeated rows are candidates of their own.
    With fewer than k candidates all are returned. An empty table gives an
    empty result.
    """
    rows = usable(vectors, vec_id, vector, nonzero=False)
    rows = staged(rows.select("vec_id", F.transform("v", lambda x: F.floor(x.cast("double") * scale).cast("double")).alias("v")), "whole")
    turns = {d: rotation(g) for d, g in gram(rows).items()}
    return best_in_blocks(rows, rows.filter(F.col("vec_id") % every == 0), _answer(turns, k), "long", k)

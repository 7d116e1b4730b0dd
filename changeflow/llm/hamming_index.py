"""Approximate nearest neighbours by multi-index hashing.

Vectors become binary codes: rotated by a learned rotation (iterative
quantisation on a bounded sample) and cut at zero, so that near vectors differ
in few bits. A code is split into substrings, and each substring is an index of
its own. If two codes differ in at most r bits, then at least one substring
differs in at most r / m of them (pigeonhole), so probing each index at that
small radius retrieves every code within r. The retrieved rows are reranked by
inner products of the float vectors.

The radius is learned on the sample too: the one that holds ``COVER`` of the
sample's true neighbours. The full table's neighbours are nearer than the
sample's, so its recall is higher. A query that finds fewer than k rows in the
radius searches on at larger ones, up to the whole shard.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeflow.llm.common import staged
from changeflow.llm.vectors import best_in_blocks, best_of, matrix, usable

SAMPLE_ROWS = 8_192     # rows that rotation and radius are fitted on, as expected by a hash
SAMPLE_QUERIES = 256
TURNS = 30              # rounds of iterative quantisation
SUBSTRING_BITS = 8
COVER = 0.95
BITS = 64
AT_ONCE = 256           # queries that meet a shard at a time


@dataclass
class Codes:
    """The learned code: largest length, rotation, and radius."""

    top: float
    rotation: np.ndarray
    radius: int

    def of(self, v: np.ndarray, query: bool) -> np.ndarray:
        """Bits (rows x bits) of vectors; rows are lifted to equal length, so inner product ranks as angle."""
        return _lift(v, self.top, query) @ self.rotation > 0


def _lift(v: np.ndarray, top: float, query: bool) -> np.ndarray:
    """One more component that brings every row to the length ``top``; queries get zero and length ``top``."""
    n = (v * v).sum(axis=1, keepdims=True)
    if query:
        return np.hstack([v * (top / np.maximum(np.sqrt(n), 1e-300)), np.zeros_like(n)])
    return np.hstack([v, np.sqrt(np.maximum(top * top - n, 0.0))])


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hamming distances of bit rows, as a float product."""
    x, y = a.astype(np.float32), b.astype(np.float32)
    return (x.sum(1)[:, None] + y.sum(1)[None, :] - 2 * (x @ y.T)).astype(np.int32)


def learn(sample: np.ndarray, top: float, k: int, bits: int = BITS, seed: int = 0) -> Codes:
    """Rotation and radius from a sample of vectors."""
    if not len(sample):
        return Codes(1.0, np.zeros((1, 1)), 0)
    rng = np.random.default_rng(seed)
    x = _lift(sample, top, False)
    values, axes = np.linalg.eigh(x.T @ x)
    axes = axes[:, np.argsort(-values)][:, :bits]
    if axes.shape[1] < bits:  # fewer components than bits: more random directions
        more = rng.standard_normal((x.shape[1], bits - axes.shape[1]))
        axes = np.hstack([axes, more / np.linalg.norm(more, axis=0)])
    y = x @ axes
    turn = np.linalg.qr(rng.standard_normal((bits, bits)))[0]
    for _ in range(TURNS):
        u, _, w = np.linalg.svd(np.where(y @ turn > 0, 1.0, -1.0).T @ y)
        turn = (u @ w).T
    codes = Codes(top, axes @ turn, bits)
    asked = sample[:SAMPLE_QUERIES]
    apart = _distances(codes.of(asked, True), codes.of(sample, False))
    score = asked @ sample.T
    np.fill_diagonal(score, -np.inf)
    # The sample's nearest stand for the table's, which are nearer still.
    near = np.argsort(-score, axis=1)[:, :min(k, len(sample) - 1)]
    if near.shape[1]:
        codes.radius = int(np.quantile(np.take_along_axis(apart, near, 1), COVER, method="higher"))
    return codes


class Index:
    """One shard: for each substring, the rows in order of its value and where each value begins."""

    def __init__(self, bits: np.ndarray) -> None:
        self.bits = bits.astype(np.float32)
        self.packed = np.packbits(bits, axis=1, bitorder="little")
        self.order = np.argsort(self.packed, axis=0, kind="stable")
        self.begins = np.stack([np.searchsorted(self.packed[self.order[:, j], j], np.arange(257))
                                for j in range(self.packed.shape[1])])
        self.apart = np.bitwise_count(np.arange(256, dtype=np.uint8)[:, None] ^ np.arange(256, dtype=np.uint8)[None, :])

    def within(self, query: np.ndarray, radius: int) -> np.ndarray:
        """Positions of all rows whose code differs in at most ``radius`` bits, in order."""
        m = self.packed.shape[1]
        each, more = divmod(radius, m)
        seen = np.zeros(len(self.packed), bool)
        for j in range(m):
            reach = each if j <= more else each - 1
            for value in np.flatnonzero(self.apart[query[j]] <= reach) if reach >= 0 else ():
                seen[self.order[self.begins[j, value]:self.begins[j, value + 1], j]] = True
        found = np.flatnonzero(seen)
        return found[np.bitwise_count(self.packed[found] ^ query).sum(axis=1) <= radius]


def _scored(rows: np.ndarray, found: np.ndarray, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The rows that can be among the k best, and their inner products: sums in one order, so that equal vectors score alike.

    A matrix product rounds by position; it only tells which rows are far from the k best.
    """
    some = rows[found]
    if len(found) > k:
        rough = some @ query
        slack = 1e-9 * np.linalg.norm(query) * float(np.sqrt((some * some).sum(1).max()))
        keep = rough >= np.partition(rough, len(rough) - k)[len(rough) - k] - slack
        found, some = found[keep], some[keep]
    return found, (some * query).sum(axis=1)


def _answer(codes: Codes, k: int):
    def answer(ids, rows, asks, asked):
        index = Index(codes.of(rows, False))
        probes = np.packbits(codes.of(asked, True), axis=1, bitorder="little")
        out = []
        for i in range(len(asks)):
            radius = codes.radius
            while True:
                found = index.within(probes[i], radius)
                found = found[ids[found] != asks[i]]
                if len(found) >= k or radius >= codes.rotation.shape[1]:
                    break
                radius += SUBSTRING_BITS
            found, score = _scored(rows, found, asked[i], k)
            best = best_of(score, k)
            out.append((np.full(len(best), i), found[best], score[best]))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))

    return answer


def nearest(vectors: DataFrame, every: int = 20, k: int = 20, vec_id: str = "vec_id", vector: str = "embedding",
            sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of largest inner product found for each query.

    Queries are the rows whose id is divisible by ``every``. Scores are exact
    double inner products of the original vectors; equal scores rank by id.
    Null, empty and zero vectors, and those with a null or non-finite
    component, take no part, nor do rows without an id. A row never meets its
    own id; other repeated rows are candidates of their own. With fewer than k
    candidates all are returned. An empty table gives an empty result.
    """
    rows = staged(usable(vectors, vec_id, vector, nonzero=True), "vectors")
    size = rows.agg(F.count("*").alias("n"), F.max(F.aggregate(F.transform("v", lambda x: x.cast("double") * x), F.lit(0.0), lambda s, x: s + x)).alias("top")).first()
    part = F.pmod(F.xxhash64(F.lit("sample"), "vec_id", "v"), F.lit(1_000_000)) / 1_000_000
    sample = rows.filter(part < sample_rows / max(size["n"], 1)).orderBy("vec_id").toArrow()
    widths = sample.column("v").combine_chunks().value_lengths().to_pylist() if sample.num_rows else []
    top = float(np.sqrt(size["top"] or 0.0))
    learned = {d: learn(matrix(sample.column("v").filter(np.array([w == d for w in widths]))), top, k) for d in sorted(set(widths))}

    def answer(ids, mine, asks, asked):
        d = mine.shape[1]
        return _answer(learned[d] if d in learned else learn(mine[:SAMPLE_ROWS], top, k), k)(ids, mine, asks, asked)

    return best_in_blocks(rows, rows.filter(F.col("vec_id") % every == 0), answer, "double", k)

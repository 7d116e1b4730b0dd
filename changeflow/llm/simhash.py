"""SimHash near-dedup: tiled exact comparison of 64-bit fingerprints.

A document's fingerprint has a bit set where more than half of its shingles'
64-bit hashes have it set. Fingerprints that differ in at most ``radius`` bits
are linked, and documents whose fingerprints are connected form a group.

Every distinct fingerprint is compared exactly. Fingerprints are put in tiles
by their population counts, taken over ``SEGMENTS`` equal parts of the word:
two fingerprints differ in at least the sum of the differences of their part
counts, so a pair of tiles whose counts differ by more than the radius in sum
is skipped without loss. A tile larger than ``TILE`` is split by hash. The
remaining tile pairs are compared with numpy's exclusive-or and bit counts,
and each pair of tiles hands on a spanning forest of the links it found, so
that a dense neighbourhood never turns into all its pairs.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeflow.llm.common import fresh, staged
from changeflow.llm.graph import connected_components, join_unique

BITS = 64
SEGMENTS = 4          # parts with a population count of their own; counts of 0..16 each
TILE = 4096           # expected fingerprints in a tile at most
HASHES_AT_ONCE = 1 << 15


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """Unsigned fingerprint of a text; no words give zero, fewer than ``shingle`` words one shingle."""
    # bytes.lower and bytes.split know A-Z and the six ASCII blanks only.
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    joined, h = b" ".join(words), xxhash.xxh64_intdigest
    ends = np.cumsum(np.fromiter((len(w) + 1 for w in words), np.int64, len(words))) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - shingle + 1)
    last = ends[min(shingle, len(words)) - 1:]
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, HASHES_AT_ONCE):
        to = min(n, at + HASHES_AT_ONCE)
        some = [h(joined[s:e], seed) for s, e in zip(starts[at:to].tolist(), last[at:to].tolist(), strict=True)]
        bits = np.unpackbits(np.array(some, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def fingerprint_column(text: str, shingle: int = 3):
    """The fingerprint of a text column as a signed long."""

    def prints(it: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in it:
            got = np.array([fingerprint(x, shingle) for x in texts], np.uint64)
            yield pd.Series(got.view(np.int64))

    return F.pandas_udf(prints, T.LongType())(F.col(text))


def _offsets(radius: int) -> list[int]:
    """Differences of packed part counts that a pair within the radius can have, one of each sign."""
    steps = [d for d in itertools.product(range(-radius, radius + 1), repeat=SEGMENTS) if sum(map(abs, d)) <= radius]
    return sorted({k for d in steps if (k := sum(x << (8 * i) for i, x in enumerate(d))) >= 0})


def _forest(i: np.ndarray, j: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what (i, j) connect: chains through each component's nodes in order, so no node has more than two."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    chain = np.argsort(root, kind="stable")
    same = root[chain[1:]] == root[chain[:-1]]
    return chain[:-1][same], chain[1:][same]


def _compare(radius: int):
    def links(a: np.ndarray, b: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
        found = []
        for at in range(0, len(a), 512):
            # Unsigned: bitwise_count takes the absolute value of signed numbers.
            near = np.bitwise_count((a[at:at + 512, None] ^ b[None, :]).view(np.uint64)) <= radius
            i, j = np.nonzero(near)
            i += at
            if same:
                keep = i < j
                i, j = i[keep], j[keep]
            found.append((i, j))
        i, j = (np.concatenate(x) for x in zip(*found, strict=True))
        if same:
            i, j = _forest(i, j, len(a))
            return a[i], a[j]
        every = np.concatenate((a, b))
        i, j = _forest(i, j + len(a), len(every))
        return every[i], every[j]

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in it:
            for a, b, same in zip(t.column("left"), t.column("right"), t.column("same").to_pylist(), strict=True):
                u, v = links(a.values.to_numpy(), b.values.to_numpy(), same)
                if len(u):
                    yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["a", "b"])

    return run


def near_links(prints: DataFrame, radius: int = 2) -> DataFrame:
    """(a, b): links that connect every two of the distinct fingerprints ``fp`` within the radius."""
    width = BITS // SEGMENTS
    mask = (1 << width) - 1
    # A byte for each part's count, raised by the radius so that a difference never borrows.
    key = sum(((F.bit_count(F.shiftrightunsigned("fp", i * width).bitwiseAND(F.lit(mask))) + radius) * F.lit(1 << 8 * i)
               for i in range(SEGMENTS)), F.lit(0)).cast("long")
    keyed = prints.select("fp", key.alias("k"))
    # At most 17 ** 4 rows whatever the input: small enough to broadcast.
    sizes = keyed.groupBy("k").agg(F.ceil(F.count("*") / TILE).cast("int").alias("blocks"))
    tiles = staged(keyed.join(F.broadcast(sizes), "k")
                   .groupBy("k", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int").alias("block"))
                   .agg(F.sort_array(F.collect_list("fp")).alias("fps")), "tiles")
    known = F.broadcast(tiles.select(F.col("k").alias("k2")).distinct())
    left = (tiles.select("k", "block", F.col("fps").alias("left"),
                         F.explode(F.array(*[F.col("k") + F.lit(o) for o in _offsets(radius)])).alias("k2"))
            .join(known, "k2"))
    right = tiles.select(F.col("k").alias("k2"), F.col("block").alias("block2"), F.col("fps").alias("right"))
    pairs = (left.join(right, "k2").filter("k <> k2 or block <= block2")
             .select("left", "right", F.expr("k = k2 and block = block2").alias("same")))
    return pairs.mapInArrow(_compare(radius), "a long, b long")


def simhash_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3,
                   radius: int = 2) -> DataFrame:
    """One row for each row of ``docs``: doc_id, fp (long), text_hash, fingerprint (16 hex digits), component_id.

    component_id is the smallest doc_id reachable over links, the row's own
    included. Null and empty texts have fingerprint zero and are linked like
    any other. A null doc_id is never a component_id unless the whole group has
    none. Repeated rows give repeated rows. An empty table gives an empty one.
    Columns beside the two named are not read.
    """
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    rows = staged(own.select("doc_id", fingerprint_column("text", shingle).alias("fp"),
                             F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash")), "prints")
    # A node is a fingerprint with its least doc_id in front (null last), so a
    # group's root names its component and nothing is grouped by root again.
    distinct = staged(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    node = distinct.select("fp", F.struct(F.col("least").isNull().alias("none"), "least", "fp").alias("node"))
    links = near_links(distinct.select("fp"), radius)
    for end in ("a", "b"):
        links = links.join(node.select(F.col("fp").alias(end), F.col("node").alias(f"node_{end}")), end)
    roots = connected_components(links, "node_a", "node_b").select("node.fp", "root")
    named = staged(distinct.join(roots, "fp", "left")
                   .select("fp", F.coalesce("root.fp", "fp").alias("root"), F.when(F.col("root").isNull(), F.col("least")).otherwise(F.col("root.least")).alias("component_id")),
                   "groups")
    return join_unique(rows, named, "fp").select(
        "doc_id", "fp", "text_hash", "root", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, radius: int = 2) -> DataFrame:
    """``docs`` with one row of each group: the smallest doc_id (then text hash); columns unchanged.

    A null doc_id is kept only where its group has no other. Of repeated rows
    (same doc_id and text) one stays, the first by a hash of all columns.
    """
    first = simhash_groups(docs, doc_id, text, shingle, radius).groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("kept"))
    # Documents meet the kept ones and their own repeats on the same two
    # columns, so texts are shuffled once.
    key, hashed, nth, whole = fresh(docs, "key", "hashed", "nth", "whole")
    name = lambda c: F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit(""))
    first = first.select(name(F.col("kept.doc_id")).alias(key), F.col("kept.text_hash").alias(hashed))
    others = [c for c in docs.columns if c != text and not isinstance(docs.schema[c].dataType, T.MapType)]
    keyed = docs.withColumns({key: name(F.col(doc_id)), hashed: F.xxhash64(F.coalesce(F.col(text), F.lit(""))), whole: F.xxhash64(*others)})
    w = Window.partitionBy(key, hashed).orderBy(whole)
    return keyed.join(first, [key, hashed], "left_semi").withColumn(nth, F.row_number().over(w)).filter(F.col(nth) == 1).select(*docs.columns)

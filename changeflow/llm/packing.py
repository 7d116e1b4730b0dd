"""Best-fit packing of token sequences by exact complements.

Documents become token ids and are cut into pieces of at most ``capacity``
tokens. What decides a packing is only how many pieces there are of each
length, at most ``capacity`` numbers whatever the corpus, so the plan is made
from that histogram: from the longest length down, a sequence begun with a
piece looks up its gap in an index of single, pair and triple sums of the
lengths that are still available, and takes a combination that fills the gap
exactly, as many times as all its lengths last. Where none exists, the longest
piece that fits goes in (best fit) and the smaller gap is looked up again.

The plan is a list of patterns with repeat counts. Spark then numbers the
pieces of each length (per hash bucket, with the buckets' sums ahead of them,
so a length that a third of all pieces have is no task's work alone) and looks
up each number's place in the plan.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from changeflow.llm.common import staged

CAPACITY = 1024
END_ID = 2
LONG_BLANK = re.compile(r"(?<!\s)\s{100000}")  # tiktoken's pattern search runs out of stack at a million blanks in a row
BUCKETS = 256            # hash buckets in which the pieces of one length are numbered
TOKENIZER = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"  # the same vocabulary


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Token ids of texts, as little-endian unsigned 32-bit bytes.

    The ids are those of ``Tokenizer.encode(text, add_special_tokens=False)``
    for the file at ``path``. With ``ranks``, a file of the same vocabulary and
    merges by rank, texts of Western letters (those that code page 1252 has)
    go through the faster tiktoken, which gives the same ids there; all other
    texts, and those that hold a special token's string or a very long run of
    white space, through tokenizers.
    """

    def __init__(self, path: str, ranks: str | None = None) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = re.compile("|".join(map(re.escape, (t.content for t in self.tokenizer.get_added_tokens_decoder().values()))) or r"(?!)")
        self.fast = None
        if ranks:
            import public_tokenizers
            import tiktoken

            with open(ranks, "rb") as lines:
                merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.fast = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges, special_tokens={})

    def __call__(self, text: str) -> bytes:
        if self.fast is not None and not self.special.search(text) and not LONG_BLANK.search(text):
            try:
                text.encode("cp1252")
            except UnicodeEncodeError:
                pass
            else:
                return np.array(self.fast.encode_ordinary(text), "<u4").tobytes()
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


@lru_cache(maxsize=1)
def _encoder(path: str, ranks: str | None) -> Encoder:
    """One for each Python worker."""
    return Encoder(path, ranks)


def piece_starts(n: int, capacity: int) -> range | list[int]:
    """Where the pieces of n ids begin: whole pieces at the end, the shorter one first."""
    return [0, *range(n % capacity or capacity, n, capacity)]


def pieces(docs: DataFrame, path: str, ranks: str | None = None, capacity: int = CAPACITY, doc_id: str = "doc_id", text: str = "text", end_id: int = END_ID) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): the pieces of every row's ids, the end id included."""
    kind = docs.schema[doc_id].dataType

    def cut(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = _encoder(path, ranks), np.array([end_id], "<u4").tobytes()
        for t in it:
            cols: list[list] = [[], [], [], [], []]
            for i, text_ in enumerate(t.column("text")):
                ids = encoder(text_.as_py() or "") + end
                starts = piece_starts(len(ids) // 4, capacity)
                for n, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids) // 4], strict=True)):
                    for c, v in zip(cols, (i, n, a, b - a, zlib.crc32(ids[4 * a:4 * b])), strict=True):
                        c.append(v)
            ids_col = t.column("doc_id").take(pa.array(cols[0], pa.int64()))
            yield pa.RecordBatch.from_arrays([ids_col, pa.array(cols[1], pa.int32()), *[pa.array(c, pa.int64()) for c in cols[2:]]],
                                             ["doc_id", "piece", "start", "length", "ids_crc32"])

    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return own.mapInArrow(cut, f"doc_id {kind.simpleString()}, piece int, start long, length long, ids_crc32 long")


class SumIndex:
    """Single, pair and triple sums of the lengths that are available, with one combination for each."""

    def __init__(self, counts: np.ndarray) -> None:
        self.counts, self.stale = counts, True

    def _pairs(self) -> None:
        """For each sum the pair with the longest member, as that member; 0 where there is none."""
        top, there = len(self.counts), self.counts > 0
        self.longest = np.zeros(top, np.int64)
        lengths = np.flatnonzero(there)
        for a in lengths:  # ascending: longer members overwrite shorter ones
            b = lengths[(lengths <= a) & (lengths + a < top)]
            if self.counts[a] < 2:
                b = b[b != a]
            self.longest[a + b] = a
        self.stale = False

    def exact(self, gap: int) -> tuple[int, ...] | None:
        """Lengths that fill the gap exactly and are all available: one if possible, else two, else three."""
        c = self.counts
        if c[gap] > 0:
            return (gap,)
        if self.stale:
            self._pairs()
        if a := int(self.longest[gap]):
            return (a, gap - a)
        for x in np.flatnonzero(c[:gap] > 0)[::-1].tolist():
            a = int(self.longest[gap - x])
            if a:
                got = (x, a, gap - x - a)
                if all(c[k] >= n for k, n in Counter(got).items()):
                    return got
        return None


def plan_patterns(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a sequence, how many such sequences) that use every piece once.

    Each step uses a length up, or all but less than one pattern needs of it,
    so there are a few patterns for each length at most.
    """
    counts = np.zeros(capacity + 1, np.int64)
    for k, n in histogram.items():
        counts[k] = n
    plan: list[tuple[tuple[int, ...], int]] = []
    index = SumIndex(counts)
    for length in range(capacity, 0, -1):
        while counts[length] > 0:
            pattern, gap = [length], capacity - length
            counts[length] -= 1
            taken: list[int] = []
            while gap:
                index.stale = index.stale or counts[pattern[-1]] <= 1
                fill = index.exact(gap)
                if fill is None:
                    fits = np.flatnonzero(counts[:gap + 1] > 0)
                    if not len(fits):
                        break
                    fill = (int(fits[-1]),)
                for x in fill:
                    counts[x] -= 1
                    taken.append(x)
                    pattern.append(x)
                    gap -= x
                index.stale = True
            # As often as it goes; the first time is taken already.
            need = Counter(pattern)
            more = int(min(counts[k] // n for k, n in need.items()))
            for k, n in need.items():
                counts[k] -= more * n
            index.stale = True
            plan.append((tuple(sorted(pattern, reverse=True)), 1 + more))
    return plan


def slots(plan: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, list[tuple[int, int, int, int, int]]]]:
    """For each length the ranges of its pieces' numbers: (low, high, first sequence, pieces of it in one sequence, offset)."""
    out: dict[int, list[tuple[int, int, int, int, int]]] = {}
    used: Counter[int] = Counter()
    first = 0
    for pattern, n in plan:
        at = 0
        for length, m in sorted(Counter(pattern).items(), reverse=True):
            out.setdefault(length, []).append((used[length], used[length] + m * n, first, m, at))
            used[length] += m * n
            at += m * length
        first += n
    return sorted(out.items())


def pack(docs: DataFrame, path: str | None = None, ranks: str | None = None, capacity: int = CAPACITY, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset): every row's pieces and their places.

    Null and empty texts are the end id alone, and packed like any other. A
    null doc_id is a value like any other. Repeated rows are packed as often as
    they occur. Pieces of equal length may swap places without changing the
    packing; they are numbered by (bucket, doc_id, piece, start, ids_crc32). An
    empty table gives an empty result. Other columns are not read.
    """
    if path is None:
        path, ranks = tokenizer_path(), tokenizer_path(RANKS)
    cut = staged(pieces(docs, path, ranks, capacity, doc_id, text), "pieces")
    bucketed = cut.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(BUCKETS)).cast("int"))
    # At most capacity x BUCKETS rows.
    sizes = staged(bucketed.groupBy("length", "bucket").agg(F.count("*").alias("n")), "sizes")
    histogram = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = slots(plan_patterns(histogram, capacity))
    spark = docs.sparkSession
    kind = "length long, ranges array<struct<low:long,high:long,first:long,each:int,at:int>>"
    ranges = spark.createDataFrame(places, kind)
    ahead = F.sum("n").over(Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    begins = sizes.select("length", "bucket", F.coalesce(ahead, F.lit(0)).alias("ahead"))
    nth = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "start", "ids_crc32")) - 1
    numbered = (bucketed.withColumn("nth", nth).join(F.broadcast(begins), ["length", "bucket"]).withColumn("number", F.col("nth") + F.col("ahead"))
                .join(F.broadcast(ranges), "length"))
    here = F.filter("ranges", lambda r: (r["low"] <= F.col("number")) & (F.col("number") < r["high"]))[0]
    done = numbered.withColumn("r", here).withColumn("k", F.col("number") - F.col("r.low"))
    return done.select("doc_id", "piece", "start", "length", "ids_crc32",
                       (F.col("r.first") + F.expr("k div r.each")).alias("sequence_id"),
                       (F.col("r.at") + F.col("k") % F.col("r.each") * F.col("length")).cast("long").alias("offset"))

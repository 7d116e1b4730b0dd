"""Vector codes by product quantisation, with norm-of-sum bounds.

Vectors are cut into equal parts, and each part position has a codebook that
starts from the first vectors and moves to the means of its parts for a number
of rounds. All arithmetic is on whole numbers, so assignments are exact.

A part need not look at every entry in every round. When it does, it keeps the
distance to its own entry, the distance to the nearest other one, and the round
in which each was taken (its stamp). All rounds' codebooks are retained, so a
bound taken in round s is carried to round t by the distance between an entry's
places in s and in t: the norm of the sum of its moves, which is never more than
the sum of their norms that bounds updated round by round pile up. If the own
entry's upper bound is below the others' lower bound, the code stands; if not,
the own distance is taken anew; only then are all entries looked at.

Codebooks, at most ``entries`` vectors for a vector length, are the only thing
that travels through the driver. Rows with their bounds are a table written
once a round; the round before last is deleted.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from changeflow.llm.common import fresh, prepared, staged
from changeflow.session import scratch_dir
from changeflow.sources import fs

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
SALTS = 32
Books = dict[int, list[list[np.ndarray]]]  # vector length -> round -> part -> entries x components

# What a row keeps for each part. Bounds are rounded outwards to 32 bits.
BOUND = np.dtype([("code", "u1"), ("up", "<f4"), ("up_at", "u1"), ("low", "<f4"), ("low_at", "u1")])


def whole(x: float, scale: int) -> int:
    """floor(scale * x), exactly."""
    return math.floor(Fraction(x) * scale)


def whole_matrix(v: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * v): floats that hold whole numbers, or Python ints where floats would not be exact."""
    if not v.size or np.abs(v).max() * scale < 2 ** 52:
        return np.floor(v * scale)
    out = np.empty(v.shape, object)
    out[...] = [[whole(x, scale) for x in row] for row in v.tolist()]
    return out


def part_slices(d: int, parts: int) -> list[slice]:
    """Consecutive parts of a vector of ``d`` components; where d is no multiple, the first parts are one longer."""
    ends = np.cumsum([0, *(d // parts + (p < d % parts) for p in range(parts))])
    return [slice(a, b) for a, b in zip(ends, ends[1:])]


def _exact(*arrays: np.ndarray) -> list[np.ndarray]:
    """The arrays as they are if sums of squared differences stay exact in floats, else as Python ints."""
    if all(a.dtype != object for a in arrays):
        most = max((float(np.abs(a).max()) for a in arrays if a.size), default=0.0)
        if 4 * max(a.shape[-1] for a in arrays) * most * most < 2 ** 53:
            return list(arrays)
    out = []
    for a in arrays:
        b = np.empty(a.shape, object)
        b[...] = a if a.dtype == object else [[int(x) for x in row] for row in a.tolist()]
        out.append(b)
    return out


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of x to all entries of c, exactly."""
    x, c = _exact(x, c)
    return (x * x).sum(1)[:, None] - 2 * (x @ c.T) + (c * c).sum(1)[None, :]


def own_squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of rows of x to the rows of c beside them, exactly."""
    x, c = _exact(x, c)
    return ((x - c) ** 2).sum(1)


def root(sq: np.ndarray) -> np.ndarray:
    """Square roots as floats; infinite for numbers far beyond them, which no bound can use."""
    if sq.dtype == object:
        sq = np.array([float(s) if s < 2 ** 1000 else math.inf for s in sq.flat]).reshape(sq.shape)
    return np.sqrt(sq)


def _up(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.nextafter((x * (1 + 1e-9)).astype("f4"), np.float32(np.inf))


def _low(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.nextafter((x * (1 - 1e-9)).astype("f4"), np.float32(-np.inf))


class Carried:
    """How far entries are from where they were in each retained round, and the farthest of all others than one."""

    def __init__(self, history: list[list[np.ndarray]]) -> None:
        self.books, self.now, self.own, self.others = history[-1], len(history) - 1, [], []
        for p, book in enumerate(self.books):
            net = np.array([root(own_squared(book, then[p])) * (1 + 1e-9) for then in history])
            self.own.append(net)
            self.others.append(np.array([[np.delete(m, a).max(initial=0.0) for a in range(len(book))] for m in net]))


class Rescans:
    """Parts seen and parts that had to look at all entries."""

    def __init__(self) -> None:
        self.seen = self.own = self.full = 0


def assign(x: np.ndarray, carried: Carried, bounds: np.ndarray | None, tally: Rescans | None = None) -> np.ndarray:
    """Codes and bounds of the rows of ``x`` under the newest codebooks; ``bounds`` is what the rows had before."""
    now, parts = carried.now, part_slices(x.shape[1], len(carried.books))
    out = np.zeros((len(x), len(parts)), BOUND) if bounds is None else bounds.copy()
    for p, where in enumerate(parts):
        xp, book, b = x[:, where], carried.books[p], out[:, p]
        if bounds is None:
            scan = np.arange(len(x))
            own = scan[:0]
        else:
            low = b["low"].astype(float) - carried.others[p][b["low_at"], b["code"]]
            own = np.flatnonzero(b["up"].astype(float) + carried.own[p][b["up_at"], b["code"]] >= low)
            at = root(own_squared(xp[own], book[b["code"][own]]))
            b["up"][own], b["up_at"][own] = _up(at), now
            scan = own[at * (1 + 1e-9) >= low[own]]
        if len(scan):
            far = squared(xp[scan], book)
            code = far.argmin(1)
            mine = (np.arange(len(scan)), code)
            far = root(far)
            b["code"][scan] = code
            b["up"][scan], b["up_at"][scan] = _up(far[mine]), now
            far[mine] = np.inf
            b["low"][scan], b["low_at"][scan] = _low(far.min(1)), now
        if tally:
            tally.seen, tally.own, tally.full = tally.seen + len(x), tally.own + len(own), tally.full + len(scan)
    return out


def _by_length(t: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, rows, their vectors) of a batch."""
    col = t.column("v")
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(float)
    ends = np.cumsum([0, *col.value_lengths().to_pylist()])
    sizes = np.diff(ends)
    for d in np.unique(sizes):
        rows = np.flatnonzero(sizes == d)
        yield int(d), rows, flat[ends[rows][:, None] + np.arange(d)[None, :]]


def _assigned(rows: DataFrame, books: Books, scale: int) -> DataFrame:
    """``rows`` (vec_id, label, v, bounds) with bounds under the newest codebooks."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried = {d: Carried(history) for d, history in books.items()}
        for t in it:
            kept, out = t.column("bounds").to_pylist(), [b""] * t.num_rows
            for d, at, v in _by_length(t):
                old = None
                if kept[at[0]] is not None:
                    old = np.frombuffer(b"".join(kept[i] for i in at), BOUND).reshape(len(at), -1)
                for i, row in zip(at, assign(whole_matrix(v, scale), carried[d], old), strict=True):
                    out[i] = row.tobytes()
            yield pa.RecordBatch.from_arrays([*(t.column(c) for c in ("vec_id", "label", "v")), pa.array(out, pa.binary())], ["vec_id", "label", "v", "bounds"])

    return rows.mapInArrow(run, rows.schema)


def _part_sums(rows: DataFrame, books: Books, scale: int) -> DataFrame:
    """(d, part, entry, sums): counts and sums of the parts of each entry, whole numbers of any size as text, one row for each task."""
    shape = {d: (len(history[-1]), len(history[-1][0])) for d, history in books.items()}

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int, int], list[int]] = {}
        for t in it:
            kept = t.column("bounds").to_pylist()
            for d, at, v in _by_length(t):
                parts, entries = shape[d]
                codes = np.frombuffer(b"".join(kept[i] for i in at), BOUND).reshape(len(at), parts)["code"]
                x = whole_matrix(v, scale)
                if x.dtype != object and x.size and np.abs(x).max() * len(x) >= 2 ** 53:
                    x = x.astype(object)
                for p, where in enumerate(part_slices(d, parts)):
                    for e in range(entries):
                        mine = x[codes[:, p] == e, where]
                        if len(mine):
                            add = [len(mine), *(int(s) for s in mine.sum(0))]
                            old = sums.get((d, p, e), [0] * len(add))
                            sums[d, p, e] = [a + b for a, b in zip(old, add, strict=True)]
        keys = list(sums)
        yield pa.RecordBatch.from_arrays([*[pa.array([k[i] for k in keys], pa.int32()) for i in range(3)],
                                          pa.array([",".join(map(str, sums[k])) for k in keys], pa.string())], ["d", "part", "entry", "sums"])

    def total(t: pa.Table) -> pa.Table:
        every = [[int(x) for x in s.split(",")] for s in t.column("sums").to_pylist()]
        return pa.table([t.column(c)[:1] for c in ("d", "part", "entry")] + [pa.array([",".join(map(str, map(sum, zip(*every))))])], ["d", "part", "entry", "sums"])

    schema = "d int, part int, entry int, sums string"
    return rows.select("v", "bounds").mapInArrow(run, schema).groupBy("d", "part", "entry").applyInArrow(total, schema)


def seeds(rows: DataFrame, parts: int, entries: int, scale: int) -> Books:
    """Starting codebooks of each vector length: parts of the ``entries`` smallest vec_ids, nulls last."""
    w = Window.partitionBy("d").orderBy(F.col("vec_id").asc_nulls_last(), "v")
    # Tasks keep their first rows before the shuffle (a group limit in the plan).
    first = rows.select("vec_id", "v", F.size("v").alias("d")).withColumn("nth", F.row_number().over(w)).filter(F.col("nth") <= entries)
    found: dict[int, list] = {}
    for r in first.orderBy("d", "nth").collect():
        found.setdefault(r["d"], []).append(r["v"])
    books: Books = {}
    for d, vectors in found.items():
        x = whole_matrix(np.array(vectors, float).reshape(len(vectors), d), scale)
        books[d] = [[x[:, where] for where in part_slices(d, parts)]]
    return books


def moved_books(history: list[list[np.ndarray]], sums: dict[tuple[int, int], list[int]]) -> list[np.ndarray]:
    """The next codebooks: every used entry at the floor of its parts' mean, others where they are."""
    out = []
    for p, book in enumerate(history[-1]):
        new = book.astype(object)
        for e in range(len(book)):
            if (p, e) in sums:
                n, *total = sums[p, e]
                new[e] = [s // n for s in total]
        small = not new.size or max(abs(int(x)) for x in new.flat) < 2 ** 52
        out.append(new.astype(float) if small else new)
    return out


def _digest(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(int(x)) for book in books for x in book.flat).encode()).hexdigest()


def _coded(rows: DataFrame, books: Books, scale: int) -> DataFrame:
    """(vec_id, label, code, error, codebooks_sha256) of assigned rows."""
    digests = {d: _digest(history[-1]) for d, history in books.items()}
    newest = {d: history[-1] for d, history in books.items()}

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in it:
            kept = t.column("bounds").to_pylist()
            code, error, digest = [""] * t.num_rows, [None] * t.num_rows, [""] * t.num_rows
            for d, at, v in _by_length(t):
                codes = np.frombuffer(b"".join(kept[i] for i in at), BOUND).reshape(len(at), -1)["code"]
                x, sums = whole_matrix(v, scale), 0
                for p, where in enumerate(part_slices(d, codes.shape[1])):
                    sums = sums + own_squared(x[:, where], newest[d][p][codes[:, p]]).astype(object)
                for i, c, s in zip(at, codes, sums, strict=True):
                    code[i], digest[i] = c.tobytes().hex(), digests[d]
                    error[i] = int(s) if s < 2 ** 63 else None
            yield pa.RecordBatch.from_arrays([t.column("vec_id"), t.column("label"), pa.array(code), pa.array(error, pa.int64()), pa.array(digest)],
                                             ["vec_id", "label", "code", "error", "codebooks_sha256"])

    return rows.mapInArrow(run, f"vec_id {rows.schema['vec_id'].dataType.simpleString()}, label {rows.schema['label'].dataType.simpleString()}, "
                                "code string, error long, codebooks_sha256 string")


def compress(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = PARTS, entries: int = ENTRIES,
             rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """One row for each usable row of ``vectors``: vec_id, label, code, error, label_error, codebooks_sha256.

    Rows whose vector is null or holds null or non-finite components drop out.
    Components become floor(``scale`` * x). Each vector length has codebooks of
    its own, started from its smallest vec_ids (nulls last, equal ids by
    vector); a length that is no multiple of ``parts`` has its first parts one
    component longer. Fewer rows than ``entries`` give fewer entries. Repeated
    rows each count. ``label_error`` sums ``error`` over rows of the same label,
    nulls together. Errors beyond a long are null. An empty table gives an
    empty one. Other columns are not read.
    """
    if not (1 <= entries <= 256 and rounds <= 255):
        raise ValueError("codes and stamps are single bytes: at most 256 entries and 255 rounds")
    spark = prepared(vectors.sparkSession)
    v = F.col("v")
    fine = v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.col(label).alias("label"), F.col(vector).alias("v")).filter(F.coalesce(fine, F.lit(False)))
    rows = rows.withColumn("bounds", F.lit(None).cast("binary"))
    books = seeds(rows, parts, entries, scale)
    path = None
    for turn in range(rounds + 1):
        rows, old, path = _assigned(rows, books, scale), path, scratch_dir(spark, f"llm-codes-{turn}")
        schema = rows.schema
        rows.write.parquet(path)
        rows = spark.read.schema(schema).parquet(path)
        if old:
            fs.delete(spark, old)  # the new table replaces it
        if turn < rounds:
            sums: dict[int, dict] = {d: {} for d in books}
            for r in _part_sums(rows, books, scale).collect():  # one row for each entry
                sums[r["d"]][r["part"], r["entry"]] = [int(x) for x in r["sums"].split(",")]
            for d, history in books.items():
                history.append(moved_books(history, sums[d]))
    coded = staged(_coded(rows, books, scale), "codes")
    fs.delete(spark, path)
    salted, salt = fresh(coded, "salted", "salt")
    total = coded.groupBy("label").agg(F.expr("try_sum(error)").alias("label_error"), F.count("error").alias("known"), F.count("*").alias("n"))
    total = total.select(F.col("label").alias(salted), F.when(F.col("known") == F.col("n"), F.col("label_error")).alias("label_error"),
                         F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias(salt))
    # By label and salt, so that a label that a third of all rows have is many tasks' work.
    mine = F.pmod(F.xxhash64("vec_id", "code"), F.lit(SALTS)).cast("int")
    return coded.join(total, F.col("label").eqNullSafe(F.col(salted)) & (mine == F.col(salt))).select(
        "vec_id", "label", "code", "error", "label_error", "codebooks_sha256")

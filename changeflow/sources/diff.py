"""SRC-2 (re-aimed): change rows between two snapshots of a keyed table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RANGES = 65_536  # hash ranges of the key; their digests are compared first


def snapshot_diff(before: DataFrame, after: DataFrame, key: str | Sequence[str],
                  compare_cols: Sequence[str] | None = None) -> DataFrame:
    """Rows of ``c`` (created), ``u`` (updated) and ``d`` (deleted) between snapshots.

    A full outer join on the key; a row is updated if any compared column
    differs, null-safely. Output: key columns, ``op``, and the compared
    columns as ``<col>_before`` / ``<col>_after``. The key is unique per
    snapshot, so the join has no hot keys.
    """
    keys = [key] if isinstance(key, str) else list(key)
    cols = list(compare_cols) if compare_cols is not None else [c for c in after.columns if c not in keys]
    b = before.select(*keys, *[F.col(c).alias(f"{c}_before") for c in cols], F.lit(True).alias("_in_b"))
    a = after.select(*keys, *[F.col(c).alias(f"{c}_after") for c in cols], F.lit(True).alias("_in_a"))
    j = b.join(a, keys, "full_outer")
    changed = F.lit(False)
    for c in cols:
        changed = changed | ~F.col(f"{c}_before").eqNullSafe(F.col(f"{c}_after"))
    op = (F.when(F.col("_in_b").isNull(), F.lit("c"))
          .when(F.col("_in_a").isNull(), F.lit("d"))
          .when(changed, F.lit("u")))
    out = j.withColumn("op", op).filter(F.col("op").isNotNull())
    return out.select(*keys, "op", *[f"{c}_{s}" for c in cols for s in ("before", "after")])


def _range(keys: Sequence[str], ranges: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(ranges)).cast("int")


def range_digests(snapshot: DataFrame, keys: Sequence[str], cols: Sequence[str], ranges: int = RANGES) -> DataFrame:
    """(range, n, xored, summed): rows of each hash range of the key and order-free digests of them.

    Tasks reduce their rows to one for each range before the shuffle. Nulls
    count by their place, so a value that moves to another column shows.
    """
    marked = [x for c in [*keys, *cols] for x in (F.col(c), F.col(c).isNull())]
    h, g = F.xxhash64(*marked), F.xxhash64(F.lit("second"), *marked)
    return snapshot.groupBy(_range(keys, ranges).alias("range")).agg(
        F.count("*").alias("n"), F.bit_xor(h).alias("xored"), F.sum(g.cast("decimal(20,0)")).alias("summed"))


def snapshot_diff_by_digest(before: DataFrame, after: DataFrame, key: str | Sequence[str], compare_cols: Sequence[str] | None = None,
                            ranges: int = RANGES) -> DataFrame:
    """``snapshot_diff`` of two large snapshots that differ in few rows.

    Digests of hash ranges of the key are compared first; only rows of ranges
    that differ meet row by row, so of unchanged ranges nothing is shuffled but
    a digest. Equal digests of ranges that differ have a chance of 2 to the
    -128 or so. The list of ranges that differ has at most ``ranges`` numbers,
    whatever the snapshots, and is broadcast.
    """
    keys = [key] if isinstance(key, str) else list(key)
    cols = list(compare_cols) if compare_cols is not None else [c for c in after.columns if c not in keys]
    b, a = range_digests(before, keys, cols, ranges), range_digests(after, keys, cols, ranges)
    same = F.lit(True)
    for c in ("n", "xored", "summed"):
        same = same & F.col(f"b.{c}").eqNullSafe(F.col(f"a.{c}"))
    differ = b.alias("b").join(a.alias("a"), F.col("b.range") == F.col("a.range"), "full_outer").filter(~same).select(
        F.coalesce("b.range", "a.range").alias("_range"))

    def some(snapshot: DataFrame) -> DataFrame:
        return snapshot.withColumn("_range", _range(keys, ranges)).join(F.broadcast(differ), "_range", "left_semi").drop("_range")

    return snapshot_diff(some(before), some(after), keys, cols)

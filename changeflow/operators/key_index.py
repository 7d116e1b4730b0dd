"""Which parts of a table may hold a key: Bloom filters as a table (TBL-1, global key scope).

One row for each cell (a set of rows that is read together) and lane: the keys
of a cell are dealt to ``lanes`` lanes by hash, and a lane's bitmap of 32,768
bits has two bits set for each of its keys. Cells have as many lanes as keep
about sixteen bits for a key, so some 1 in 70 keys that a cell doesn't hold
passes; none that it holds is missed. Everything is built-in functions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LANE_BITS = 32_768  # what bitmap_construct_agg makes
KEY_BITS = 16


def _hashed(key: str) -> tuple[Column, Column, Column]:
    """(lane hash, first bit, second bit) of a key."""
    h, g = F.xxhash64(key), F.xxhash64(F.lit("second"), key)
    return h, F.pmod(F.shiftrightunsigned(h, 24), F.lit(LANE_BITS)), F.pmod(g, F.lit(LANE_BITS))


def build_index(rows: DataFrame, key: str, cell: Sequence[str]) -> DataFrame:
    """(cell..., lanes, lane, bits) of ``rows``; null keys are not indexed."""
    h, first, second = _hashed(key)
    keys = rows.select(*cell, key).filter(F.col(key).isNotNull())
    need = F.greatest(F.lit(1.0), F.count("*") * KEY_BITS / LANE_BITS)
    sizes = keys.groupBy(*cell).agg(F.pow(F.lit(2), F.ceil(F.log2(need))).cast("int").alias("lanes"))
    same = None
    for c in cell:
        on = F.col(f"k.{c}").eqNullSafe(F.col(f"s.{c}"))
        same = on if same is None else same & on
    bits = keys.select(*cell, h.alias("h"), F.explode(F.array(first, second)).alias("bit")).alias("k").join(sizes.alias("s"), same)
    return (bits.select(*[F.col(f"k.{c}").alias(c) for c in cell], "lanes", F.pmod("h", F.col("lanes")).cast("int").alias("lane"), "bit")
            .groupBy(*cell, "lanes", "lane").agg(F.bitmap_construct_agg("bit").alias("bits")))


def bit_at(bits: Column, at: Column) -> Column:
    """Whether a bitmap has a bit set."""
    byte = F.conv(F.hex(F.substring(bits, (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("long")
    return F.getbit(byte, (at % 8).cast("int")) == 1


def probe_index(index: DataFrame, keys: DataFrame, key: str, cell: Sequence[str], within: str) -> DataFrame:
    """Distinct cells that may hold one of ``keys``.

    ``within`` is a column of both (the key's bucket): a key is looked for in
    cells of its own bucket only. The keys of a bucket and lane meet a cell's
    bitmap as one array, so the probe reads as many rows as the index has.
    """
    h, first, second = _hashed(key)
    shapes = index.select(within, "lanes").distinct()
    asked = keys.select(within, key).filter(F.col(key).isNotNull()).distinct().join(shapes, within).select(
        within, "lanes", F.pmod(h, F.col("lanes")).cast("int").alias("lane"), F.struct(first.alias("a"), second.alias("b")).alias("at"))
    asked = asked.groupBy(within, "lanes", "lane").agg(F.collect_set("at").alias("asked"))
    hit = F.exists("asked", lambda x: bit_at(F.col("bits"), x["a"]) & bit_at(F.col("bits"), x["b"]))
    return index.join(asked, [within, "lanes", "lane"]).filter(hit).select(*cell).distinct()

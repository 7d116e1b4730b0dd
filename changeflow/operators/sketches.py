"""Distinct counts over any span of time, from sketches that merge (AGG-11, M-18 over time).

An exact distinct count of a month can't be had from the counts of its days.
Sketches can be merged: one small sketch for each entity and tick is kept as a
table, and any window is a union of them, without going back to the listing.
Exact counts (``listing.file_groups``) stay the default.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LG_K = 14  # 16,384 registers: some 0.8 % standard error; counts up to a tenth of that are near exact


def sketches(rows: DataFrame, keys: Sequence[str], value: Column, lg_k: int = LG_K) -> DataFrame:
    """(keys..., sketch) of the distinct values of each group; null values don't count. Tasks sketch before they shuffle."""
    return rows.groupBy(*keys).agg(F.hll_sketch_agg(value, lg_k).alias("sketch"))


def distinct_over(sketched: DataFrame, keys: Sequence[str], name: str = "n_distinct") -> DataFrame:
    """(keys..., name): estimated distinct values of all sketches of a group together."""
    return sketched.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias(name))


def distinct_in_windows(sketched: DataFrame, at: str, ends: Column, span: int, keys: Sequence[str] = (), name: str = "n_distinct") -> DataFrame:
    """(keys..., end, name): distinct values of each window of ``span`` ticks that ends at one of ``ends``.

    ``at`` is the sketches' tick (a whole number); ``ends`` gives for a sketch
    the array of window ends, of which those it doesn't reach are left out.
    """
    rows = sketched.withColumn("end", F.explode(ends)).filter((F.col(at) <= F.col("end")) & (F.col(at) > F.col("end") - span))
    return distinct_over(rows, [*keys, "end"], name)

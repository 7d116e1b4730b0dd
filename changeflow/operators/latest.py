"""AGG-1 / TBL-5: latest row per key by an ordering (latest-wins, precombine).

Implemented as a grouped ``max_by``, not a window: the aggregate runs
partially on the map side, so a hot key (one that holds a large share of all
rows) is reduced to one row per input partition before the shuffle instead of
being sorted in a single task. Only the order columns are compared, so values
may be of any type, maps included.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def precombine(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep the row with the largest ``order`` tuple per ``keys``.

    Nulls in an ordering column sort first, so a row with a null ``ts`` loses
    to any row with a time. The ordering must be total for deterministic
    results; callers append broker position columns as final tie-breakers.
    """
    keys = list(keys)
    values = [c for c in df.columns if c not in keys]
    winner = F.max_by(F.struct(*values), F.struct(*order)).alias("_w")
    out = {c: F.col(c) for c in keys} | {c: F.col(f"_w.{c}").alias(c) for c in values}
    return df.groupBy(*keys).agg(winner).select(*[out[c] for c in df.columns])

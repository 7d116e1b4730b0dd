"""Connected components of a link table, as joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeflow.llm.common import cut, fresh

HOT = 1000  # a key with more than 1 / HOT of all rows is hot, so fewer than HOT keys are


def join_unique(rows: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """``rows`` joined with ``known``, where ``key`` is unique and present for every row.

    A hot key's rows stay where they lie and meet a broadcast of fewer than HOT
    rows of ``known``, whatever the input; all others meet by shuffle, so no
    task gets more than its share and one key at most 1 / HOT of the rows.
    ``rows`` is read three times: hand it over staged or checkpointed.
    """
    n, = fresh(rows, "n")
    total = rows.count()
    hot = cut(rows.groupBy(key).agg(F.count("*").alias(n)).filter(F.col(n) * HOT > total).select(key))
    some = known.join(F.broadcast(hot), key)
    others = rows.join(F.broadcast(hot), key, "left_anti")
    return rows.join(F.broadcast(some), key).unionByName(others.join(known, key))


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node that has a link; root is the smallest node reachable.

    Nodes are of any type that Spark can order, structs included. Each round
    gives a node the smallest label among its neighbours and then the label of
    that label, so labels travel twice as far every round. A node has few links
    (callers hand on chains), but a label may be that of a third of all nodes:
    labels are looked up with ``join_unique``. Minima are pre-aggregated before
    the shuffle. A round's labels are checkpointed, so lost executors repeat
    one round at most. Null ends and self-links are ignored; no link at all
    gives an empty result.
    """
    one = links.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u is not null and v is not null and u <> v")
    one = cut(one.distinct())  # a link found in several places counts once
    both = one.union(one.select(F.col("v").alias("u"), F.col("u").alias("v")))
    labels = cut(both.groupBy("u").agg(F.min("v").alias("m"))
                 .select(F.col("u").alias("node"), F.least("u", "m").alias("root")))
    while True:
        near = (both.join(labels.select(F.col("node").alias("v"), "root"), "v")
                .groupBy(F.col("u").alias("node")).agg(F.min("root").alias("near")))
        best = cut(labels.join(near, "node").select("node", F.col("root").alias("old"), F.least("root", "near").alias("hop")))
        jump = labels.select(F.col("node").alias("hop"), F.col("root").alias("far"))
        step = cut(join_unique(best, jump, "hop").select("node", "old", F.least("hop", "far").alias("root")))
        moved = step.filter("old <> root").limit(1).count()
        labels = step.select("node", "root")
        if not moved:
            return labels

"""A-1..13, WIN-3 as time goes on: a trigger evaluates what came since the last one.

The state between triggers is small and bounded by the series, not by time: the
samples of the last minutes that later evaluations can still see, and for each
run of a condition that is active the time since when. It is written as one
table for each batch, so a trigger that is run again after a failure starts
from the same state and overwrites its own output.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from changeflow.operators import alerts as A
from changeflow.sources import fs

SAMPLE = ("ts", "metric", "labels", "value")
RUN = ("alert", "metric", "series", "active_since")
KEPT_STATES = 2


class AlertEvaluator:
    """Folds batches of samples into alert states under ``root``.

    ``root/alerts/batch_id=N`` holds the rows of ``alerts.evaluate`` for the
    evaluation times that batch N completed. A
    sample that comes after its evaluation time was passed counts for later
    evaluations that it still reaches, and changes none that was made, as with
    rules that are evaluated live.
    """

    def __init__(self, root: str, rules: Sequence[A.Rule] = tuple(A.RULES), step_s: int = A.EVAL_STEP_S, lookback_s: int = A.LOOKBACK_S):
        self.root, self.rules, self.step_s, self.lookback_s = root, tuple(rules), step_s, lookback_s

    def _states(self, spark: SparkSession) -> list[int]:
        names = [n for n, _, _, is_dir in fs.list_dir(spark, f"{self.root}/state") if is_dir and n.startswith("batch_id=")]
        done = [n for n in names if any(x == "_SUCCESS" for x, _, _, _ in fs.list_dir(spark, f"{self.root}/state/{n}/until"))]
        return sorted(int(n.split("=")[1]) for n in done)

    def _state(self, batch_id: int, part: str) -> str:
        return f"{self.root}/state/batch_id={batch_id}/{part}"

    def __call__(self, batch: DataFrame, batch_id: int, until: int | None = None) -> None:
        """Evaluate up to the newest sample, or to the time ``until`` (epoch seconds) if that is later."""
        spark = batch.sparkSession
        batch = batch.select(*SAMPLE).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            before = [b for b in self._states(spark) if b < batch_id]
            newest = batch.agg(F.max(F.unix_seconds("ts"))).first()[0]
            begin, window, running = None, batch, None
            if before:
                begin = spark.read.parquet(self._state(before[-1], "until")).first()["until"]
                window = spark.read.schema(batch.schema).parquet(self._state(before[-1], "tail")).unionByName(batch)
                running = spark.read.parquet(self._state(before[-1], "running"))
            until = max(x // self.step_s * self.step_s for x in (begin, newest, until, 0) if x is not None)
            out = A.evaluate_next(window, running, begin, until, self.rules, self.step_s, self.lookback_s)
            path = f"{self.root}/alerts/batch_id={batch_id}"
            out.write.mode("overwrite").parquet(path)
            rows = spark.read.schema(out.schema).parquet(path)
            now = rows.filter(F.col("t") == until).select(*RUN)
            if begin == until:  # no evaluation time was completed: the runs are as they were
                now = running.select(*RUN)
            now.write.mode("overwrite").parquet(self._state(batch_id, "running"))
            reach = A.longest_reach(self.rules, self.lookback_s)
            window.filter(F.unix_seconds("ts") > until - reach - 1).write.mode("overwrite").parquet(self._state(batch_id, "tail"))
            # Written last: a state without it is not one.
            spark.createDataFrame([(until,)], "until bigint").coalesce(1).write.mode("overwrite").parquet(self._state(batch_id, "until"))
            for old in before[:-KEPT_STATES]:
                fs.delete(spark, f"{self.root}/state/batch_id={old}")
        finally:
            batch.unpersist()

    def alerts(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.root}/alerts").drop("batch_id")


def start_alerts(samples: DataFrame, evaluator: AlertEvaluator, checkpoint: str, trigger: str | None = "30 seconds",
                 available_now: bool = False) -> StreamingQuery:
    """Evaluate a stream of samples (ts, metric, labels, value) as it comes."""
    writer = samples.writeStream.option("checkpointLocation", checkpoint).foreachBatch(evaluator)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=trigger)
    return writer.start()

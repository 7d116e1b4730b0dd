"""SNK-1/2, STR-1..10: one streaming query, three outputs per micro-batch.

The reference ran two queries over the same topic (each message fetched and
parsed twice, branches on different batches). Here one ``foreachBatch``
parses once, persists the routed batch, and writes the delta, the dead
letters and the dropped rows from it. Every output path is keyed by the
batch id and written with overwrite, so a replayed batch (after a failure
between write and checkpoint commit) produces the same state.
"""

from __future__ import annotations

import threading
from concurrent.futures import Future, ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from changeflow.operators.routing import dead_letters, project_rows, route
from changeflow.operators.table import TableSpec, apply_changes, change_batch, clean, compact, read_state
from changeflow.sources.messages import parse_messages
from changeflow.streaming.progress_log import ProgressLog


@dataclass(frozen=True)
class Outputs:
    dlq_path: str
    dropped_path: str | None = None
    dlq_format: str = "parquet"  # "kafka" when the broker connector is present
    dlq_topic: str | None = None
    bootstrap_servers: str | None = None
    tombstones: str = "dead_letter"  # or "skip": NULL-value messages are not kept
    retain_commits: int | None = 2  # clean after each compaction, keeping this many commits; None keeps all
    compaction: str = "inline"  # "inline" (deterministic), "async" (background, overlaps batches), "off"


def routed_branches(batch: DataFrame, spec: TableSpec, tombstones: str = "dead_letter"):
    """(changes, dead, dropped) of one batch of raw messages."""
    routed = route(parse_messages(batch))
    # Only dead letters need their text again: what is kept of the others is what was parsed.
    routed = routed.withColumn("json_str", F.when(F.col("route") == "dead", F.col("json_str")))
    good = project_rows(routed.filter(F.col("route") == "good"))
    deletes = None
    if spec.deletes == "apply":
        deletes = project_rows(routed.filter(F.col("reason") == "delete"))
    dead_src = routed
    if tombstones == "skip":
        dead_src = routed.filter(~((F.col("route") == "dead") & F.col("json_str").isNull()))
    dead = dead_letters(dead_src)
    dropped = routed.filter(F.col("route") == "dropped").select(
        "kafka_key", "partition", "offset", "reason", F.col("parsed.payload.tracking_id").alias("tracking_id"))
    return routed, change_batch(good, deletes), dead, dropped


class Compactor:
    """Table maintenance after each batch: inline, or on one background thread.

    Async mode mirrors an asynchronous compactor: a compaction (then a clean,
    if configured) starts when enough batches are pending and none is running;
    the stream keeps writing batches meanwhile (a compaction drops those that
    it read, so new ones stay pending). ``drain`` waits and
    then compacts whatever is still pending, so the final state does not
    depend on timing.
    """

    def __init__(self, spec: TableSpec, outputs: Outputs, spark=None):
        self.spec, self.outputs, self.spark = spec, outputs, spark
        self._pool = ThreadPoolExecutor(max_workers=1) if outputs.compaction == "async" else None
        self._future: Future | None = None
        self._lock = threading.Lock()

    def _maintain(self, spark) -> None:
        if len(read_state(spark, self.spec).pending) >= self.spec.min_deltas:
            compact(spark, self.spec)
            if self.outputs.retain_commits:
                clean(spark, self.spec, self.outputs.retain_commits, dry_run=False)

    def after_batch(self, spark) -> None:
        if self.outputs.compaction == "off" or not self.spec.min_deltas:
            return
        if self._pool is None:
            self._maintain(spark)
            return
        with self._lock:
            if self._future is not None and not self._future.done():
                return
            if self._future is not None:
                self._future.result()  # surface a failed compaction
            self._future = self._pool.submit(self._maintain, spark)

    def drain(self, spark=None) -> None:
        spark = spark or self.spark
        if self._pool is not None:
            with self._lock:
                if self._future is not None:
                    self._future.result()
                self._future = None
        if self.outputs.compaction != "off" and self.spec.min_deltas:
            self._maintain(spark)


def batch_writer(spec: TableSpec, outputs: Outputs, compactor: Compactor | None = None):
    """The ``foreachBatch`` function: apply changes, write dead letters and drops."""
    compactor = compactor or Compactor(spec, outputs)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        routed, changes, dead, dropped = routed_branches(batch, spec, outputs.tombstones)
        routed.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            apply_changes(spark, spec, changes, batch_id, compact_after=False)
            if outputs.dlq_format == "kafka":
                (dead.write.format("kafka")
                 .option("kafka.bootstrap.servers", outputs.bootstrap_servers)
                 .option("topic", outputs.dlq_topic).save())
            else:
                dead.write.mode("overwrite").parquet(f"{outputs.dlq_path}/batch_id={batch_id}")
            if outputs.dropped_path:
                dropped.write.mode("overwrite").parquet(f"{outputs.dropped_path}/batch_id={batch_id}")
        finally:
            routed.unpersist()
        # Only now: a failing compaction must not hold back the batch's outputs.
        compactor.after_batch(spark)

    return write


_RUNNING: dict[str, tuple[Compactor, ProgressLog | None]] = {}


def start_apply(stream: DataFrame, spec: TableSpec, checkpoint: str, outputs: Outputs,
                trigger: str | None = "30 seconds", available_now: bool = False,
                name: str | None = None, progress: str | None = None) -> StreamingQuery:
    """Start the change-apply query (append mode, own checkpoint).

    With ``progress``, a listener appends the query's progress records (SRC-12)
    to that folder as they come. Call ``finish_apply(query)`` after the query
    ends to wait for background maintenance (async compaction) and the records."""
    log = ProgressLog(stream.sparkSession, progress) if progress else None
    compactor = Compactor(spec, outputs, stream.sparkSession)
    writer = (stream.writeStream.outputMode("append")
              .option("checkpointLocation", checkpoint)
              .foreachBatch(batch_writer(spec, outputs, compactor)))
    if name:
        writer = writer.queryName(name)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif trigger:
        writer = writer.trigger(processingTime=trigger)
    query = writer.start()
    if log is not None:
        log.watch(query.id)
    _RUNNING[query.id] = compactor, log
    return query


def finish_apply(query: StreamingQuery, timeout_s: float | None = None) -> None:
    """Wait for the query to end (or for ``timeout_s``), then for its progress records and table maintenance."""
    if timeout_s is None:
        query.awaitTermination()
    else:
        query.awaitTermination(timeout_s)
    if query.isActive:
        return
    compactor, log = _RUNNING.pop(query.id, (None, None))
    if log is not None:
        log.close()
    if compactor is not None:
        if query.exception() is not None:
            raise query.exception()
        compactor.drain()

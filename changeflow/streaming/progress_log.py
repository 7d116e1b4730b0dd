"""SRC-12: progress records of a streaming query, written as they come.

A listener sees every trigger, however short; ``recentProgress`` keeps the last
hundred only. The listener hands records to one thread that appends them as
JSON lines, so that a slow write never holds back the listener bus.
"""

from __future__ import annotations

import json
import queue
import threading

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQueryListener

FLUSH_RECORDS = 200
FLUSH_S = 10.0
_END = object()


class ProgressLog(StreamingQueryListener):
    """Appends the progress of the query ``watch`` names to a folder that ``sources.progress`` reads.

    Add it before the query starts. Triggers without input leave no record.
    ``close`` waits for the query's end to be reported and writes what is left.
    """

    def __init__(self, spark: SparkSession, folder: str, flush_records: int = FLUSH_RECORDS, flush_s: float = FLUSH_S) -> None:
        self.spark, self.folder, self.flush_records, self.flush_s = spark, folder, flush_records, flush_s
        self.query_id: str | None = None
        self.failed: Exception | None = None
        self._records: queue.Queue = queue.Queue()
        self._ended: set[str] = set()
        self._end = threading.Condition()
        self._writer = threading.Thread(target=self._write, daemon=True)
        self._writer.start()
        spark.streams.addListener(self)

    def watch(self, query_id: str) -> None:
        self.query_id = query_id

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        if event.progress.numInputRows:
            self._records.put(event.progress.json)

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        with self._end:
            self._ended.add(str(event.id))
            self._end.notify_all()

    def _append(self, records: list[str]) -> None:
        # Records of other queries of the session are not this one's.
        mine = [(r,) for r in records if self.query_id is None or json.loads(r)["id"] == self.query_id]
        if mine:
            self.spark.createDataFrame(mine, "value string").coalesce(1).write.mode("append").text(self.folder)

    def _write(self) -> None:
        held: list[str] = []
        while True:
            try:
                got = self._records.get(timeout=self.flush_s)
            except queue.Empty:
                got = None
            if isinstance(got, str):
                held.append(got)
            if held and (not isinstance(got, str) or len(held) >= self.flush_records):
                try:
                    self._append(held)
                except Exception as e:  # noqa: BLE001
                    self.failed = e
                held = []
            if got is _END:
                return

    def close(self, timeout_s: float = 60.0) -> None:
        if self.query_id is not None:
            with self._end:
                self._end.wait_for(lambda: self.query_id in self._ended, timeout_s)
        self.spark.streams.removeListener(self)
        self._records.put(_END)
        self._writer.join(timeout_s)
        if self.failed is not None:
            raise self.failed

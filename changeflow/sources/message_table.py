"""SRC-1, STR-3, STR-5: a stream over a table of messages, by offset ranges.

Messages that were archived as Parquet by topic and partition
(``topic=.../partition=.../*.parquet`` with columns key, value, offset,
timestamp) are read as a stream whose offsets are ``{topic: {partition:
offset}}``, as a broker's are: a trigger takes at most so many offsets, shared
among partitions by what each has waiting, a restarted query goes on where it
stopped, and ranges that have expired from the table are passed over.

The source is a class made by a function, so that it travels to the Python
workers by value and needs no package there.
"""

from __future__ import annotations

ROWS_PER_TASK = 200_000  # offsets of one task's range
ROWS_AT_ONCE = 4_096  # messages that a task holds


def message_table() -> type:
    """The data source ``message_table``; register it with ``spark.dataSource.register``.

    Options: ``path``; ``maxOffsetsPerTrigger``; ``failOnDataLoss`` (default
    false: expired ranges are passed over); ``checkpoint``, the query's
    checkpoint folder, by which the limit holds in the first trigger after a
    restart too (without it that trigger takes all there is).
    """
    import json

    from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

    rows_per_task, rows_at_once = ROWS_PER_TASK, ROWS_AT_ONCE

    def ordered(offsets: dict) -> dict:
        """In one order: Spark compares offsets by their text."""
        return {t: {p: parts[p] for p in sorted(parts, key=int)} for t, parts in sorted(offsets.items())}

    class Range(InputPartition):
        def __init__(self, topic: str, partition: int, start: int, end: int) -> None:
            self.topic, self.partition, self.start, self.end = topic, partition, start, end

    class Reader(DataSourceStreamReader):
        def __init__(self, options: dict) -> None:
            self.path = options["path"].removeprefix("file:")
            self.limit = int(options.get("maxoffsetspertrigger") or options.get("maxOffsetsPerTrigger") or 0)
            self.strict = str(options.get("failondataloss") or options.get("failOnDataLoss") or "false").lower() == "true"
            self.checkpoint = (options.get("checkpoint") or "").removeprefix("file:")
            self.at: dict | None = None  # up to where offsets were handed out

        def _dataset(self):
            import pyarrow as pa
            import pyarrow.dataset as ds

            return ds.dataset(self.path, format="parquet",
                              partitioning=ds.partitioning(pa.schema([("topic", pa.string()), ("partition", pa.int32())]), flavor="hive"))

        def _held(self) -> dict[str, dict[str, tuple[int, int]]]:
            """First offset and the one after the last of every partition, from the files' statistics."""
            import pyarrow.dataset as ds

            out: dict = {}
            for f in self._dataset().get_fragments():
                keys = ds.get_partition_keys(f.partition_expression)
                for group in f.row_groups:
                    if group.num_rows:
                        low, high = group.statistics["offset"]["min"], group.statistics["offset"]["max"] + 1
                        parts = out.setdefault(keys["topic"], {})
                        old = parts.get(str(keys["partition"]), (low, high))
                        parts[str(keys["partition"])] = (min(old[0], low), max(old[1], high))
            return out

        def initialOffset(self) -> dict:  # noqa: N802
            return ordered({t: {p: low for p, (low, _) in parts.items()} for t, parts in self._held().items()})

        def _logged(self) -> dict | None:
            """The newest offsets in the query's checkpoint."""
            import os

            folder = f"{self.checkpoint}/offsets"
            names = [n for n in os.listdir(folder) if n.isdigit()] if self.checkpoint and os.path.isdir(folder) else []
            if not names:
                return None
            with open(f"{folder}/{max(names, key=int)}", encoding="utf-8") as f:
                return json.loads(f.read().strip().split("\n")[-1])

        def latestOffset(self) -> dict:  # noqa: N802
            held = self._held()
            at = self.at if self.at is not None else self._logged() if self.checkpoint else None
            if at is None and self.checkpoint:
                at = {t: {p: low for p, (low, _) in parts.items()} for t, parts in held.items()}  # the query's first trigger
            end = {t: {p: max(high, (at or {}).get(t, {}).get(p, 0)) for p, (_, high) in parts.items()} for t, parts in held.items()}
            for t, parts in (at or {}).items():  # what has expired altogether stays where it was
                for p, o in parts.items():
                    end.setdefault(t, {}).setdefault(p, o)
            if self.limit and at is not None:
                begin = {(t, p): max(at.get(t, {}).get(p, 0), held.get(t, {}).get(p, (0, 0))[0]) for t, parts in end.items() for p in parts}
                waiting = {k: max(0, end[k[0]][k[1]] - b) for k, b in begin.items()}
                total = sum(waiting.values())
                if total > self.limit:
                    left = self.limit
                    for (t, p), n in sorted(waiting.items(), key=lambda x: -x[1]):
                        take = min(n, left, -(-self.limit * n // total))
                        end[t][p], left = begin[t, p] + take if n else end[t][p], left - take
            self.at = ordered(end)
            return self.at

        def partitions(self, start: dict, end: dict) -> list:
            held, out = self._held(), []
            for t, parts in end.items():
                for p, stop in parts.items():
                    low = held.get(t, {}).get(p, (stop, stop))[0]
                    begin = start.get(t, {}).get(p, low)
                    if begin < low and self.strict:
                        raise ValueError(f"offsets {begin} to {low} of {t}-{p} have expired")
                    begin = max(begin, low)
                    out += [Range(t, int(p), a, min(a + rows_per_task, stop)) for a in range(begin, stop, rows_per_task)]
            return out or [Range("", -1, 0, 0)]

        def read(self, partition):
            import pyarrow as pa
            import pyarrow.compute as pc
            import pyarrow.dataset as ds
            import pyarrow.parquet as pq

            if partition.partition < 0:
                return
            data = self._dataset()
            for f in data.get_fragments((ds.field("topic") == partition.topic) & (ds.field("partition") == partition.partition)):
                groups = [g.id for g in f.row_groups if g.num_rows and g.statistics["offset"]["max"] >= partition.start
                          and g.statistics["offset"]["min"] < partition.end]
                if not groups:
                    continue
                # A page of each column and a batch of rows at a time; a dataset's scan reads row groups ahead.
                with f.filesystem.open_input_file(f.path) as file:
                    source = pq.ParquetFile(file, buffer_size=1 << 16, pre_buffer=False)
                    for b in source.iter_batches(rows_at_once, groups, columns=["key", "value", "offset", "timestamp"], use_threads=False):
                        offset = b.column("offset")
                        b = b.filter(pc.and_(pc.greater_equal(offset, partition.start), pc.less(offset, partition.end)))
                        if b.num_rows:
                            when = pc.cast(b.column("timestamp"), pa.timestamp("us", "UTC"))
                            yield pa.RecordBatch.from_arrays(
                                [b.column("key").cast(pa.binary()), b.column("value").cast(pa.binary()),
                                 pa.array([partition.topic] * b.num_rows, pa.string()), pa.array([partition.partition] * b.num_rows, pa.int32()),
                                 b.column("offset").cast(pa.int64()), when],
                                ["key", "value", "topic", "partition", "offset", "timestamp"])

        def commit(self, end: dict) -> None:
            pass

    class MessageTable(DataSource):
        @classmethod
        def name(cls) -> str:
            return "message_table"

        def schema(self) -> str:
            return "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp"

        def streamReader(self, schema):  # noqa: N802
            return Reader(dict(self.options))

    return MessageTable

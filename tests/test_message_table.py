"""The stream over a table of messages: offset ranges, limit, restart, expired ranges."""

import pytest
from pyspark.sql import functions as F

from changeflow.session import scratch_dir
from changeflow.sources.messages import MessageSource, read_messages


def _write(spark, root, first, last, name):
    rows = spark.range(first, last).select(F.lit(b"k").alias("key"), F.col("id").cast("string").cast("binary").alias("value"), F.lit("t").alias("topic"),
                                           (F.col("id") % 3).cast("int").alias("partition"), F.floor(F.col("id") / 3).alias("offset"),
                                           F.timestamp_seconds(F.col("id")).alias("timestamp"))
    rows.coalesce(1).write.mode("append").partitionBy("topic", "partition").parquet(f"{root}/{name}")


def _run(spark, root, limit, seen, strict=False):
    source = MessageSource(f"{root}/messages", format="message_table", max_per_trigger=limit, checkpoint=f"{root}/ckpt", fail_on_data_loss=strict)

    def keep(batch, batch_id):
        seen[batch_id] = sorted((r["partition"], r["offset"], int(r["value"])) for r in batch.collect())

    q = read_messages(spark, source).writeStream.option("checkpointLocation", f"{root}/ckpt").foreachBatch(keep).trigger(processingTime="0 seconds").start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    return q


def test_offset_ranges_limit_and_restart(spark):
    root = scratch_dir(spark, "message-table")
    _write(spark, root, 0, 900, "messages")
    seen = {}
    _run(spark, root, 250, seen)
    assert len(seen) == 4 and all(len(v) <= 250 for v in seen.values())
    _write(spark, root, 900, 1500, "messages")
    _run(spark, root, 250, seen)  # goes on where it stopped, within the limit from the first trigger on
    assert len(seen) == 7 and all(len(v) <= 250 for v in seen.values())
    every = [x for v in seen.values() for x in v]
    assert sorted(v for _, _, v in every) == list(range(1500)) and all(3 * o + p == v for p, o, v in every)


def test_expired_ranges(spark):
    root = scratch_dir(spark, "message-expired")
    _write(spark, root, 0, 300, "messages")
    seen = {}
    _run(spark, root, 1000, seen)
    # What follows begins at offset 200: 100 to 199 were never read and are gone.
    late = scratch_dir(spark, "message-late")
    _write(spark, late, 600, 900, "messages")
    import os

    os.symlink(f"{late}/messages".removeprefix("file:"), f"{root}/late".removeprefix("file:"))
    for strict in (True, False):
        source = MessageSource(f"{root}/late", format="message_table", max_per_trigger=1000, checkpoint=f"{root}/ckpt", fail_on_data_loss=strict)
        got = {}
        q = read_messages(spark, source).writeStream.option("checkpointLocation", f"{root}/ckpt").foreachBatch(
            lambda b, n: got.update({n: sorted(r["offset"] for r in b.collect())})).trigger(processingTime="0 seconds").start()
        if strict:
            with pytest.raises(Exception, match="expired"):
                q.processAllAvailable()
        else:
            q.processAllAvailable()
            assert [x for v in got.values() for x in v] == sorted([*range(200, 300)] * 3)
        q.stop()

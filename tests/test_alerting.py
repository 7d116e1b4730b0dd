"""Alert states folded batch by batch, and progress records of a running query."""

import time

from pyspark.sql import functions as F

from changeflow.operators import alerts as A
from changeflow.operators.table import TableSpec
from changeflow.plans import streams
from changeflow.session import scratch_dir
from changeflow.sources import fixtures as FX
from changeflow.sources.messages import MessageSource, read_messages
from changeflow.sources.progress import progress_metrics
from changeflow.streaming.alerting import AlertEvaluator, start_alerts
from changeflow.streaming.apply import Outputs, finish_apply, start_apply

SF = "/root/testdata/sf0.001"
OUT = ("alert", "metric", "series", "t", "value", "active_since", "state")


def _rows(df):
    return sorted((tuple(r) for r in df.select(*OUT).collect()), key=str)


def _part(spark):
    """Three days of two pipelines' samples."""
    history = FX.scrape_history(FX.read_table(spark, SF, "events"))
    return history.filter((F.col("ts") < "2024-01-04") & F.col("labels")["pipeline"].isin("7", "8"))


def test_batches_give_the_states_of_a_full_evaluation(spark):
    samples = _part(spark).cache()
    times = sorted(r[0] for r in samples.select(F.unix_seconds("ts")).distinct().collect())
    # Uneven cuts: one falls inside a run, one batch is empty, one is evaluated twice.
    cuts = [times[0] - 1, times[len(times) // 7], times[len(times) // 7], times[len(times) // 2], times[-3], times[-1]]
    root = scratch_dir(spark, "alerting")
    evaluator = AlertEvaluator(root)
    for n, (a, b) in enumerate(zip(cuts, cuts[1:])):
        batch = samples.filter((F.unix_seconds("ts") > a) & (F.unix_seconds("ts") <= b))
        evaluator(batch, n)
        if n == 3:
            AlertEvaluator(root)(batch, n)  # after a restart: same state, same output
    evaluator(samples.limit(0), len(cuts), until=times[-1] + 2000)
    want = _rows(A.evaluate(samples))
    assert want and any(r[-1] == "firing" for r in want)
    assert _rows(evaluator.alerts(spark)) == want
    # What is kept doesn't grow with time.
    kept = evaluator._states(spark)
    assert len(kept) <= 3
    tail = spark.read.parquet(evaluator._state(kept[-1], "tail"))
    assert tail.filter(F.unix_seconds("ts") < times[-1] - A.longest_reach(A.RULES) - A.EVAL_STEP_S).count() == 0


def test_a_trigger_reads_no_old_samples(spark):
    samples = _part(spark)
    running = spark.createDataFrame([("PipelineStalled", A.P + "hudi_last_commit_age_seconds", "s", 0)], "alert string, metric string, series string, active_since bigint")
    # Evaluated at 30: the run that was active at 0 has ended, so nothing is left of it.
    out = A.evaluate_next(samples.limit(0), running, 0, 30)
    assert out.count() == 0


def test_stream_of_samples(spark):
    samples = _part(spark).filter(F.col("ts") < "2024-01-02").cache()
    root = scratch_dir(spark, "alert-stream")
    half = samples.select(F.expr("percentile(unix_seconds(ts), 0.5)")).first()[0]
    for n, some in enumerate((F.unix_seconds("ts") <= half, F.unix_seconds("ts") > half)):
        samples.filter(some).coalesce(1).write.parquet(f"{root}/in/{n}")
    evaluator = AlertEvaluator(f"{root}/out")
    for n in (0, 1):  # the second start goes on where the first one stopped
        source = spark.readStream.schema(samples.schema).option("recursiveFileLookup", "true").parquet(f"{root}/in/{{{','.join(map(str, range(n + 1)))}}}")
        q = start_alerts(source, evaluator, f"{root}/checkpoint", available_now=True)
        assert q.awaitTermination(300) and q.exception() is None
    newest = samples.agg(F.max(F.unix_seconds("ts"))).first()[0]
    want = [r for r in _rows(A.evaluate(samples)) if r[3] <= newest]
    assert want and _rows(evaluator.alerts(spark)) == want


def test_every_trigger_leaves_a_record(spark):
    """More triggers than the query itself remembers, on a processing-time trigger with files added in between."""
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        root = scratch_dir(spark, "progress-log")
        n = streams.write_message_files(spark, SF, root, [0, 1, 2])
        spec = TableSpec(root=f"{root}/table", num_buckets=2, min_deltas=0)
        q = start_apply(read_messages(spark, MessageSource(f"{root}/src", max_files_per_trigger=n)), spec, f"{root}/ckpt",
                        Outputs(f"{root}/dlq", compaction="off"), trigger="1 second", progress=f"{root}/progress")

        def wait_for(batches):
            for _ in range(600):
                done = q.lastProgress is not None and q.lastProgress.batchId >= batches
                if done or not q.isActive:
                    return
                time.sleep(0.2)

        wait_for(2)
        streams.write_message_files(spark, SF, root, [3, 4], n)
        wait_for(4)
        q.stop()
        assert len(q.recentProgress) <= 2
        finish_apply(q, 60)
        got = progress_metrics(spark.read.text(f"{root}/progress")).collect()
        assert sorted(r["batch_id"] for r in got) == [0, 1, 2, 3, 4]
        assert all(r["trigger_ms"] > 0 for r in got)
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")

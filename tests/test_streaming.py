"""The foreachBatch query end to end on a small replay: outputs, cleaning, restart."""

from pyspark.sql import functions as F

from changeflow.operators import table as tbl
from changeflow.operators.table import TableSpec
from changeflow.plans import streams
from changeflow.session import scratch_dir
from changeflow.sources import fs
from changeflow.sources.messages import MessageSource, read_messages
from changeflow.streaming.apply import Outputs, finish_apply, start_apply

SF = "/root/testdata/sf0.001"


def test_stream_with_cleaning(spark):
    root = scratch_dir(spark, "stream-clean")
    n = streams.write_message_files(spark, SF, root, list(range(10)))
    spec = TableSpec(root=f"{root}/table")
    src = read_messages(spark, MessageSource(f"{root}/src", max_files_per_trigger=n))
    q = start_apply(src, spec, f"{root}/ckpt", Outputs(f"{root}/dlq", f"{root}/dropped", retain_commits=2),
                    available_now=True)
    finish_apply(q, 600)
    assert q.exception() is None
    state = tbl.read_state(spark, spec)
    assert state.version == 9 and state.pending == []
    versions = {int(x.split("=")[1]) for x, _, _, d in fs.list_dir(spark, f"{root}/table/base") if d}
    batches = {int(x.split("=")[1]) for x, _, _, d in fs.list_dir(spark, f"{root}/table/changes") if d and x.startswith("batch_id=") and fs.list_dir(spark, f"{root}/table/changes/{x}")}
    assert {7, 9} <= versions and batches <= {8, 9}
    assert tbl.snapshot_view(spark, spec).count() == 383
    assert spark.read.parquet(f"{root}/dlq").count() == 60
    dropped = spark.read.parquet(f"{root}/dropped")
    assert dropped.groupBy("reason").count().orderBy("reason").collect()[0]["count"] == 20
    assert dropped.filter(F.col("reason").isin("delete", "unflagged")).count() == 40


def test_async_compaction_same_result(spark):
    root = scratch_dir(spark, "stream-async")
    n = streams.write_message_files(spark, SF, root, list(range(10)))
    spec = TableSpec(root=f"{root}/table")
    streams.run_stream(spark, root, spec, n, compaction="async")
    assert len(tbl.read_state(spark, spec).pending) < spec.min_deltas
    assert tbl.snapshot_view(spark, spec).count() == 383
    assert tbl.read_optimized_view(spark, spec).count() <= 383


def test_read_real_checkpoint(spark):
    """The offsets reader on a checkpoint Spark wrote (file source offsets)."""
    from changeflow.sources import offsets as O

    root = scratch_dir(spark, "stream-ckpt")
    n = streams.write_message_files(spark, SF, root, list(range(3)))
    streams.run_stream(spark, root, TableSpec(root=f"{root}/table"), n)
    files = O.read_checkpoint_files(spark, f"{root}/checkpoint")
    assert sorted(r["file_name"] for r in files.collect()) == ["0", "1", "2"]
    done = O.read_checkpoint_files(spark, f"{root}/checkpoint", consumed_from="commits")
    assert done.count() == 3
    text = files.filter(F.col("file_name") == "2").first()["text"]
    assert len(text.strip().split("\n")) >= 3
    # A file source records {"logOffset": n}: no broker topic map, so no rows.
    assert O.checkpoint_offsets(files, "any").count() == 0


def test_job_entry_point(spark):
    """The job module on replay files (file source, available-now)."""
    from changeflow.streaming import job

    root = scratch_dir(spark, "stream-job")
    n = streams.write_message_files(spark, SF, root, list(range(10)))
    job.main(["--table", f"{root}/table", "--checkpoint", f"{root}/ckpt", "--dlq", f"{root}/dlq",
              "--source", f"{root}/src", "--source-format", "parquet", "--max-files-per-trigger", str(n),
              "--progress", f"{root}/progress", "--available-now"])
    spec = TableSpec(root=f"{root}/table")
    assert tbl.snapshot_view(spark, spec).count() == 383
    assert spark.read.parquet(f"{root}/dlq").count() == 60
    # The job's own progress records, scraped, feed the batch-overrun rule.
    from changeflow.operators import alerts, metrics_job

    status = spark.createDataFrame([("2024-01-01 00:00:00", "connector", "FAILED")], "ts string, component string, state string")
    status = status.withColumn("ts", F.col("ts").cast("timestamp"))
    scrapes = spark.createDataFrame([("2024-01-01 00:00:00", 2, 0.5)], "ts string, errors long, duration_s double").withColumn("ts", F.col("ts").cast("timestamp"))
    samples = metrics_job.scrape(spark, f"{root}/table", None, f"{root}/progress", None, status=status, scrapes=scrapes).cache()
    names = {r["metric"] for r in samples.select("metric").distinct().collect()}
    assert {"pipeline_debezium_connector_running", "pipeline_exporter_scrape_errors_total", "pipeline_hudi_commit_count"} <= names
    overrun = next(r for r in alerts.RULES if r.name == "SparkBatchOverrun")
    series = samples.filter(overrun.term.value.of(F.col("metric")))
    assert series.count() == 1 and series.first()["value"] > 0
    assert series.first()["ts"].year >= 2024


def test_metrics_job_on_streamed_table(spark):
    """A scrape of the table written by the stream: timeline and file metrics."""
    from changeflow.operators import metrics_job

    root = scratch_dir(spark, "stream-metrics")
    n = streams.write_message_files(spark, SF, root, list(range(4)))
    streams.run_stream(spark, root, TableSpec(root=f"{root}/table"), n)
    out = f"{root}/samples"
    metrics_job.main(["--table", f"{root}/table", "--samples", out])
    got = {r["metric"]: r["value"] for r in spark.read.parquet(out).collect()}
    assert got["pipeline_hudi_deltacommit_count"] == 4
    assert got["pipeline_hudi_commit_count"] == 2
    assert got["pipeline_hudi_inflight_operations"] == 0
    assert got["pipeline_hudi_data_files_total"] > 0
    assert got["pipeline_hudi_log_files_total"] == 0
    assert got["pipeline_hudi_table_size_bytes"] > 0
    assert 0 <= got["pipeline_hudi_last_commit_age_seconds"] < 3600

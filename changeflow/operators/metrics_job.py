"""Compute pipeline metrics from a live table and stream, append them as samples.

    python -m changeflow.operators.metrics_job --table s3a://lake/shipments \\
        --checkpoint s3a://lake/checkpoints/shipments --progress s3a://lake/progress \\
        --topic shipments.shipments_db.shipments --samples s3a://lake/metrics

One run = one scrape: the table is listed (timeline and data files), the
newest offsets file of the checkpoint gives consumed offsets, and progress
records (JSON lines that ``streaming.job --progress`` appends) give the high
watermarks and the newest trigger's duration, so no topic is scanned. Samples are appended partitioned by
date; the alert rules and panels read them back.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.operators import metrics as M
from changeflow.session import prepare
from changeflow.sources import listing as L
from changeflow.sources import offsets as O
from changeflow.sources import fs
from changeflow.sources.progress import latest_from_progress, progress_metrics, progress_offsets, progress_samples

# Commit-protocol files of a plain parquet table are not data files.
PARQUET_TABLE_IGNORE = r"^(_SUCCESS|\..*\.crc)$"


def commits_of(listing: DataFrame, table: str) -> DataFrame:
    """Timeline names for what the folders of a table show: each batch is a delta commit, each version of the base a commit."""
    path = F.col("path")
    batch, version = (F.regexp_extract(path, f"/{part}=([0-9]+)/", 1) for part in ("changes/batch_id", "base/_version"))
    name = F.when(batch != "", F.concat(batch, F.lit(".deltacommit"))).when(version != "", F.concat(version, F.lit(".commit")))
    return (listing.select(name.alias("name"), "mtime").filter("name is not null").groupBy("name").agg(F.max("mtime").alias("mtime"))
            .select(F.concat(F.lit(table.rstrip("/") + "/_timeline/"), "name").alias("path"), F.lit(0).cast("bigint").alias("size"), "mtime"))


def scrape(spark: SparkSession, table: str, checkpoint: str | None, progress: str | None,
           topic: str | None, now=None, status: DataFrame | None = None, scrapes: DataFrame | None = None,
           app: str = "app", query: str = "query", list_by_tasks: bool = False) -> DataFrame:
    """One sample of each metric whose input is given: the table's folder (M-10..19), progress records and
    checkpoint (M-1..6), a status table (ts, component, state) (M-7..9), a scrape log (ts, errors, duration_s) (M-20..22)."""
    now = now if now is not None else F.current_timestamp()
    listing = L.list_files_by_tasks(spark, table) if list_by_tasks else L.list_files(spark, table)
    listing = listing.unionByName(commits_of(listing, fs.qualify(spark, table)))
    parts = M.table_metrics(now, listing, fs.qualify(spark, table), "_timeline", PARQUET_TABLE_IGNORE,
                            age_from_mtime=True)
    if progress:
        # The newest trigger, at its own time: what the batch-overrun rule watches.
        batches = progress_metrics(spark.read.text(progress))
        newest = batches.agg(F.max_by(F.struct(*batches.columns), "batch_id").alias("b")).select("b.*")
        parts.append(progress_samples(newest, app, query))
    if progress and topic:
        latest = latest_from_progress(progress_offsets(spark.read.text(progress))).filter(F.col("topic") == topic)
        consumed = O.checkpoint_offsets(O.read_checkpoint_files(spark, checkpoint), topic) if checkpoint else None
        parts += M.offset_metrics(now, latest, consumed)
    if status is not None:
        parts += M.status_metrics(now, status)
    if scrapes is not None:
        parts.append(M.scrape_samples(now, scrapes))
    return M.union_all(parts)


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description=__doc__.split("\n")[0])
    p.add_argument("--table", required=True)
    p.add_argument("--samples", required=True, help="folder the samples are appended to")
    p.add_argument("--checkpoint", default=None)
    p.add_argument("--progress", default=None, help="folder of progress JSON lines")
    p.add_argument("--topic", default=None)
    p.add_argument("--list-by-tasks", action="store_true", help="list a large table's folders in tasks")
    p.add_argument("--status", default=None, help="parquet folder of observed component states")
    p.add_argument("--scrapes", default=None, help="parquet folder of the scrape log")
    a = p.parse_args(argv)
    spark = prepare(SparkSession.builder.appName("changeflow-metrics").getOrCreate())
    samples = scrape(spark, a.table, a.checkpoint, a.progress, a.topic,
                     status=spark.read.parquet(a.status) if a.status else None, scrapes=spark.read.parquet(a.scrapes) if a.scrapes else None,
                     list_by_tasks=a.list_by_tasks)
    samples.withColumn("date", F.to_date("ts")).write.mode("append").partitionBy("date").parquet(a.samples)


if __name__ == "__main__":
    main()

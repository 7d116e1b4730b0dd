"""Run the change-apply stream as a job.

    python -m changeflow.streaming.job --table s3a://lake/shipments \\
        --checkpoint s3a://lake/checkpoints/shipments --dlq s3a://lake/dlq \\
        --source-format kafka --source shipments.shipments_db.shipments \\
        --bootstrap-servers broker:29092

The session comes from ``spark-submit`` (master, resources, shared
checkpoint folder); the job pins UTC and AQE, starts one query and blocks
until it ends. Stopping the query (or the driver) is safe at any point: every
batch is replayed idempotently from the checkpoint.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from changeflow.operators.table import TableSpec
from changeflow.session import prepare
from changeflow.sources.messages import MessageSource, read_messages
from changeflow.streaming.apply import Outputs, finish_apply, start_apply


def parse_args(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(description=__doc__.split("\n")[0])
    p.add_argument("--table", required=True, help="table root folder")
    p.add_argument("--checkpoint", required=True, help="streaming checkpoint folder")
    p.add_argument("--dlq", required=True, help="dead-letter folder (or topic with --dlq-format kafka)")
    p.add_argument("--dropped", default=None, help="folder for dropped (delete / unflagged) rows")
    p.add_argument("--source", required=True, help="topic, or folder of message files")
    p.add_argument("--source-format", default="kafka")
    p.add_argument("--bootstrap-servers", default=None)
    p.add_argument("--max-per-trigger", type=int, default=2_000_000, help="offsets in a batch, for a broker")
    p.add_argument("--max-files-per-trigger", type=int, default=None, help="files in a batch, for a folder")
    p.add_argument("--progress", default=None, help="folder that the query's progress records are appended to")
    p.add_argument("--trigger", default="30 seconds")
    p.add_argument("--available-now", action="store_true", help="process what is there, then stop")
    p.add_argument("--key-scope", choices=["partition", "global"], default="partition")
    p.add_argument("--deletes", choices=["ignore", "apply"], default="ignore")
    p.add_argument("--tombstones", choices=["dead_letter", "skip"], default="dead_letter")
    p.add_argument("--compact-every", type=int, default=2)
    p.add_argument("--compaction", choices=["inline", "async", "off"], default="inline")
    p.add_argument("--retain-commits", type=int, default=2)
    p.add_argument("--dlq-format", default="parquet")
    return p.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    a = parse_args(argv)
    spark = prepare(SparkSession.builder.appName("changeflow-apply").getOrCreate())
    source = MessageSource(a.source, format=a.source_format, bootstrap_servers=a.bootstrap_servers,
                           max_per_trigger=a.max_per_trigger, max_files_per_trigger=a.max_files_per_trigger)
    spec = TableSpec(root=a.table, key_scope=a.key_scope, deletes=a.deletes, min_deltas=a.compact_every)
    outputs = Outputs(a.dlq, a.dropped, dlq_format=a.dlq_format,
                      dlq_topic=a.dlq if a.dlq_format == "kafka" else None,
                      bootstrap_servers=a.bootstrap_servers, tombstones=a.tombstones,
                      retain_commits=a.retain_commits, compaction=a.compaction)
    query = start_apply(read_messages(spark, source), spec, a.checkpoint, outputs,
                        trigger=a.trigger, available_now=a.available_now, name="changeflow-apply", progress=a.progress)
    finish_apply(query)


if __name__ == "__main__":
    main()

"""Streaming, snapshot-diff, data-quality and seed queries with oracles."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from changeflow.operators import table as tbl
from changeflow.operators.latest import precombine
from changeflow.operators.quality import apply_defaults, violations
from changeflow.operators.routing import project_rows, route
from changeflow.operators.table import TableSpec
from changeflow.plans.cdc import _BUILT, _LOCK, BUCKETS, EV, LAKE, _latest, _with, lake_rows, messages, out_cols
from changeflow.schemas import STATUS_VALUES
from changeflow.session import scratch_dir
from changeflow.sources import fs
from changeflow.sources.diff import snapshot_diff, snapshot_diff_by_digest
from changeflow.sources.fixtures import NUM_BATCHES, read_table
from changeflow.sources.messages import MessageSource, parse_messages, read_messages
from changeflow.sources.unknown import unknown_fields, with_unknown
from changeflow.streaming.apply import Outputs, finish_apply, start_apply

FILES_PER_BATCH = 4  # replay files of one batch, at least
MESSAGES_PER_FILE = 20_000


def files_per_batch(n_messages: int) -> int:
    """So many replay files that a trigger has tasks for its messages."""
    return max(FILES_PER_BATCH, -(-n_messages // NUM_BATCHES // MESSAGES_PER_FILE))


def write_message_files(spark: SparkSession, sf_dir: str, root: str, batches: list[int],
                        n_files: int = FILES_PER_BATCH) -> int:
    """Replay files of the change log: ``n_files`` parquet files per fixture
    batch, written in parallel and given modification times in batch order,
    so a file source with ``maxFilesPerTrigger = n_files`` reads one fixture
    batch per trigger. Returns ``n_files``."""
    msgs = messages(spark, sf_dir)
    for b in batches:
        stage = f"{root}/_stage/{b}"
        msgs.filter(F.col("b") == b).drop("b", "cls").repartition(n_files).write.mode("overwrite").parquet(stage)
        parts = sorted(n for n, _, _, d in fs.list_dir(spark, stage) if n.startswith("part-") and not d)
        for i, part in enumerate(parts):
            dst = f"{root}/src/{b:05d}-{i:05d}.parquet"
            fs.rename(spark, f"{stage}/{part}", dst)
            fs.set_mtime(spark, dst, 1_700_000_000_000 + b * 1_000_000 + i)
    return n_files


def run_stream(spark: SparkSession, root: str, spec: TableSpec, files_per_trigger: int,
               compaction: str = "inline") -> None:
    src = read_messages(spark, MessageSource(f"{root}/src", format="parquet", max_files_per_trigger=files_per_trigger))
    # All deltas stay: queries read them by batch.
    q = start_apply(src, spec, f"{root}/checkpoint",
                    Outputs(f"{root}/dlq", f"{root}/dropped", compaction=compaction, retain_commits=None), available_now=True)
    finish_apply(q)


def streamed(spark: SparkSession, sf_dir: str, variant: str) -> tuple[str, TableSpec]:
    key = (spark.sparkContext.applicationId, sf_dir, "stream", variant)
    with _LOCK:
        if key in _BUILT:
            return _BUILT[key]
    root = scratch_dir(spark, f"stream-{variant}")
    spec = TableSpec(root=f"{root}/table", num_buckets=BUCKETS)
    n = files_per_batch(messages(spark, sf_dir).count())
    if variant == "restart":
        write_message_files(spark, sf_dir, root, list(range(5)), n)
        run_stream(spark, root, spec, n)
        write_message_files(spark, sf_dir, root, list(range(5, NUM_BATCHES)), n)
        run_stream(spark, root, spec, n)
    else:
        write_message_files(spark, sf_dir, root, list(range(NUM_BATCHES)), n)
        run_stream(spark, root, spec, 2 * n if variant == "rate" else n)
    with _LOCK:
        _BUILT[key] = (root, spec)
    return root, spec


def q_stream_good_sink(spark, sf_dir):
    _, spec = streamed(spark, sf_dir, "one")
    return out_cols(tbl.snapshot_view(spark, spec))


def q_stream_dlq_sink(spark, sf_dir):
    root, _ = streamed(spark, sf_dir, "one")
    dlq = spark.read.schema("key string, value string, batch_id bigint").parquet(f"{root}/dlq")
    return dlq.select("key", F.col("value").isNull().alias("value_null"))


def q_stream_rate_limited(spark, sf_dir):
    _, spec = streamed(spark, sf_dir, "rate")
    return tbl.kept_rows(spark, spec, "changes").groupBy("batch_id").agg(F.count(F.lit(1)).alias("n_rows"))


OFFSETS_PER_TRIGGER = 3_000


def q_stream_offset_ranges(spark, sf_dir):
    """The change log as a table of messages, read by offset ranges of a limited length."""
    key = (spark.sparkContext.applicationId, sf_dir, "stream", "offsets")
    with _LOCK:
        spec = _BUILT.get(key)
    if spec is None:
        root = scratch_dir(spark, "stream-offsets")
        spec = TableSpec(root=f"{root}/table", num_buckets=BUCKETS)
        # In the order of the offsets, so that a range of them is a few row groups of a few files.
        place = ["topic", "partition", "offset"]
        (messages(spark, sf_dir).drop("b", "cls").repartitionByRange(*place).sortWithinPartitions(*place)
         .write.partitionBy("topic", "partition").parquet(f"{root}/messages"))
        limit = max(OFFSETS_PER_TRIGGER, messages(spark, sf_dir).count() // 4)
        source = MessageSource(f"{root}/messages", format="message_table", max_per_trigger=limit, checkpoint=f"{root}/checkpoint")
        q = start_apply(read_messages(spark, source), spec, f"{root}/checkpoint", Outputs(f"{root}/dlq", retain_commits=None), trigger="0 seconds")
        q.processAllAvailable()
        q.stop()
        finish_apply(q)
        with _LOCK:
            _BUILT[key] = spec
    return out_cols(tbl.snapshot_view(spark, spec))


def q_stream_restart(spark, sf_dir):
    _, spec = streamed(spark, sf_dir, "restart")
    return out_cols(tbl.snapshot_view(spark, spec))


def q_stream_dropped(spark, sf_dir):
    root, _ = streamed(spark, sf_dir, "one")
    return spark.read.parquet(f"{root}/dropped").select("partition", "offset", "tracking_id", "reason")


def _orders_pair(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    before = o.filter(F.col("o_orderkey") % 7 != 0)
    after = o.filter(F.col("o_orderkey") % 11 != 0).withColumn(
        "o_orderstatus", F.when(F.col("o_orderkey") % 5 == 0, F.lit("X")).otherwise(F.col("o_orderstatus")))
    return before, after


def q_snapshot_diff(spark, sf_dir):
    before, after = _orders_pair(spark, sf_dir)
    d = snapshot_diff(before, after, "o_orderkey")
    return d.select("o_orderkey", "op", "o_orderstatus_before", "o_orderstatus_after")


def q_snapshot_diff_counts(spark, sf_dir):
    before, after = _orders_pair(spark, sf_dir)
    return snapshot_diff(before, after, "o_orderkey").groupBy("op").agg(F.count(F.lit(1)).alias("n"))


def q_snapshot_diff_digest(spark, sf_dir):
    """A handful of changed orders, found by comparing digests of key ranges first."""
    o = read_table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    after = o.filter(k % 701 != 0).withColumn("o_orderstatus", F.when(k % 503 == 0, F.lit("X")).otherwise(F.col("o_orderstatus")))
    d = snapshot_diff_by_digest(o, after, "o_orderkey")
    return d.select("o_orderkey", "op", "o_orderstatus_before", "o_orderstatus_after")


def q_cdc_unknown_columns(spark, sf_dir):
    """From the fifth batch on messages carry two more fields; the table has them as columns."""
    key = (spark.sparkContext.applicationId, sf_dir, "unknown")
    with _LOCK:
        spec = _BUILT.get(key)
    if spec is None:
        spec = TableSpec(root=scratch_dir(spark, "table-unknown"), num_buckets=BUCKETS, min_deltas=4)
        n = F.col("offset")
        more = F.concat(F.lit('"payload":{"carrier":"C-'), (n % 7).cast("string"), F.lit('","pieces":'), (n % 50).cast("string"), F.lit(","))
        for b in range(NUM_BATCHES):
            msgs = messages(spark, sf_dir).filter(F.col("b") == b)
            if b >= 5:
                msgs = msgs.withColumn("value", F.replace(F.col("value").cast("string"), F.lit('"payload":{'), more).cast("binary"))
            parsed = parse_messages(msgs)
            found = [tuple(r) for r in unknown_fields(parsed).collect()]  # names and types of columns
            good = with_unknown(route(parsed).filter(F.col("route") == "good"), found)
            tbl.apply_changes(spark, spec, tbl.change_batch(project_rows(good, extra=[f for f, _ in found])), b)
        with _LOCK:
            _BUILT[key] = spec
    return out_cols(tbl.snapshot_view(spark, spec), "carrier", "pieces")


def q_dq_constraints(spark, sf_dir):
    rows = lake_rows(spark, sf_dir).drop("b")
    snap = precombine(rows, ["dt", "tracking_id"], ["ts", "kafka_partition", "kafka_offset"])
    i = F.col("id")
    snap = snap.withColumns({  # rows that break the rules which the change log keeps
        "customer_city": F.when(i % 17 != 0, F.col("customer_city")),
        "shipper_name": F.when(i % 19 == 0, F.repeat("shipper_name", 20)).otherwise(F.col("shipper_name")),
        "weight_kg": F.when(i % 23 == 0, F.concat("weight_kg", F.lit("5"))).otherwise(F.col("weight_kg"))})
    return violations(snap, "id").groupBy("rule", "column").agg(F.count(F.lit(1)).alias("n_violations"))


SEED_NOW = "2024-02-01 09:30:00"


def q_cdc_seed(spark, sf_dir):
    """One new shipment per customer, with the source defaults applied."""
    c = read_table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    statuses = F.array(*[F.lit(s) for s in STATUS_VALUES])
    now = F.lit(SEED_NOW).cast("timestamp")
    rows = c.select(
        k.alias("id"),
        F.concat(F.lit("SHP-"), (k + 10000).cast("string")).alias("tracking_id"),
        F.when(k % 3 == 0, F.lit(None).cast("string")).otherwise(F.get(statuses, (k % 7).cast("int"))).alias("status"),
        F.date_add(F.to_date(now), (k % 5).cast("int")).alias("estimated_delivery"),
    )
    out = apply_defaults(rows, now)
    return out.select("id", "tracking_id", "status", F.date_format("estimated_delivery", "yyyy-MM-dd").alias("estimated_delivery"),
                      F.unix_seconds("created_at").alias("created_s"), F.unix_seconds("updated_at").alias("updated_s"))


QUERIES = {
    "stream_good_sink": q_stream_good_sink,
    "stream_dlq_sink": q_stream_dlq_sink,
    "stream_dropped_sink": q_stream_dropped,
    "stream_rate_limited": q_stream_rate_limited,
    "stream_restart": q_stream_restart,
    "stream_offset_ranges": q_stream_offset_ranges,
    "snapshot_diff": q_snapshot_diff,
    "snapshot_diff_counts": q_snapshot_diff_counts,
    "snapshot_diff_digest": q_snapshot_diff_digest,
    "cdc_unknown_columns": q_cdc_unknown_columns,
    "dq_constraints": q_dq_constraints,
    "cdc_seed": q_cdc_seed,
}

STATES_SQL = ", ".join(f"'{x}'" for x in STATUS_VALUES)
DIFF = """b AS (SELECT * FROM orders WHERE o_orderkey % 7 <> 0),
a AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 5 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
             o_totalprice, o_orderdate, o_orderpriority FROM orders WHERE o_orderkey % 11 <> 0),
d AS (SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey,
             CASE WHEN b.o_orderkey IS NULL THEN 'c' WHEN a.o_orderkey IS NULL THEN 'd'
                  WHEN a.o_orderstatus IS DISTINCT FROM b.o_orderstatus OR a.o_custkey IS DISTINCT FROM b.o_custkey
                    OR a.o_totalprice IS DISTINCT FROM b.o_totalprice OR a.o_orderdate IS DISTINCT FROM b.o_orderdate
                    OR a.o_orderpriority IS DISTINCT FROM b.o_orderpriority THEN 'u' END AS op,
             b.o_orderstatus AS o_orderstatus_before, a.o_orderstatus AS o_orderstatus_after
      FROM b FULL OUTER JOIN a ON a.o_orderkey = b.o_orderkey)"""

ORACLE = {
    "stream_good_sink": _with(EV, LAKE) + _latest("cls = 'good'", "dt, tracking_id"),
    "stream_offset_ranges": _with(EV, LAKE) + _latest("cls = 'good'", "dt, tracking_id"),
    "stream_restart": _with(EV, LAKE) + _latest("cls = 'good'", "dt, tracking_id"),
    "stream_dlq_sink": _with(EV) + "SELECT k AS key, cls = 'tombstone' AS value_null FROM ev WHERE cls IN ('tombstone', 'malformed', 'nokey')",
    "stream_dropped_sink": _with(EV) + """SELECT part AS partition, event_id AS offset, k AS tracking_id, cls AS reason
FROM ev WHERE cls IN ('delete', 'unflagged')""",
    "stream_rate_limited": _with(EV, LAKE) + """SELECT CAST(b // 2 AS BIGINT) AS batch_id, count(DISTINCT (dt, tracking_id)) AS n_rows
FROM lake WHERE cls = 'good' GROUP BY b // 2""",
    "snapshot_diff": "WITH " + DIFF + "\nSELECT * FROM d WHERE op IS NOT NULL",
    "snapshot_diff_counts": "WITH " + DIFF + "\nSELECT op, count(*) AS n FROM d WHERE op IS NOT NULL GROUP BY op",
    "snapshot_diff_digest": """SELECT o_orderkey, CASE WHEN o_orderkey % 701 = 0 THEN 'd' ELSE 'u' END AS op, o_orderstatus AS o_orderstatus_before,
       CASE WHEN o_orderkey % 701 <> 0 THEN 'X' END AS o_orderstatus_after FROM orders WHERE o_orderkey % 701 = 0 OR o_orderkey % 503 = 0""",
    "cdc_unknown_columns": _with(EV, LAKE) + f"""SELECT * EXCLUDE (b, kafka_offset), CASE WHEN b >= 5 THEN 'C-' || (kafka_offset % 7) END AS carrier,
       CASE WHEN b >= 5 THEN kafka_offset % 50 END AS pieces FROM ({_latest("cls = 'good'", 'dt, tracking_id').replace('SELECT ', 'SELECT b, kafka_offset, ', 1)})""",
    "dq_constraints": _with(EV, LAKE, f"latest AS ({_latest("cls = 'good'", 'dt, tracking_id')})") + f"""
SELECT 'not_null' AS rule, 'customer_city' AS column, count(*) AS n_violations FROM latest WHERE id % 17 = 0
UNION ALL SELECT 'max_length', 'shipper_name', count(*) FROM latest WHERE id % 19 = 0
UNION ALL SELECT 'decimal', 'weight_kg', count(*) FROM latest WHERE id % 23 = 0
UNION ALL SELECT 'domain' AS rule, 'status' AS column, count(*) AS n_violations
FROM ({_latest("cls = 'good'", 'dt, tracking_id')}) WHERE status NOT IN
  ({STATES_SQL})
UNION ALL
SELECT 'unique', 'tracking_id', count(*) FROM ({_latest("cls = 'good'", 'dt, tracking_id')}) x
WHERE tracking_id IN (SELECT tracking_id FROM ({_latest("cls = 'good'", 'dt, tracking_id')}) GROUP BY 1 HAVING count(*) > 1)""",
    "cdc_seed": f"""SELECT c_custkey AS id, 'SHP-' || CAST(c_custkey + 10000 AS VARCHAR) AS tracking_id,
       CASE WHEN c_custkey % 3 = 0 THEN 'PICKED_UP'
            ELSE ([{STATES_SQL}])[c_custkey % 7 + 1] END AS status,
       strftime(DATE '2024-02-01' + CAST(c_custkey % 5 AS INTEGER), '%Y-%m-%d') AS estimated_delivery,
       CAST(epoch(TIMESTAMP '2024-02-01 09:30:00') AS BIGINT) AS created_s,
       CAST(epoch(TIMESTAMP '2024-02-01 09:30:00') AS BIGINT) AS updated_s
FROM customer""",
}

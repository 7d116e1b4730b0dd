"""Constraint report, defaults, snapshot diff, envelope, reject branches."""

from pyspark.sql import functions as F

from changeflow.operators.quality import Constraint, apply_defaults, violations
from changeflow.operators.table import TableSpec
from changeflow.schemas import ROW_COLUMNS
from changeflow.sources.diff import snapshot_diff
from changeflow.sources.envelope import encode_envelope
from changeflow.sources.messages import parse_messages
from changeflow.streaming.apply import routed_branches


def test_violations(spark):
    df = spark.createDataFrame([
        (1, "SHP-1", "AT_HUB", "2.50", "x" * 5),
        (2, "SHP-1", "LOST", "12345.00", None),
        (3, None, None, "1.234", "y" * 101),
    ], "id int, tracking_id string, status string, weight_kg string, current_location string")
    rules = [Constraint("not_null", "tracking_id"), Constraint("not_null", "status"), Constraint("unique", "tracking_id"),
             Constraint("domain", "status", ("AT_HUB", "DELIVERED")), Constraint("max_length", "current_location", 100),
             Constraint("decimal", "weight_kg", (6, 2))]
    got = sorted((r["row_key"], r["rule"], r["column"]) for r in violations(df, "id", rules).collect())
    assert got == [(1, "unique", "tracking_id"), (2, "decimal", "weight_kg"), (2, "domain", "status"),
                   (2, "unique", "tracking_id"), (3, "decimal", "weight_kg"), (3, "max_length", "current_location"),
                   (3, "not_null", "status"), (3, "not_null", "tracking_id")]


def test_defaults(spark):
    df = spark.createDataFrame([("A", None), ("B", "DELIVERED")], "tracking_id string, status string")
    out = {r["tracking_id"]: r["status"] for r in apply_defaults(df, F.current_timestamp()).collect()}
    assert out == {"A": "PICKED_UP", "B": "DELIVERED"}


def test_snapshot_diff_null_safe(spark):
    before = spark.createDataFrame([(1, "a"), (2, None), (3, "c"), (4, None)], "k int, v string")
    after = spark.createDataFrame([(1, "a"), (2, None), (3, "x"), (5, "n")], "k int, v string")
    got = sorted((r["k"], r["op"]) for r in snapshot_diff(before, after, "k").collect())
    assert got == [(3, "u"), (4, "d"), (5, "c")]


def test_envelope_roundtrip_and_tombstones(spark):
    rows = spark.createDataFrame([(1, "SHP-1", "true", 10, 0), (2, "SHP-2", "false", 12, 0)],
                                 "id bigint, tracking_id string, __deleted string, offset bigint, partition int") \
        .withColumn("timestamp", F.current_timestamp())
    msgs = encode_envelope(rows, key="tracking_id", payload_cols=["id", "tracking_id", "__deleted"], topic="t",
                           tombstones=True)
    assert msgs.count() == 3
    tomb = msgs.filter(F.col("value").isNull()).first()
    assert (tomb["offset"], tomb["key"]) == (11, bytearray(b"SHP-1"))
    parsed = parse_messages(msgs).filter(F.col("json_str").isNotNull())
    got = sorted((r["id"], r["tracking_id"]) for r in parsed.select("parsed.payload.*").collect())
    assert got == [(1, "SHP-1"), (2, "SHP-2")]
    for c in ROW_COLUMNS:
        assert c in parse_messages(msgs).select("parsed.payload.*").columns


def test_tombstones_skip(spark):
    msgs = spark.createDataFrame([(b"k", None, "t", 0, 1, None), (b"k", b"junk", "t", 0, 2, None)],
                                 "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp")
    spec = TableSpec(root="unused")
    _, _, dead_keep, _ = routed_branches(msgs, spec, "dead_letter")
    _, _, dead_skip, _ = routed_branches(msgs, spec, "skip")
    assert dead_keep.count() == 2
    assert [r["value"] for r in dead_skip.collect()] == ["junk"]

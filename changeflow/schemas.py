"""The data contract: message, change event, lake row, listing, samples."""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed values of the change-event contract: payload field names and types as
# the change producer emits them (new row state plus three change fields).
PAYLOAD_FIELDS = [
    ("id", T.LongType()),
    ("tracking_id", T.StringType()),
    ("shipper_name", T.StringType()),
    ("shipper_city", T.StringType()),
    ("customer_name", T.StringType()),
    ("customer_city", T.StringType()),
    ("weight_kg", T.StringType()),
    ("status", T.StringType()),
    ("current_location", T.StringType()),
    ("estimated_delivery", T.IntegerType()),
    ("__deleted", T.StringType()),
    ("__op", T.StringType()),
    ("__source_ts_ms", T.LongType()),
]

PAYLOAD_SCHEMA = T.StructType([T.StructField(n, t, True) for n, t in PAYLOAD_FIELDS])
ENVELOPE_SCHEMA = T.StructType([T.StructField("payload", PAYLOAD_SCHEMA, True)])

# Row-state columns of the source table that travel in the payload.
ROW_COLUMNS = [n for n, _ in PAYLOAD_FIELDS if not n.startswith("__")]

MESSAGE_SCHEMA = T.StructType([
    T.StructField("key", T.BinaryType(), True),
    T.StructField("value", T.BinaryType(), True),
    T.StructField("topic", T.StringType(), True),
    T.StructField("partition", T.IntegerType(), True),
    T.StructField("offset", T.LongType(), True),
    T.StructField("timestamp", T.TimestampType(), True),
])

# The 13 lake columns, in order.
LAKE_COLUMNS = ROW_COLUMNS + ["cdc_operation", "ts", "dt"]

RECORD_KEY = "tracking_id"
PARTITION_FIELD = "dt"
ORDERING_FIELD = "ts"
NUM_BUCKETS = 16

# Position columns kept next to a lake row so that ties on ``ts`` resolve the
# same way in every batch and at compaction: larger (partition, offset) wins.
POSITION_COLUMNS = ["kafka_partition", "kafka_offset"]

LISTING_SCHEMA = T.StructType([
    T.StructField("path", T.StringType(), True),
    T.StructField("size", T.LongType(), True),
    T.StructField("mtime", T.TimestampType(), True),
])

SAMPLE_SCHEMA = T.StructType([
    T.StructField("ts", T.TimestampType(), True),
    T.StructField("metric", T.StringType(), True),
    T.StructField("labels", T.MapType(T.StringType(), T.StringType()), True),
    T.StructField("value", T.DoubleType(), True),
])

# Source-table constraints (re-aimed as a data-quality report).
# The seven shipment states, in declaration order.
STATUS_VALUES = [
    "PICKED_UP",
    "IN_TRANSIT",
    "AT_HUB",
    "OUT_FOR_DELIVERY",
    "DELIVERED",
    "RETURNED",
    "FAILED_DELIVERY",
]
DEFAULT_STATUS = "PICKED_UP"

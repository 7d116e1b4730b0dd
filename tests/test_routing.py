"""Route truth table on literal messages, and route totality."""

from pyspark.sql import functions as F

from changeflow.operators.routing import dead_letters, project_rows, route
from changeflow.sources.messages import parse_messages

GOOD = '{"payload":{"id":1,"tracking_id":"SHP-1","status":"AT_HUB","__deleted":"false","__op":"u","__source_ts_ms":1704067200123}}'
CASES = [
    ("tombstone", None, "dead", "null_value"),
    ("empty", "", "dead", "empty_value"),
    ("malformed", '{"payload": {"id": 1', "dead", "no_payload"),
    ("non_json", "hello", "dead", "no_payload"),
    ("json_null", "null", "dead", None),
    ("array", "[1,2]", "dead", None),
    ("no_payload", '{"other": 1}', "dead", "no_payload"),
    ("payload_null", '{"payload": null}', "dead", "no_payload"),
    ("unwrapped", '{"id":1,"tracking_id":"SHP-1"}', "dead", "no_payload"),
    ("nokey", '{"payload":{"id":1,"__deleted":"false"}}', "dead", "no_key"),
    ("delete_str", '{"payload":{"tracking_id":"SHP-1","__deleted":"true"}}', "dropped", "delete"),
    ("delete_bool", '{"payload":{"tracking_id":"SHP-1","__deleted":true}}', "dropped", "delete"),
    ("unflagged", '{"payload":{"tracking_id":"SHP-1"}}', "dropped", "unflagged"),
    ("good", GOOD, "good", "ok"),
    ("wrong_type", '{"payload":{"id":"abc","tracking_id":"SHP-1","__deleted":"false"}}', "good", "ok"),
    ("overflow", '{"payload":{"id":99999999999999999999999,"tracking_id":"SHP-1","__deleted":"false"}}', "good", "ok"),
    ("empty_key", '{"payload":{"tracking_id":"","__deleted":"false"}}', "good", "ok"),
    ("extra_field", '{"payload":{"tracking_id":"SHP-1","__deleted":"false","new_col":5}}', "good", "ok"),
]


def _msgs(spark):
    rows = [(name.encode(), None if v is None else v.encode(), "t", 0, i, None) for i, (name, v, _, _) in enumerate(CASES)]
    return spark.createDataFrame(rows, "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp")


def test_truth_table(spark):
    out = {r["kafka_key"]: (r["route"], r["reason"]) for r in route(parse_messages(_msgs(spark))).collect()}
    for name, _, want_route, want_reason in CASES:
        got_route, got_reason = out[name]
        assert got_route == want_route, name
        if want_reason is not None:
            assert got_reason == want_reason, name


def test_routes_disjoint_and_total(spark):
    r = route(parse_messages(_msgs(spark)))
    assert r.filter(F.col("route").isNull()).count() == 0
    assert r.count() == len(CASES)


def test_wrong_typed_field_is_null(spark):
    r = route(parse_messages(_msgs(spark))).filter(F.col("kafka_key") == "wrong_type")
    assert r.select("parsed.payload.id").first()[0] is None


def test_project_rows(spark):
    r = route(parse_messages(_msgs(spark))).filter(F.col("kafka_key") == "good")
    row = project_rows(r).first()
    assert row["dt"] == "2024-01-01"
    assert row["cdc_operation"] == "u"
    assert row["ts"].microsecond == 123000
    assert project_rows(r).columns[:13] == [
        "id", "tracking_id", "shipper_name", "shipper_city", "customer_name", "customer_city", "weight_kg",
        "status", "current_location", "estimated_delivery", "cdc_operation", "ts", "dt"]


def test_dead_letters_keep_original_text(spark):
    dl = {r["key"]: r["value"] for r in dead_letters(route(parse_messages(_msgs(spark)))).collect()}
    assert dl["tombstone"] is None
    assert dl["malformed"] == '{"payload": {"id": 1'


def test_json_parsed_once_in_plan(spark):
    """Route predicates must not be pushed below the parse (one from_json)."""
    from changeflow.plans import cdc

    df = cdc.lake_rows(spark, "/root/testdata/sf0.001", batch=3)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 1
    # The batch filter prunes to one folder.
    assert "PartitionFilters: [isnotnull(b" in plan

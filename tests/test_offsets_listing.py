"""Checkpoint offsets, lag, timeline and file listing rules."""

import datetime as dt

from pyspark.sql import functions as F

from changeflow.sources import listing as L
from changeflow.sources import offsets as O

TOPIC = "t"
META = '{"batchWatermarkMs":0}'


def _files(spark, rows):
    return spark.createDataFrame(rows, "file_name string, text string")


def test_newest_numeric_file_wins(spark):
    files = _files(spark, [
        ("9", f'v1\n{META}\n{{"t":{{"0":5}}}}'),
        ("10", f'v1\n{META}\n{{"t":{{"0":7,"1":3}},"other":{{"0":1}}}}\n'),
        ("zzz", f'v1\n{META}\n{{"t":{{"0":99}}}}'),
    ])
    got = sorted((r["batch_id"], r["partition"], r["offset"]) for r in O.checkpoint_offsets(files, TOPIC).collect())
    assert got == [(10, "0", 7), (10, "1", 3)]


def test_short_newest_file_gives_nothing(spark):
    files = _files(spark, [("3", f'v1\n{META}\n{{"t":{{"0":5}}}}'), ("4", 'v1\n{"t":{"0":6}}')])
    assert O.checkpoint_offsets(files, TOPIC).count() == 0


def test_lag_left_join(spark):
    consumed = spark.createDataFrame([(1, TOPIC, "0", 5), (1, TOPIC, "1", 9), (1, TOPIC, "7", 4)],
                                     "batch_id bigint, topic string, partition string, offset bigint")
    latest = spark.createDataFrame([(TOPIC, 0, 8), (TOPIC, 1, 9), (TOPIC, 2, 100)], "topic string, partition int, latest_offset bigint")
    lag = {r["partition"]: r["lag"] for r in O.consumer_lag(consumed, latest).collect()}
    assert lag == {"0": 3, "1": 0, "7": 0}
    assert O.lag_total(O.consumer_lag(consumed, latest)).first()["lag_total"] == 3


def _listing(spark, paths):
    now = dt.datetime(2024, 1, 1)
    return spark.createDataFrame([(p, s, now) for p, s in paths], "path string, size bigint, mtime timestamp")


def test_timeline_rules(spark):
    tl = "tbl/.hoodie/"
    lst = _listing(spark, [(tl + n, 0) for n in [
        "20240101000000000.deltacommit", "20240101000000000.deltacommit.inflight",
        "20240101010000000.deltacommit.requested", "20240101010000000.deltacommit.inflight",
        "20240101020000000.commit", "20240101030000000.clean", "hoodie.properties", "archived/x.commit",
        "20240101040000000.compaction.requested", "20240101040000000.rollback", "noext"]])
    t = L.parse_timeline(lst, "tbl/.hoodie")
    counts = L.timeline_counts(t).first()
    assert (counts["deltacommit_count"], counts["commit_count"], counts["clean_count"]) == (1, 1, 1)
    inflight = {r["instant"] for r in L.timeline_instants(t).filter("truly_inflight").collect()}
    assert inflight == {"20240101010000000"}
    age = L.commit_age(t, F.lit(dt.datetime(2024, 1, 1, 2, 10, 0)).cast("timestamp")).first()
    assert age["commit_age_seconds"] == 600


def test_commit_age_none(spark):
    t = L.parse_timeline(_listing(spark, [("tbl/.hoodie/1.clean", 0)]), "tbl/.hoodie")
    assert L.commit_age(t, F.current_timestamp()).first()["commit_age_seconds"] == -1


def test_file_classes(spark):
    lst = _listing(spark, [
        ("tbl/dt=1/fgA_1-0-0_20240101.parquet", 10), ("tbl/dt=1/.fgB_2024.log.1_0-1", 5),
        ("tbl/dt=1/.hoodie_partition_metadata", 1), ("tbl/.hoodie/1.commit", 1),
        ("tbl/dt=1/README", 2), ("tbl/dt=1/.x.crc", 3), ("tbl/dt=1/fgA_2-0-0_20240102.parquet", 10)])
    files = L.classify_files(lst, "tbl")
    inv = L.file_inventory(files).first()
    assert (inv["data_files_total"], inv["base_files_total"], inv["log_files_total"], inv["table_size_bytes"]) == (5, 2, 2, 30)
    assert L.file_groups(files).first()["file_groups_total"] == 2
    assert L.file_groups(files, approx_rsd=0.05).first()["file_groups_total"] == 2


def test_list_files_sees_hidden(spark, tmp_table):
    import os
    os.makedirs(f"{tmp_table}/.hoodie", exist_ok=True)
    for n in (".hoodie/1.commit", ".hidden.log.1", "_x", "a.parquet"):
        with open(f"{tmp_table}/{n}", "w") as fh:
            fh.write("x")
    assert L.list_files(spark, tmp_table).count() == 4

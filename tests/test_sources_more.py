"""Digest-first snapshot comparison, fields that the schema doesn't know, mergeable distinct counts, samples of one second."""

import datetime as dt
import random

from pyspark.sql import functions as F

from changeflow.functions import series as S
from changeflow.operators import sketches as SK
from changeflow.sources import diff
from changeflow.sources.unknown import unknown_fields, with_unknown


def test_digest_diff_equals_plain_diff(spark):
    rng = random.Random(2)
    schema = "k long, j string, a int, b int, c double"
    rows = [(i, rng.choice("xy"), rng.choice([None, 1, 2]), rng.choice([None, 1, 2]), rng.choice([None, 0.5, float("nan")])) for i in range(3000)]
    changed = []
    for r in rows:
        if r[0] % 997 == 0:
            continue  # deleted
        changed.append((*r[:2], r[3], r[2], r[4]) if r[0] % 501 == 0 else r)  # a and b swapped: nulls move
    changed += [(5000 + i, "n", None, None, None) for i in range(3)]
    before, after = spark.createDataFrame(rows, schema), spark.createDataFrame(changed, schema)
    want = diff.snapshot_diff(before, after, ["k", "j"])
    got = diff.snapshot_diff_by_digest(before, after, ["k", "j"], ranges=512)
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and want.count() >= 8
    assert diff.snapshot_diff_by_digest(before, before, ["k", "j"]).count() == 0
    assert diff.snapshot_diff_by_digest(before.limit(0), after, ["k", "j"]).count() == len(changed)


def test_digest_diff_moves_changed_ranges_only(spark):
    """Rows that reach the row-by-row join are those of ranges that differ."""
    before = spark.range(20_000).select("id", (F.col("id") * 3).alias("v"))
    after = before.withColumn("v", F.when(F.col("id") == 77, F.lit(0)).otherwise(F.col("v")))
    got = diff.snapshot_diff_by_digest(before, after, "id", ranges=1000)
    assert [r["op"] for r in got.collect()] == ["u"]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan
    digests = diff.range_digests(before, ["id"], ["v"], 1000).exceptAll(diff.range_digests(after, ["id"], ["v"], 1000))
    assert digests.count() == 1


def test_unknown_fields_and_their_types(spark):
    known = '"tracking_id":"A","__deleted":"false"'
    texts = [f'{{"payload":{{{known},"pieces":1,"ratio":1,"carrier":"x","tags":{{"a":1}},"none":null}}}}', f'{{"payload":{{{known},"pieces":2,"ratio":2.5,"it\'s":true}}}}',
             f'{{"payload":{{{known}}}}}', '{"payload":null}', '{"payload":[1]}', "not json {", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "offset int, json_str string")
    found = {r["field"]: r["type"] for r in unknown_fields(df).collect()}
    assert found == {"pieces": "BIGINT", "ratio": "DOUBLE", "carrier": "STRING", "tags": "STRING", "it's": "BOOLEAN"}
    got = {r["offset"]: r for r in with_unknown(df, sorted(found.items())).collect()}
    assert got[0]["pieces"] == 1 and got[0]["carrier"] == "x" and got[0]["tags"] == '{"a":1}' and (got[0]["ratio"], got[1]["ratio"]) == (1.0, 2.5) and got[1]["it's"] is True
    assert all(got[i]["pieces"] is None for i in (2, 3, 4, 5, 6))
    assert unknown_fields(df.limit(0)).count() == 0


def test_sketches_merge_to_the_distinct_count(spark):
    rows = spark.range(4000).select((F.col("id") % 48).alias("hour"), F.concat(F.lit("g"), F.col("id") % 900).alias("g")).unionByName(
        spark.createDataFrame([(0, None), (99, None)], "hour long, g string"))
    hourly = SK.sketches(rows, ["hour"], F.col("g")).cache()
    exact = {d: rows.filter(F.floor(F.col("hour") / 24) == d).agg(F.countDistinct("g")).first()[0] for d in (0, 1, 4)}
    got = {r["day"]: r["n"] for r in SK.distinct_over(hourly.withColumn("day", F.floor(F.col("hour") / 24)), ["day"], "n").collect()}
    assert got == exact
    two = SK.distinct_in_windows(hourly, "hour", F.array(F.lit(47)), 48).collect()
    assert [(r["end"], r["n_distinct"]) for r in two] == [(47, 900)]


def test_two_samples_in_one_second(spark):
    at = lambda s, us=0: dt.datetime(2024, 1, 1, 0, 0, s, us)
    rows = [(at(0), 1.0), (at(10, 1), 9.0), (at(10, 5), 5.0), (at(20), 12.0)]
    results = set()
    for seed in range(4):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame([(t, "m", {}, v) for t, v in rows], "ts timestamp, metric string, labels map<string,string>, value double").repartition(3)
        got = sorted((r["t"] % 86400, r["increase"], r["rate"]) for r in S.increase(df, 15).collect())
        grid = sorted((r["t"] % 86400, r["increase"]) for r in S.range_at_grid(df, 15, 5).collect())
        results.add((str(got), str(grid)))
    assert len(results) == 1  # in any order of the input
    # By value within the second: 1, 5, 9, then 12.
    assert [x for x in got if x[0] == 20] == [(20, 7.0, 0.7)] and [x[1] for x in got if x[0] == 10] == [8.0, 8.0]
    alone = spark.createDataFrame([(at(1, 1), "m", {}, 1.0), (at(1, 2), "m", {}, 2.0)], "ts timestamp, metric string, labels map<string,string>, value double")
    assert {(r["increase"], r["rate"]) for r in S.increase(alone, 15).collect()} == {(1.0, None)}


def test_listing_by_tasks_equals_the_listing(spark):
    from changeflow.session import scratch_dir
    from changeflow.sources import listing as L

    root = scratch_dir(spark, "tree")
    spark.range(40).select("id", (F.col("id") % 5).alias("a"), (F.col("id") % 3).alias("b c")).write.partitionBy("a", "b c").parquet(f"{root}/t")
    want = sorted(map(tuple, L.list_files(spark, root).select("path", "size", F.unix_seconds("mtime")).collect()))
    got = sorted(map(tuple, L.list_files_by_tasks(spark, root, folders_per_task=2).select("path", "size", F.unix_seconds("mtime")).collect()))
    # Spark's local file system keeps its checksum files to itself; as files with hidden names they are listed here.
    assert [r for r in got if not r[0].endswith(".crc")] == want and any("/." in p for p, _, _ in got) and any(p.endswith("_SUCCESS") for p, _, _ in got)
    assert L.list_files_by_tasks(spark, f"{root}/missing").count() == 0

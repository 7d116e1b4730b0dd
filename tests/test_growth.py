"""Work that grows with the input and no faster: what plans, windows, tasks and readers hold."""

import io
from contextlib import redirect_stdout

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from changeflow.functions import series as S
from changeflow.operators import alerts as A
from changeflow.operators import table as tbl
from changeflow.operators.table import TableSpec
from changeflow.plans import streams
from changeflow.sources.message_table import message_table
from changeflow.sources.messages import MESSAGE_SCHEMA
from changeflow.streaming.apply import routed_branches


def _plan(df):
    with redirect_stdout(io.StringIO()) as out:
        df.explain(True)
    return out.getvalue()


def _samples(spark, rows):
    return spark.createDataFrame(rows, "t long, metric string, series string, value double").withColumn("ts", F.timestamp_seconds("t"))


def test_ranges_are_no_sliding_frames(spark):
    """a grid point costs the same however many samples its ranges hold."""
    samples = _samples(spark, [(t, "m", "s", float(t % 7)) for t in range(0, 400)])
    grid = S.grid_points(samples, 30, 60, [(120, "counter"), (300, "gauge")])
    assert "RangeFrame, -" not in _plan(grid)
    got = {r["t"]: r for r in grid.collect()}
    at = S.range_at_grid(samples, 120, 30).filter("t < 400").collect()
    assert at and all(got[r["t"]][S.inc_name(120, "counter")] == r["increase"] for r in at)
    # A range that a metric isn't asked for has no marks there.
    other = S.grid_points(samples, 30, 60, [(120, "counter")], asked={120: F.col("metric") == "other"}).collect()
    assert {r[S.inc_name(120, "counter")] for r in other} == {None} and [r["value"] for r in other if r["t"] == 30] == [2.0]


def test_a_window_looks_back_for_open_runs_only(spark, monkeypatch):
    """the time before a window is read once, for the rules whose runs are still open."""
    rules = [A.Rule("Long", "warning", "c", 60, A.Term(A.Value("long"), ">", 0)), A.Rule("Short", "warning", "c", 60, A.Term(A.Value("short"), ">", 0))]
    rows = [(t, "long", "s", 1.0 if t >= 9_000 else 0.0) for t in range(0, 40_000, 15)]
    rows += [(t, "short", "s", 1.0 if t % 3_000 < 600 else 0.0) for t in range(0, 40_000, 15)]
    rows += [(t, "long", None, 1.0) for t in range(30_000, 40_000, 15)]  # series without a name
    samples = _samples(spark, rows).cache()
    asked, plain = [], A.conditions

    def seen(rows, some, *args):
        span = rows.agg(F.min("t"), F.max("t")).first()
        asked.append((tuple(r.name for r in some), *span))
        return plain(rows, some, *args)

    monkeypatch.setattr(A, "conditions", seen)
    got = A.evaluate(samples, rules, start="1970-01-01 10:50:00", end="1970-01-01 11:00:00")
    (_, lead, *more) = asked  # the window's own rows, the evaluations just before it, further back
    assert lead[0] == ("Long", "Short") and lead[2] <= 39_000 and more and {a[0] for a in more} == {("Long",)}
    reach = A.longest_reach(rules)
    for (_, low, _), (_, _, high) in zip(asked[1:], more):
        assert high <= low + reach  # beside one another
    want = A.evaluate(samples, rules).filter((F.col("t") >= 39_000) & (F.col("t") <= 39_600))
    key = ("alert", "metric", "series", "t", "value", "active_since", "state")
    rows_of = lambda df: sorted((tuple(r) for r in df.select(*key).collect()), key=str)
    assert rows_of(want) and rows_of(got) == rows_of(want)


def _changes(spark, b, n=40):
    rows = [(f"K{k}", f"s{b}", 1_700_000_000 + b, f"2024-01-0{1 + k % 3}", 0, b * 100 + k) for k in range(n)]
    df = spark.createDataFrame(rows, "tracking_id string, status string, at long, dt string, kafka_partition int, kafka_offset long")
    return df.select("tracking_id", "status", F.timestamp_seconds("at").alias("ts"), "dt", "kafka_partition", "kafka_offset")


def test_folding_has_more_tasks_than_buckets(spark, tmp_table, monkeypatch):
    """F2, F5, F7, F8, F9: batches are written by as many tasks as they take, cells are dealt by day too."""
    spec, plans, plain = TableSpec(root=tmp_table, num_buckets=2, min_deltas=2), {}, tbl._insert

    def seen(rows, table, *args):
        plans[table.rsplit("_", 1)[1]] = _plan(rows).split("== Physical Plan ==")[1]
        plain(rows, table, *args)

    monkeypatch.setattr(tbl, "_insert", seen)
    for b in range(2):
        tbl.apply_changes(spark, spec, _changes(spark, b), b)
    assert "hashpartitioning(tracking_id" not in plans["changes"]
    assert "hashpartitioning(dt" in plans["base"] and plans["base"].count("Exchange") == 1
    view = tbl.snapshot_view(spark, spec)
    assert view.count() == 40 and view.filter("status = 's1'").count() == 40
    files = spark.read.parquet(f"{tmp_table}/base").select("dt", "_bucket", F.input_file_name().alias("file")).distinct()
    assert {r["count"] for r in files.groupBy("dt", "_bucket").count().collect()} == {1}


def test_replay_files_and_kept_texts(spark):
    """a trigger has tasks for its messages, and keeps the texts of dead letters only."""
    assert streams.files_per_batch(100) == 4 and streams.files_per_batch(36_000_000) == 180
    good = b'{"payload":{"id":1,"tracking_id":"K","__deleted":"false","__op":"c","__source_ts_ms":1}}'
    msgs = spark.createDataFrame([(b"k", good, "t", 0, 0, None), (b"k", b"bad", "t", 0, 1, None)], MESSAGE_SCHEMA)
    routed, _, dead, _ = routed_branches(msgs, TableSpec(root="unused"))
    assert sorted(((r["route"], r["json_str"]) for r in routed.collect())) == [("dead", "bad"), ("good", None)]
    assert [tuple(r) for r in dead.collect()] == [("k", "bad")]


def test_a_range_is_read_in_small_batches(tmp_path):
    """a task holds some thousand messages, whatever a file's row groups hold."""
    folder = tmp_path / "topic=t" / "partition=1"
    folder.mkdir(parents=True)
    n = 30_000
    rows = pa.table({"key": [b"k"] * n, "value": [str(i).encode() for i in range(n)], "offset": pa.array(range(n), pa.int64()),
                     "timestamp": pa.array([0] * n, pa.timestamp("us", "UTC"))})
    pq.write_table(rows, folder / "part-0.parquet", row_group_size=15_000)
    reader = message_table()({"path": str(tmp_path)}).streamReader(None)
    (task,) = reader.partitions({}, {"t": {"1": 20_000}})
    got = list(reader.read(task))
    assert max(b.num_rows for b in got) <= 4_096
    assert [x for b in got for x in b.column("offset").to_pylist()] == list(range(20_000))
    assert got[0].column("topic")[0].as_py() == "t" and got[0].column("partition")[0].as_py() == 1


def test_language_scores_are_read_once(spark, monkeypatch):
    """op3_lang_id: the evidence tables are made of counts, not of the scores again and again."""
    from changeflow.llm import lang_id

    kept, plain = {}, lang_id.staged

    def seen(df, name):
        kept[name] = plain(df, name)
        return kept[name]

    monkeypatch.setattr(lang_id, "staged", seen)
    docs = spark.createDataFrame([("the cat sat on the mat and slept", "en", "a.example.com")] * 8 + [("der Hund und die Katze schlafen hier", "de", "b.example.de")] * 8,
                                 "text string, lang string, source string")
    got = lang_id.identify(docs, "text", F.col("lang"), F.col("source"))
    assert {(r["lang"], r["detected"]) for r in got.collect()} == {("en", "en"), ("de", "de")}
    assert sorted((r["host"], r["docs"]) for r in kept["counts"].collect()) == [("a.example.com", 8.0), ("b.example.de", 8.0)]

"""Merge-on-read table: upsert, views, compaction, replay, deletes, key scope, expiry, schema."""

import datetime as dt

from pyspark.sql import functions as F

from changeflow.operators import table as tbl
from changeflow.operators.table import TableSpec

COLS = "tracking_id string, status string, ts timestamp, dt string, kafka_partition int, kafka_offset bigint"


def _t(day, s=0):
    return dt.datetime(2024, 1, day, 0, 0, s)


def _batch(spark, rows, deletes=()):
    df = spark.createDataFrame(rows, COLS)
    d = spark.createDataFrame(list(deletes), COLS) if deletes else None
    return tbl.change_batch(df, d)


def _rows(view):
    return sorted(((r["dt"], r["tracking_id"], r["status"]) for r in view.collect()),
                  key=lambda x: tuple("" if v is None else v for v in x))


def test_upsert_and_views(spark, tmp_table):
    spec = TableSpec(root=tmp_table, min_deltas=2)
    tbl.apply_changes(spark, spec, _batch(spark, [("A", "s1", _t(1), "2024-01-01", 0, 1),
                                                  ("B", "s1", _t(1), "2024-01-01", 0, 2)]), 0)
    assert _rows(tbl.snapshot_view(spark, spec)) == [("2024-01-01", "A", "s1"), ("2024-01-01", "B", "s1")]
    assert tbl.read_optimized_view(spark, spec).count() == 0  # nothing compacted yet
    # Batch 1: A newer, B older (late) -> B keeps s1.
    tbl.apply_changes(spark, spec, _batch(spark, [("A", "s2", _t(1, 5), "2024-01-01", 0, 3),
                                                  ("B", "late", _t(1, 0), "2024-01-01", 0, 0)]), 1)
    assert tbl.read_state(spark, spec).version == 1  # compacted after two batches
    snap = _rows(tbl.snapshot_view(spark, spec))
    assert snap == [("2024-01-01", "A", "s2"), ("2024-01-01", "B", "s1")]
    assert _rows(tbl.read_optimized_view(spark, spec)) == snap  # right after compaction
    # Batch 2 only visible in the snapshot.
    tbl.apply_changes(spark, spec, _batch(spark, [("C", "s1", _t(2), "2024-01-02", 0, 4)]), 2)
    assert len(_rows(tbl.snapshot_view(spark, spec))) == 3
    assert len(_rows(tbl.read_optimized_view(spark, spec))) == 2
    # Time travel to batch 0.
    assert _rows(tbl.snapshot_view(spark, spec, as_of_batch=0)) == [("2024-01-01", "A", "s1"), ("2024-01-01", "B", "s1")]


def test_replay_is_noop(spark, tmp_table):
    spec = TableSpec(root=tmp_table, min_deltas=0, num_buckets=2)
    b0 = _batch(spark, [("A", "s1", _t(1), "2024-01-01", 0, 1)])
    b1 = _batch(spark, [("A", "s2", _t(1, 9), "2024-01-01", 0, 2)])
    tbl.apply_changes(spark, spec, b0, 0)
    tbl.apply_changes(spark, spec, b1, 1)
    before = _rows(tbl.snapshot_view(spark, spec))
    tbl.apply_changes(spark, spec, b0, 0)
    assert _rows(tbl.snapshot_view(spark, spec)) == before


def test_deletes_apply_keeps_marker(spark, tmp_table):
    spec = TableSpec(root=tmp_table, deletes="apply", min_deltas=2)
    tbl.apply_changes(spark, spec, _batch(spark, [("A", "s1", _t(1), "2024-01-01", 0, 1)]), 0)
    tbl.apply_changes(spark, spec, _batch(spark, [], deletes=[("A", "s1", _t(1, 9), "2024-01-01", 0, 2)]), 1)
    assert tbl.snapshot_view(spark, spec).count() == 0
    # An older late update must not resurrect the deleted key.
    tbl.apply_changes(spark, spec, _batch(spark, [("A", "old", _t(1, 3), "2024-01-01", 0, 0)]), 2)
    tbl.compact(spark, spec)
    assert tbl.snapshot_view(spark, spec).count() == 0


def test_deletes_ignored_by_default(spark, tmp_table):
    spec = TableSpec(root=tmp_table)
    tbl.apply_changes(spark, spec, _batch(spark, [("A", "s1", _t(1), "2024-01-01", 0, 1)],
                                          deletes=[("A", "s1", _t(1, 9), "2024-01-01", 0, 2)]), 0)
    assert tbl.snapshot_view(spark, spec).count() == 1


def test_global_scope_moves_key(spark, tmp_table):
    spec = TableSpec(root=tmp_table, key_scope="global", min_deltas=1)
    tbl.apply_changes(spark, spec, _batch(spark, [("A", "s1", _t(1), "2024-01-01", 0, 1),
                                                  ("B", "s1", _t(1), "2024-01-01", 0, 2)]), 0)
    tbl.apply_changes(spark, spec, _batch(spark, [("A", "s2", _t(2), "2024-01-02", 0, 3)]), 1)
    want = [("2024-01-01", "B", "s1"), ("2024-01-02", "A", "s2")]
    assert _rows(tbl.snapshot_view(spark, spec)) == want
    assert _rows(tbl.read_optimized_view(spark, spec)) == want


def test_partition_scope_keeps_key_per_day(spark, tmp_table):
    spec = TableSpec(root=tmp_table)
    tbl.apply_changes(spark, spec, _batch(spark, [("A", "s1", _t(1), "2024-01-01", 0, 1),
                                                  ("A", "s2", _t(2), "2024-01-02", 0, 2)]), 0)
    assert len(_rows(tbl.snapshot_view(spark, spec))) == 2


def test_expire_and_clean(spark, tmp_table):
    spec = TableSpec(root=tmp_table, min_deltas=1)
    for b in range(4):
        tbl.apply_changes(spark, spec, _batch(spark, [("A", f"s{b}", _t(1, b), "2024-01-01", 0, b)]), b)
    exp = tbl.expired_versions(spark, spec, retain=2)
    kinds = sorted((r["kind"], r["version"]) for r in exp.collect())
    assert kinds == [("base", 0), ("base", 1), ("delta", 0), ("delta", 1), ("delta", 2)]
    snap = _rows(tbl.snapshot_view(spark, spec))
    tbl.clean(spark, spec, retain=2, dry_run=False)
    assert _rows(tbl.snapshot_view(spark, spec)) == snap


def test_schema_reconcile(spark, tmp_table):
    spec = TableSpec(root=tmp_table, min_deltas=2)
    tbl.apply_changes(spark, spec, _batch(spark, [("A", "s1", _t(1), "2024-01-01", 0, 1)]), 0)
    b = _batch(spark, [("B", "s1", _t(1), "2024-01-01", 0, 2)]).withColumn("extra", F.lit("x"))
    tbl.apply_changes(spark, spec, b, 1)
    got = {r["tracking_id"]: r["extra"] for r in tbl.snapshot_view(spark, spec).collect()}
    assert got == {"A": None, "B": "x"}


def test_changed_type_is_refused_before_publishing(spark, tmp_table):
    import pytest

    spec = TableSpec(root=tmp_table)
    row = [("A", "s1", _t(1), "2024-01-01", 0, 1)]
    tbl.apply_changes(spark, spec, _batch(spark, row).withColumn("extra", F.lit(1)), 0)
    with pytest.raises(ValueError, match="extra: int -> string"):
        tbl.apply_changes(spark, spec, _batch(spark, row).withColumn("extra", F.lit("x")), 1)
    assert tbl.read_state(spark, spec).pending == [0]
    assert tbl.snapshot_view(spark, spec).first()["extra"] == 1


def test_async_clean_beside_a_writer(spark, tmp_table):
    """Maintenance on another thread while batches are written: nothing is lost."""
    import threading

    spec = TableSpec(root=tmp_table, min_deltas=0, num_buckets=2)
    stop, failed = threading.Event(), []

    def maintain():
        while not stop.is_set():
            try:
                tbl.compact(spark, spec)
                tbl.clean(spark, spec, retain=1, dry_run=False)
            except Exception as e:  # noqa: BLE001
                failed.append(e)
                return

    tbl.apply_changes(spark, spec, _batch(spark, [("K0", "s", _t(1), "2024-01-01", 0, 0)]), 0)
    t = threading.Thread(target=maintain)
    t.start()
    for b in range(1, 10):
        tbl.apply_changes(spark, spec, _batch(spark, [(f"K{b}", "s", _t(1, b), f"2024-01-0{1 + b % 3}", 0, b)]), b)
    stop.set()
    t.join()
    assert not failed
    assert sorted(r[1] for r in _rows(tbl.snapshot_view(spark, spec))) == [f"K{b}" for b in range(10)]


def test_partition_filter_prunes(spark, tmp_table):
    spec = TableSpec(root=tmp_table, min_deltas=1)
    tbl.apply_changes(spark, spec, _batch(spark, [("A", "s1", _t(1), "2024-01-01", 0, 1),
                                                  ("B", "s1", _t(2), "2024-01-02", 0, 2)]), 0)
    view = tbl.read_optimized_view(spark, spec).filter(F.col("dt") == "2024-01-02")
    plan = view._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "2024-01-02" in plan
    assert view.count() == 1


def test_empty_batch_and_null_ts(spark, tmp_table):
    spec = TableSpec(root=tmp_table, min_deltas=2)
    tbl.apply_changes(spark, spec, _batch(spark, [("A", "s1", _t(1), "2024-01-01", 0, 1),
                                                  ("N", "nots", None, None, 0, 2)]), 0)
    tbl.apply_changes(spark, spec, _batch(spark, []), 1)  # empty batch, triggers compaction
    assert tbl.read_state(spark, spec).version == 1
    got = _rows(tbl.snapshot_view(spark, spec))
    assert ("2024-01-01", "A", "s1") in got
    assert any(r[1] == "N" and r[0] is None for r in got)
    assert _rows(tbl.read_optimized_view(spark, spec)) == got
    # A later row for N with a time wins over the null-time row (null sorts first).
    tbl.apply_changes(spark, spec, _batch(spark, [("N", "timed", _t(2), "2024-01-02", 0, 0)]), 2)
    assert ("2024-01-02", "N", "timed") in _rows(tbl.snapshot_view(spark, spec))


def test_fold_order_independent_on_change_log(spark, tmp_table):
    """Any batch order (with compactions in between) gives the one-shot result."""
    from changeflow.operators.latest import precombine
    from changeflow.plans import cdc

    sf = "/root/testdata/sf0.001"
    spec = TableSpec(root=tmp_table, min_deltas=3)
    # Batch ids increase with arrival (as in a stream); the data arrives shuffled.
    for i, b in enumerate([7, 2, 9, 0, 5, 1, 8, 3, 6, 4]):
        tbl.apply_changes(spark, spec, tbl.change_batch(cdc.lake_rows(spark, sf, b).drop("b")), i)
    one_shot = precombine(cdc.lake_rows(spark, sf).drop("b"), ["dt", "tracking_id"],
                          ["ts", "kafka_partition", "kafka_offset"])
    cols = ["dt", "tracking_id", "status", "kafka_offset"]
    got = sorted(tuple(r) for r in tbl.snapshot_view(spark, spec).select(*cols).collect())
    assert got == sorted(tuple(r) for r in one_shot.select(*cols).collect())
    assert len(got) == 383


def test_global_scope_moves_key_out_of_null_partition(spark, tmp_table):
    spec = TableSpec(root=tmp_table, key_scope="global", min_deltas=1)
    tbl.apply_changes(spark, spec, _batch(spark, [("A", "nots", None, None, 0, 1)]), 0)
    tbl.apply_changes(spark, spec, _batch(spark, [("A", "timed", _t(2), "2024-01-02", 0, 2)]), 1)
    assert _rows(tbl.read_optimized_view(spark, spec)) == [("2024-01-02", "A", "timed")]
    assert _rows(tbl.snapshot_view(spark, spec)) == [("2024-01-02", "A", "timed")]


def test_replay_after_clean_changes_nothing(spark, tmp_table):
    spec = TableSpec(root=tmp_table, min_deltas=1)
    batches = [_batch(spark, [("A", f"s{b}", _t(1, b), "2024-01-01", 0, b)]) for b in range(6)]
    for b, rows in enumerate(batches):
        tbl.apply_changes(spark, spec, rows, b)
    tbl.clean(spark, spec, retain=1, dry_run=False)
    before = _rows(tbl.snapshot_view(spark, spec))
    for b in (5, 0, 3):
        tbl.apply_changes(spark, spec, batches[b], b)
    assert _rows(tbl.snapshot_view(spark, spec)) == before
    state = tbl.read_state(spark, spec)
    assert state.pending == [] and len(state.cells) == 1


def test_published_batch_is_not_written_again(spark, tmp_table):
    from changeflow.sources import fs

    spec = TableSpec(root=tmp_table, min_deltas=0, num_buckets=2)
    rows = _batch(spark, [("A", "s1", _t(1), "2024-01-01", 0, 1)])
    tbl.apply_changes(spark, spec, rows, 0)
    files = sorted(fs.list_files_recursive(spark, f"{tmp_table}/changes"))
    tbl.apply_changes(spark, spec, rows, 0)
    assert sorted(fs.list_files_recursive(spark, f"{tmp_table}/changes")) == files


def test_a_late_batch_id_is_folded_in(spark, tmp_table):
    spec = TableSpec(root=tmp_table, min_deltas=1)
    tbl.apply_changes(spark, spec, _batch(spark, [("A", "s1", _t(1), "2024-01-01", 0, 1)]), 5)
    tbl.apply_changes(spark, spec, _batch(spark, [("B", "s1", _t(1), "2024-01-01", 0, 2), ("A", "s0", _t(1), "2024-01-01", 0, 0)]), 3)
    want = [("2024-01-01", "A", "s1"), ("2024-01-01", "B", "s1")]
    assert _rows(tbl.snapshot_view(spark, spec)) == want == _rows(tbl.read_optimized_view(spark, spec))


def test_clean_bounds_what_is_kept(spark, tmp_table):
    spec = TableSpec(root=tmp_table, min_deltas=1)
    days = ["2024-01-01", "2024-01-02", "2024-01-03"]
    for b in range(8):
        d = days[b % 3] if b < 6 else days[0]
        tbl.apply_changes(spark, spec, _batch(spark, [(f"K{b % 4}", f"s{b}", _t(1 + b % 3, b), d, 0, b)]), b)
    before = _rows(tbl.snapshot_view(spark, spec))
    tbl.clean(spark, spec, retain=2, dry_run=False)
    assert {r["version"] for r in tbl.kept_folders(spark, spec).filter("kind = 'delta'").collect()} == {7}
    assert _rows(tbl.snapshot_view(spark, spec)) == before == _rows(tbl.read_optimized_view(spark, spec))
    tbl.apply_changes(spark, spec, _batch(spark, [("K9", "new", _t(3, 59), days[2], 0, 99)]), 8)
    tbl.clean(spark, spec, retain=1, dry_run=False)
    assert len(_rows(tbl.snapshot_view(spark, spec))) == len(before) + 1
    # Nothing is left but what the catalog names.
    live = {(v, p, b) for v, p, b in tbl.read_state(spark, spec).cells}
    assert {(r["version"], r["dt"], r["bucket"]) for r in tbl.kept_folders(spark, spec).filter("kind = 'base'").collect()} == live


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _many(spark, b, days=3, keys=40):
    return _batch(spark, [(f"K{k}", f"s{b}", _t(1 + k % days, b), f"2024-01-0{1 + k % days}", 0, b * 100 + k) for k in range(keys)])


def test_merge_moves_neither_base_nor_changes(spark, tmp_table):
    """The newest rows come without an exchange, and a key's lookup reads one bucket of sixteen."""
    spec = TableSpec(root=tmp_table, min_deltas=2)
    for b in range(3):
        tbl.apply_changes(spark, spec, _many(spark, b), b)
    view = tbl.snapshot_view(spark, spec)
    assert "Exchange" not in _plan(view)
    one = view.filter(F.col("tracking_id") == "K7")
    assert _plan(one).count("SelectedBucketsCount: 1 out of 16") == 2
    assert [(r["dt"], r["status"]) for r in one.collect()] == [("2024-01-02", "s2")]
    base, changes = spark.table(spec.table("base")), spark.table(spec.table("changes"))
    merged = tbl.precombine(tbl._both(spark, spec, base.filter(tbl._in_cells(spec, {("2024-01-01", 3)})), changes), spec.merge_keys, spec.order)
    plan = _plan(merged)
    assert "Exchange" not in plan and "PartitionFilters: [(concat_ws" in plan


def test_compaction_rewrites_changed_cells_only(spark, tmp_table):
    spec = TableSpec(root=tmp_table, min_deltas=1)
    tbl.apply_changes(spark, spec, _many(spark, 0), 0)
    before = set(tbl.read_state(spark, spec).cells)
    tbl.apply_changes(spark, spec, _batch(spark, [("K7", "new", _t(2, 50), "2024-01-02", 0, 999)]), 1)
    after = set(tbl.read_state(spark, spec).cells)
    assert len(before - after) == len(after - before) == 1
    ((v, day, bucket),) = after - before
    assert (v, day) == (1, "2024-01-02") and (0, day, bucket) in before
    assert spark.table(spec.table("base")).filter("tracking_id = 'K7'").select("_bucket").first()[0] == bucket


def test_key_index_names_the_cells_that_hold_a_key(spark):
    from changeflow.operators.key_index import build_index, probe_index

    rows = spark.range(60_000).select(F.concat(F.lit("k"), "id").alias("key"), (F.col("id") % 40).cast("int").alias("day"))
    rows = rows.withColumn("b", F.pmod(F.hash("key"), F.lit(2))).unionByName(spark.createDataFrame([(None, 1, 0)], "key string, day int, b int"))
    # One large cell among small ones.
    rows = rows.withColumn("day", F.when(F.col("day") < 20, F.lit(0)).otherwise(F.col("day"))).cache()
    index = build_index(rows, "key", ["day", "b"]).cache()
    assert index.agg(F.max("lanes"), F.min("lanes")).first()[:] == (8, 1)
    some = rows.filter("key in ('k21', 'k5', 'k39')")
    got = {tuple(r) for r in probe_index(index, some, "key", ["day", "b"], "b").collect()}
    want = {(r["day"], r["b"]) for r in some.collect()}
    assert want <= got and len(got) <= len(want) + 3
    none = spark.range(300).select(F.concat(F.lit("new"), "id").alias("key")).withColumn("b", F.pmod(F.hash("key"), F.lit(2)))
    passed = sum(probe_index(index, none.filter(F.col("key") == f"new{i}"), "key", ["day", "b"], "b").count() for i in range(12))
    assert passed < 0.15 * 12 * 21  # 12 keys, 21 cells of a bucket


def test_global_scope_reads_cells_that_the_index_names(spark, tmp_table, monkeypatch):
    spec = TableSpec(root=tmp_table, min_deltas=1, key_scope="global", num_buckets=4)
    for b in range(3):
        tbl.apply_changes(spark, spec, _batch(spark, [(f"K{k}", "s", _t(1 + b), f"2024-01-0{1 + b}", 0, k) for k in range(b * 10, b * 10 + 10)]), b)
    asked = []
    real = tbl._in_cells
    monkeypatch.setattr(tbl, "_in_cells", lambda spec, cells: asked.append(set(cells)) or real(spec, cells))
    tbl.apply_changes(spark, spec, _batch(spark, [("K3", "moved", _t(9), "2024-01-09", 0, 1), ("fresh", "s", _t(9), "2024-01-09", 0, 2)]), 3)
    assert {p for p, _ in asked[0]} == {"2024-01-01"} and len(asked[0]) == 1
    got = _rows(tbl.read_optimized_view(spark, spec))
    assert ("2024-01-09", "K3", "moved") in got and len(got) == 31


def test_a_compaction_that_stops_leaves_right_views_and_can_be_run_again(spark, tmp_table, monkeypatch):
    import pytest

    for scope in ("partition", "global"):
        for fail_at in (0, 1):
            spec = TableSpec(root=f"{tmp_table}-{scope}-{fail_at}", min_deltas=0, key_scope=scope)
            tbl.apply_changes(spark, spec, _many(spark, 0), 0)
            tbl.compact(spark, spec)
            tbl.apply_changes(spark, spec, _batch(spark, [("K1", "moved", _t(3, 9), "2024-01-03", 0, 900), ("K2", "s9", _t(3, 9), "2024-01-03", 0, 901)]), 1)
            want = _rows(tbl.snapshot_view(spark, spec))
            calls = []

            def drop(*a, real=tbl._drop):
                if len(calls) == fail_at:
                    raise RuntimeError("stopped")
                calls.append(a)
                real(*a)

            with monkeypatch.context() as m:
                m.setattr(tbl, "_drop", drop)
                with pytest.raises(RuntimeError):
                    tbl.compact(spark, spec)
            assert _rows(tbl.snapshot_view(spark, spec)) == want == _rows(tbl.read_optimized_view(spark, spec))
            tbl.compact(spark, spec)
            tbl.apply_changes(spark, spec, _batch(spark, [("K1", "again", _t(3, 59), "2024-01-03", 0, 950)]), 2)
            tbl.compact(spark, spec)
            got = _rows(tbl.read_optimized_view(spark, spec))
            assert [r for r in got if r[1] == "K1" and r[0] == "2024-01-03"] == [("2024-01-03", "K1", "again")]
            assert len(got) == len(want)


def test_views_in_another_session_follow_commits(spark, tmp_table):
    spec = TableSpec(root=tmp_table, min_deltas=1)
    tbl.apply_changes(spark, spec, _batch(spark, [("A", "s0", _t(1), "2024-01-01", 0, 0)]), 0)
    tbl.register_table(spark, spec, "kept")
    other = spark.newSession()
    for b in range(1, 6):
        tbl.apply_changes(spark, spec, _batch(spark, [("A", f"s{b}", _t(1, b), "2024-01-01", 0, b)]), b)
        tbl.clean(spark, spec, retain=2, dry_run=False)
        assert other.sql("SELECT status FROM kept_rt").first()["status"] == f"s{b}"
    assert other.sql("SELECT status FROM kept_ro").first()["status"] == "s5"
    assert "Exchange" not in _plan(other.table("kept_rt"))
    # A column that is added reaches the views.
    tbl.apply_changes(spark, spec, _batch(spark, [("A", "s6", _t(1, 6), "2024-01-01", 0, 6)]).withColumn("extra", F.lit("x")), 6)
    assert spark.newSession().sql("SELECT extra FROM kept_rt").first()["extra"] == "x"


def test_folders_are_attached_where_the_catalog_is_lost(spark, tmp_table):
    for scope in ("partition", "global"):
        spec = TableSpec(root=f"{tmp_table}-{scope}", min_deltas=2, key_scope=scope)
        for b in range(3):
            tbl.apply_changes(spark, spec, _many(spark, b), b)
        before = _rows(tbl.snapshot_view(spark, spec))
        for kind in ("base", "changes", "keys"):
            spark.sql(f"DROP TABLE IF EXISTS {spec.table(kind)}")
        assert _rows(tbl.snapshot_view(spark, spec)) == before
        tbl.apply_changes(spark, spec, _many(spark, 3), 3)
        assert {r[2] for r in _rows(tbl.snapshot_view(spark, spec))} == {"s3"}

"""Alert rules and panels end to end on the scrape history of sf0.001."""

from pyspark.sql import functions as F

from changeflow.functions import series as S
from changeflow.operators import alerts as A
from changeflow.operators import panels as PN
from changeflow.sources import fixtures as FX

SF = "/root/testdata/sf0.001"


def _history(spark):
    return FX.scrape_history(FX.read_table(spark, SF, "events"))


def test_thirteen_rules():
    assert len(A.RULES) == 13
    assert len({r.name for r in A.RULES}) == 13


def test_evaluate_matches_brute_force_hold(spark):
    samples = _history(spark)
    rule = next(r for r in A.RULES if r.name == "PipelineStalled")
    one = samples.filter(F.col("labels")["pipeline"] == "7")
    cond = A.condition(one, rule).toPandas().sort_values("t")
    got = A.evaluate(one, [rule]).toPandas()
    # Brute force: walk the active grid points; a run breaks on a gap > step.
    want, start, prev = [], None, None
    for t in cond["t"]:
        if prev is None or t - prev > A.EVAL_STEP_S:
            start = t
        want.append((t, "firing" if t - start >= rule.hold_s else "pending"))
        prev = t
    assert sorted(zip(got["t"], got["state"])) == want
    assert (got["state"] == "firing").any()


def test_all_rules_run(spark):
    out = A.evaluate(_history(spark)).groupBy("alert").agg(F.count(F.lit(1)).alias("n")).collect()
    assert {r["alert"] for r in out} <= {r.name for r in A.RULES}
    assert len(out) >= 8


def test_threshold_status(spark):
    df = spark.createDataFrame([(0.0,), (90.0,), (299.0,), (300.0,), (None,)], "value double")
    got = [r[0] for r in df.select(PN.threshold_status(F.col("value"), "green", [(90, "yellow"), (300, "red")])).collect()]
    assert got == ["green", "yellow", "yellow", "red", None]


def test_every_panel_builds(spark):
    seen = {r["panel"] for r in PN.panels(_history(spark)).select("panel").distinct().collect()}
    assert seen == {p.pid for p in PN.PANELS} and len(PN.PANELS) == 18


def test_regex_selector_anchored(spark):
    s = spark.createDataFrame([("xmetrics_app_a_driver_spark_streaming_q_triggerExecution_Value",),
                               ("metrics_app_a_driver_spark_streaming_q_triggerExecution_Value",)], "metric string")
    assert S.select_metric(s, "metrics_app_.*_triggerExecution_Value").count() == 1


def _rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_windowed_evaluation_matches_full(spark):
    samples = _history(spark).cache()
    rules = [r for r in A.RULES if r.name in ("PipelineStalled", "ProducerConsumerRateDivergence", "CompactionLagging", "SparkBatchOverrun")]
    key = ["alert", "metric", "series", "t", "value", "active_since", "state"]
    lo, hi = "2024-01-20 00:00:00", "2024-01-20 23:45:10"
    full = A.evaluate(samples, rules)
    inside = full.filter(F.col("ts").between(F.lit(lo).cast("timestamp"), F.lit(hi).cast("timestamp")))
    want = _rows(inside, *key)
    assert want and _rows(A.evaluate(samples, rules, start=lo, end=hi), *key) == want
    samples.unpersist()


def _series(spark, values, metric="m", app="a"):
    rows = [(metric, {"app": app}, float(v), t) for t, v in values]
    df = spark.createDataFrame(rows, "metric string, labels map<string,string>, value double, t long")
    return df.select(F.timestamp_seconds("t").alias("ts"), "metric", "labels", "value")


def test_window_reads_a_long_range_and_finds_a_long_run(spark):
    """A range beyond every rule's, and a run that began long before the window."""
    samples = _series(spark, [(t, t) for t in range(0, 36_000, 60)])
    rule = A.Rule("Long", "warning", "x", 60, A.Term(A.Value("m", "increase", 1500), ">", 0))
    full = A.evaluate(samples, [rule])
    got = A.evaluate(samples, [rule], start="1970-01-01 08:00:00", end="1970-01-01 09:00:00")
    key = ["t", "value", "active_since", "state"]
    want = _rows(full.filter("t between 28800 and 32400"), *key)
    assert _rows(got, *key) == want and want[0] == (28800, 1440.0, 60, "firing")


def test_no_rows_after_the_end(spark):
    """The value changes right after the end; nothing of it, and no look-ahead, shows."""
    samples = _series(spark, [(0, 5), (1790, 5), (1801, 0)])
    rule = A.Rule("High", "warning", "x", 0, A.Term(A.Value("m"), ">", 1))
    got = A.evaluate(samples, [rule], start="1970-01-01 00:25:00", end="1970-01-01 00:30:00")
    assert _rows(got, "t") == [(1800,)]
    shown = PN.panels(samples, [PN.Panel(1, "x", (PN._line("m"),))], lookback_s=60, start="1970-01-01 00:25:00", end="1970-01-01 00:30:00")
    assert _rows(shown, "t", "value") == [(1800, 5.0)]


def test_regex_series_stay_apart(spark):
    """Two applications over the limit in turn: neither for long enough."""
    name = "metrics_app_{}_driver_spark_streaming_q_triggerExecution_Value"
    a = _series(spark, [(t, 70_000 if t // 60 % 2 else 0) for t in range(0, 1200, 30)] + [(1200, 0)], name.format("a"))
    b = _series(spark, [(t, 0 if t // 60 % 2 else 70_000) for t in range(0, 1200, 30)] + [(1200, 0)], name.format("b"))
    rule = next(r for r in A.RULES if r.name == "SparkBatchOverrun")
    assert A.evaluate(a.unionByName(b), [rule]).filter("state = 'firing'").count() == 0


def test_panel_lines_are_told_apart(spark):
    names = {pid: {r["metric"] for r in PN.panel(_history(spark), pid).select("metric").distinct().collect()} for pid in (30, 40, 50, 51)}
    assert names[30] == {"producer", "consumer"} and len(names[40]) == 2 and len(names[50]) == 3 and len(names[51]) == 2


def test_panel_window_matches_full(spark):
    samples = _history(spark).cache()
    specs = [p for p in PN.PANELS if p.pid in (13, 14, 22, 23)]
    lo, hi = "2024-01-20 00:00:00", "2024-01-22 00:00:00"
    for lookback in (300, 60):
        full = PN.panels(samples, specs, lookback_s=lookback).filter(F.col("ts").between(F.lit(lo).cast("timestamp"), F.lit(hi).cast("timestamp")))
        win = PN.panels(samples, specs, lookback_s=lookback, start=lo, end=hi)
        key = ["panel", "t", "metric", "series", "value"]
        want = _rows(full, *key)
        assert want and _rows(win, *key) == want
    samples.unpersist()


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_all_rules_scan_samples_few_times(spark, tmp_path):
    path = str(tmp_path / "samples")
    _history(spark).withColumn("date", F.to_date("ts")).write.partitionBy("date").parquet(path)
    samples = spark.read.parquet(path)
    out = A.evaluate(samples)
    assert _plan(out).count("Relation [") <= 4
    assert _plan(PN.panels(samples)).count("Relation [") <= 4
    win = A.evaluate(samples, start="2024-01-20 00:00:00", end="2024-01-20 01:00:00")
    plan = win._jdf.queryExecution().sparkPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan


def test_grid_points_matches_instant_and_range(spark):
    """The one-pass values equal the single-purpose functions, across chunk borders, with resets and gaps."""
    import random

    rng = random.Random(11)
    times = sorted(rng.sample(range(0, 4000), 120))
    samples = _series(spark, [(t, rng.randint(0, 50)) for t in times])
    for chunk in (500, 90, 86_400):
        grid = S.grid_points(samples, 30, 240, [(120, "counter"), (300, "gauge")], chunk_s=chunk)
        want = S.instant(samples, 30, 240, chunk_s=chunk)
        assert _rows(grid.filter("value is not null"), "t", "value") == _rows(want, "t", "value")
        for r, kind in ((120, "counter"), (300, "gauge")):
            inc, rate = S.inc_name(r, kind), S.rate_name(r, kind)
            got = grid.filter(F.col(inc).isNotNull()).select("t", F.round(inc, 6), F.round(rate, 6))
            want = S.range_at_grid(samples, r, 30, kind, chunk_s=chunk).select("t", F.round("increase", 6), F.round("rate", 6))
            assert _rows(got, *got.columns) == _rows(want, *want.columns)

"""The 13 alert rules as DataFrame jobs over metric samples (§2.13, WIN-3).

Rules are data: a name, severity, component, hold and one or two terms. A term
compares an instant value, an ``increase`` or a ``rate`` of a metric with a
limit. All rules are evaluated together: one pass computes the values of all
metrics on the grid, an explode gives the active (rule, series, time) rows, and
one pass over their union gives the states.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changeflow.functions import series as S
from changeflow.session import staged

EVAL_STEP_S = 30
LOOKBACK_S = 300
P = "pipeline_"
RUN = ["alert", "metric", "series"]  # what a run of a condition belongs to


@dataclass(frozen=True)
class Value:
    """A value of a metric at a grid time: ``instant``, or ``increase`` / ``rate`` over a range.

    ``kind="counter"`` treats drops as resets (the reference applies this to
    consumer lag, a gauge; SURVEY X13); ``kind="gauge"`` is the sound choice
    for gauges. A ``regex`` names several metrics, whose series stay apart.
    """

    metric: str
    fn: str = "instant"
    range_s: int = 0
    kind: str = "counter"
    regex: bool = False

    def column(self) -> Column:
        names = {"instant": "value", "increase": S.inc_name(self.range_s, self.kind), "rate": S.rate_name(self.range_s, self.kind)}
        return F.col(names[self.fn])

    def of(self, metric: Column) -> Column:
        return metric.rlike(f"^(?:{self.metric})$") if self.regex else metric == self.metric

    def reach(self, lookback_s: int) -> int:
        """Seconds after a sample during which it still gives this value."""
        return lookback_s if self.fn == "instant" else self.range_s - 1


@dataclass(frozen=True)
class Term:
    value: Value
    op: str
    limit: float

    def holds(self, x: Column) -> Column:
        ops = {">": x > self.limit, "<": x < self.limit, "==": x == self.limit, ">=": x >= self.limit, "<=": x <= self.limit, "!=": x != self.limit}
        return F.coalesce(ops[self.op], F.lit(False))


@dataclass(frozen=True)
class Rule:
    """``term`` must hold for ``hold_s`` seconds; with ``also``, on the series (or, ``on_time``, on any series) where that holds too."""

    name: str
    severity: str
    component: str
    hold_s: int
    term: Term
    also: Term | None = None
    on_time: bool = False


# The reference's 13 rules (name, severity, component, hold,
# condition and threshold), in file order.
RULES = [
    Rule("PipelineStalled", "critical", "spark", 120, Term(Value(P + "hudi_last_commit_age_seconds"), ">", 300)),
    Rule("DebeziumConnectorDown", "critical", "debezium", 60, Term(Value(P + "debezium_connector_running"), "==", 0)),
    Rule("DebeziumTaskFailed", "critical", "debezium", 60, Term(Value(P + "debezium_task_running"), "==", 0),
         Term(Value(P + "debezium_connector_running"), "==", 1)),
    Rule("MySQLUnreachable", "critical", "mysql", 60, Term(Value(P + "mysql_reachable"), "==", 0)),
    Rule("HudiInflightOpsStuck", "critical", "hudi", 300, Term(Value(P + "hudi_inflight_operations"), ">", 5)),
    Rule("ConsumerLagExploding", "critical", "spark", 120, Term(Value(P + "spark_consumer_lag_total"), ">", 10_000_000)),
    Rule("ConsumerLagGrowing", "warning", "spark", 180, Term(Value(P + "spark_consumer_lag_total"), ">", 1_000_000)),
    Rule("ProducerConsumerRateDivergence", "warning", "spark", 180, Term(Value(P + "spark_consumer_lag_total", "rate", 120), ">", 10_000)),
    Rule("CompactionLagging", "warning", "hudi", 300, Term(Value(P + "hudi_log_files_total"), ">", 50),
         Term(Value(P + "hudi_commit_count"), "<", 1), on_time=True),
    Rule("KafkaIngestionStalled", "warning", "kafka", 300, Term(Value(P + "kafka_topic_latest_offset", "increase", 300), "==", 0)),
    Rule("HudiTableGrowingFast", "warning", "hudi", 600, Term(Value(P + "hudi_table_size_bytes", "increase", 600), ">", 5_368_709_120)),
    Rule("SparkBatchOverrun", "warning", "spark", 120,
         Term(Value("metrics_app_.*_driver_spark_streaming_.*_triggerExecution_Value", regex=True), ">", 60_000)),
    Rule("ExporterScrapeErrors", "warning", "monitoring", 300, Term(Value(P + "exporter_scrape_errors_total", "increase", 300), ">", 10)),
]


def points(samples: DataFrame, values: Sequence[Value], step_s: int, lookback_s: int, chunk_s: int) -> DataFrame:
    """All ``values`` on the grid in one pass; only their metrics are read."""
    name = F.col("metric")
    wanted, reach = F.lit(False), F.lit(0)
    for v in values:
        wanted = wanted | v.of(name)
        reach = F.greatest(reach, F.when(v.of(name), F.lit(v.reach(lookback_s))).otherwise(F.lit(0)))
    ranges = sorted({(v.range_s, v.kind) for v in values if v.fn != "instant"})
    asked = {r: reduce(or_, [v.of(name) for v in values if v.fn != "instant" and v.range_s == r]) for r, _ in ranges}
    return S.grid_points(samples.filter(wanted), step_s, lookback_s, ranges, reach, chunk_s, asked)


def beside(grid: DataFrame, values: Sequence[Value]) -> tuple[DataFrame, dict[Value, Column]]:
    """Values of several metrics beside one another, one row for (t, series)."""
    names = {v: f"_v{i}" for i, v in enumerate(dict.fromkeys(values))}
    some = grid.filter(F.col("metric").isin(sorted({v.metric for v in names})))
    rows = some.groupBy("t", "series").agg(*[F.max(F.when(v.of(F.col("metric")), v.column())).alias(n) for v, n in names.items()])
    return rows, {v: F.col(n) for v, n in names.items()}


def conditions(samples: DataFrame, rules: Sequence[Rule], step_s: int = EVAL_STEP_S, lookback_s: int = LOOKBACK_S,
               chunk_s: int = S.DEFAULT_CHUNK_S) -> DataFrame:
    """(alert, metric, series, t, value, active) where a rule's condition holds."""
    single, double = [r for r in rules if r.also is None], [r for r in rules if r.also is not None]
    parts = []

    def exploded(df: DataFrame, hits: list[Column]) -> DataFrame:
        return df.select("*", F.explode(F.array_compact(F.array(*hits))).alias("_h")).select(
            "_h.alert", "_h.metric", "series", "t", "_h.value", F.lit(True).alias("active"))

    def hit(rule: Rule, metric: Column, value: Column, when: Column) -> Column:
        return F.when(when, F.struct(F.lit(rule.name).alias("alert"), metric.alias("metric"), value.alias("value")))

    # Each part computes the grid of its own metrics.
    if single:
        grid = points(samples, [r.term.value for r in single], step_s, lookback_s, chunk_s)
        parts.append(exploded(grid, [hit(r, F.col("metric"), r.term.value.column(),
                                         r.term.value.of(F.col("metric")) & r.term.holds(r.term.value.column())) for r in single]))
    if double:
        values = [t.value for r in double for t in (r.term, r.also)]
        rows, col = beside(points(samples, values, step_s, lookback_s, chunk_s), values)
        anywhere = {r: f"_any{i}" for i, r in enumerate(double) if r.on_time}
        rows = rows.select("*", *[F.max(r.also.holds(col[r.also.value])).over(Window.partitionBy("t")).alias(n) for r, n in anywhere.items()])
        parts.append(exploded(rows, [hit(r, F.lit(r.term.value.metric), col[r.term.value], r.term.holds(col[r.term.value])
                                         & (F.col(anywhere[r]) if r.on_time else r.also.holds(col[r.also.value]))) for r in double]))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def condition(samples: DataFrame, rule: Rule, step_s: int = EVAL_STEP_S, lookback_s: int = LOOKBACK_S) -> DataFrame:
    return conditions(samples, [rule], step_s, lookback_s)


def read_window(samples: DataFrame, start: Column | None, end: Column | None) -> DataFrame:
    """Samples between two times; a ``date`` column, if there is one, prunes partitions."""
    cond = F.lit(True)
    for limit, low in ((start, True), (end, False)):
        if limit is not None:
            cond = cond & (F.col("ts") >= limit if low else F.col("ts") <= limit)
            if "date" in samples.columns:
                day = F.col("date").cast("date")
                cond = cond & (day >= limit.cast("date") if low else day <= limit.cast("date"))
    return samples.filter(cond)


def evaluate(samples: DataFrame, rules: Sequence[Rule] = tuple(RULES), step_s: int = EVAL_STEP_S, lookback_s: int = LOOKBACK_S,
             start: str | None = None, end: str | None = None, chunk_s: int = S.DEFAULT_CHUNK_S) -> DataFrame:
    """All rules → (alert, severity, component, metric, series, ts, t, value, active_since, state).

    With ``start``/``end`` ('yyyy-MM-dd HH:mm:ss', session time zone) the rows
    in between are those of a full evaluation, ``active_since`` included:
    samples are read from before ``start`` by the longest reach of any term
    (the filter reaches the scan), and for runs that are already active at the
    first evaluation, from further back until their start is found: the time
    before it, then the time before that, four times as long each time, and the
    metrics of their rules only. Samples after ``end`` aren't read and no row
    lies after it.
    """
    if start is None:
        return _described(_runs(samples, rules, step_s, lookback_s, chunk_s, None, None if end is None else F.lit(end).cast("timestamp")), rules)
    back = max(r.hold_s for r in rules) + 2 * step_s
    spark = samples.sparkSession
    first = spark.sql(f"SELECT unix_seconds(TIMESTAMP '{start}') AS t").first()["t"]
    begin = -(-(first - back) // step_s) * step_s  # the first evaluation
    until = None if end is None else F.lit(end).cast("timestamp")
    out = _runs(samples, rules, step_s, lookback_s, chunk_s, begin, until, kept=False).filter(F.col("t") >= first)
    # Runs that go on from the first evaluation into the window, from the few evaluations between.
    into = -(-first // step_s) * step_s
    lead = _runs(samples, rules, step_s, lookback_s, chunk_s, begin, F.timestamp_seconds(F.lit(into)))
    cut = lead.filter((F.col("t") == into) & (F.col("active_since") == begin)).select(*RUN)
    begun = _begun(samples, cut, begin, back, rules, step_s, lookback_s, chunk_s)
    if begun is not None:
        out = _beside_runs(out, begun, "left").withColumn(
            "active_since", F.when(F.col("active_since") == begin, F.col("_since")).otherwise(F.col("active_since")))
    return _described(out, rules)


def _beside_runs(rows: DataFrame, runs: DataFrame, how: str) -> DataFrame:
    """``rows`` with the other columns of ``runs``, by alert, metric and series, nulls included."""
    same = reduce(and_, [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in RUN])
    more = [] if how == "left_semi" else [f"b.{c}" for c in runs.columns if c not in RUN]
    return rows.alias("a").join(runs.alias("b"), same, how).select("a.*", *more)


def _begun(samples: DataFrame, cut: DataFrame, begin: int, back: int, rules: Sequence[Rule], step_s: int, lookback_s: int,
           chunk_s: int) -> DataFrame | None:
    """(alert, metric, series, _since) of the ``cut`` runs, which are active at ``begin``; None if there are none.

    The time before is read in windows beside one another, each four times as
    long, for the rules and series of runs only whose start is still open.
    """
    found = None
    cut = staged(cut, "alert-cut")
    while names := [r[0] for r in cut.select("alert").distinct().collect()]:  # rules
        some = [r for r in rules if r.name in names]
        early = begin - -(-3 * back // step_s) * step_s
        back *= 4
        runs = _runs(samples, some, step_s, lookback_s, chunk_s, early, F.timestamp_seconds(F.lit(begin - step_s)), cut)
        # A run that isn't active one step before has begun there and then.
        since = F.coalesce("active_since", F.lit(begin).cast("bigint")).alias("_since")
        before = runs.filter(F.col("t") == begin - step_s).select(*RUN, "active_since")
        got = staged(_beside_runs(cut, before, "left").select(*RUN, since), "alert-begun")
        known = got.filter(F.col("_since") > early)
        found = known if found is None else found.unionByName(known)
        cut, begin = got.filter(F.col("_since") == early).select(*RUN), early
    return found


def _runs(samples: DataFrame, rules: Sequence[Rule], step_s: int, lookback_s: int, chunk_s: int, begin: int | None = None,
          until: Column | None = None, keys: DataFrame | None = None, kept: bool = True) -> DataFrame:
    """Active evaluations from ``begin`` to ``until`` with ``active_since`` as far as they go back; of ``keys`` only, if given."""
    reach = longest_reach(rules, lookback_s)
    low = None if begin is None else F.timestamp_seconds(F.lit(begin - reach))
    active = conditions(read_window(samples, low, until), rules, step_s, lookback_s, chunk_s)
    if begin is not None:  # values before it may lack samples
        active = active.filter(F.col("t") >= begin)
    if until is not None:
        active = active.filter(F.timestamp_seconds("t") <= until)
    if keys is not None:
        active = _beside_runs(active, keys, "left_semi")
    # The states read them twice: ``kept`` writes them first.
    return S.firing(staged(active, "alert-active") if kept else active, 0, step_s, chunk_s, keys=RUN)


def longest_reach(rules: Sequence[Rule], lookback_s: int = LOOKBACK_S) -> int:
    """Seconds that a sample can matter to an evaluation after it."""
    return max(t.value.reach(lookback_s) for r in rules for t in (r.term, r.also) if t is not None)


def evaluate_next(window: DataFrame, running: DataFrame, begin: int | None, until: int, rules: Sequence[Rule] = tuple(RULES),
                  step_s: int = EVAL_STEP_S, lookback_s: int = LOOKBACK_S, chunk_s: int = S.DEFAULT_CHUNK_S) -> DataFrame:
    """The rows that ``evaluate`` has for evaluations after ``begin`` up to ``until``, from what came since.

    ``window`` holds the samples of the last ``longest_reach`` seconds up to
    ``begin`` and all since; ``running`` (alert, metric, series, active_since)
    the runs that were active at ``begin``, an evaluation time (null at first).
    Nothing older is read, however long a run has lasted.
    """
    active = conditions(window, rules, step_s, lookback_s, chunk_s).filter(F.col("t") <= until)
    if begin is not None:
        # A run that goes on has a row at ``begin``; its start is known.
        went_on = running.select(*RUN, F.lit(begin).cast("bigint").alias("t"), F.lit(None).cast("double").alias("value"), F.lit(True).alias("active"))
        active = active.filter(F.col("t") > begin).unionByName(went_on)
    states = S.firing(staged(active, "alert-active"), 0, step_s, chunk_s, keys=RUN)
    if begin is not None:
        known = running.select(*RUN, F.col("active_since").alias("_since"))
        states = states.filter(F.col("t") > begin).join(known, RUN, "left").withColumn(
            "active_since", F.when(F.col("active_since") == begin, F.col("_since")).otherwise(F.col("active_since"))).drop("_since")
    return _described(states, rules)


def _described(states: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    spec = F.create_map(*[x for r in rules for x in (F.lit(r.name), F.struct(F.lit(r.severity).alias("severity"), F.lit(r.component).alias("component"),
                                                                            F.lit(r.hold_s).alias("hold_s")))])
    states = states.withColumn("_r", spec[F.col("alert")])
    return states.select("alert", "_r.severity", "_r.component", "metric", "series", F.timestamp_seconds("t").alias("ts"), "t", "value", "active_since",
                         F.when(F.col("t") - F.col("active_since") >= F.col("_r.hold_s"), F.lit("firing")).otherwise(F.lit("pending")).alias("state"))

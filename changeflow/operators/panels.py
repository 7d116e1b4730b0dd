"""Dashboard panel queries with threshold status (§2.14, FN-18).

Each panel draws one or more lines (values of metrics, or arithmetic of two)
plus optional threshold steps (a value takes the colour of the highest step it
reaches) and value mappings (exact value → text). All panels asked for are
computed in one pass over the samples.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.functions import series as S
from changeflow.operators.alerts import LOOKBACK_S, P, Value, beside, points, read_window

PANEL_STEP_S = 15
OFFSET, LAG = P + "kafka_topic_latest_offset", P + "spark_consumer_lag_total"


def threshold_status(value: Column, base: str, steps: list[tuple[float, str]]) -> Column:
    """FN-18: colour of the highest step ``value`` reaches (ascending steps)."""
    out = F.lit(base)
    for limit, colour in steps:
        out = F.when(value >= limit, F.lit(colour)).otherwise(out)
    return F.when(value.isNull(), F.lit(None).cast("string")).otherwise(out)


def value_text(value: Column, mapping: dict[float, str]) -> Column:
    out = F.lit(None).cast("string")
    for k, text in mapping.items():
        out = F.when(value == k, F.lit(text)).otherwise(out)
    return out


@dataclass(frozen=True)
class Line:
    """One line of a panel: a value, or ``of`` several values of one series; ``legend`` names it (default: its metric)."""

    values: tuple[Value, ...]
    of: Callable[..., Column] | None = None
    legend: str | None = None


def _line(name: str, fn: str = "instant", range_s: int = 0, legend: str | None = None, regex: bool = False) -> Line:
    return Line((Value(name, fn, range_s, regex=regex),), None, legend)


def consumer_rate(range_s: int, legend: str = "consumer") -> Line:
    """P-21: clamp_min(rate(latest_offset[r]) − rate(lag[r]), 0)."""
    values = (Value(OFFSET, "rate", range_s), Value(LAG, "rate", range_s))
    return Line(values, lambda made, lag: S.clamp_min(made - lag, 0), legend)


def lag_minutes(range_s: int, legend: str = "minutes") -> Line:
    """P-23: lag / clamp_min(rate(latest_offset[r]) − rate(lag[r]), 1) / 60."""
    values = (Value(LAG), Value(OFFSET, "rate", range_s), Value(LAG, "rate", range_s))
    return Line(values, lambda level, made, lag: level / S.clamp_min(made - lag, 1) / 60, legend)


@dataclass(frozen=True)
class Panel:
    pid: int
    title: str
    lines: tuple[Line, ...]
    base: str | None = None
    steps: list[tuple[float, str]] = field(default_factory=list)
    mapping: dict[float, str] = field(default_factory=dict)


def _m(*names: str) -> tuple[Line, ...]:
    return tuple(_line(P + n) for n in names)


# The reference dashboard's panels (id, title, query, thresholds,
# value mappings); the JVM-heap panel is not built.
PANELS = [
    Panel(10, "Debezium", _m("debezium_connector_running"), "red", [(1, "green")], {0: "DOWN", 1: "RUNNING"}),
    Panel(11, "MySQL", _m("mysql_reachable"), "red", [(1, "green")], {0: "DOWN", 1: "OK"}),
    Panel(12, "Spark Commit Age", _m("hudi_last_commit_age_seconds"), "green", [(90, "yellow"), (300, "red")]),
    Panel(13, "Inflight Ops", _m("hudi_inflight_operations"), "green", [(3, "yellow"), (5, "red")]),
    Panel(14, "Exporter", (_line(P + "exporter_scrape_errors_total", "increase", 300),), "green", [(3, "yellow"), (10, "red")]),
    Panel(20, "Producer Rate", (_line(OFFSET, "rate", 60),)),
    Panel(21, "Consumer Rate", (consumer_rate(60),)),
    Panel(22, "Lag (messages)", _m("spark_consumer_lag_total"), "green", [(500_000, "yellow"), (5_000_000, "red")]),
    Panel(23, "Lag (minutes)", (lag_minutes(120),), "green", [(1, "yellow"), (10, "red")]),
    Panel(30, "Producer vs Consumer rate", (_line(OFFSET, "rate", 60, "producer"), consumer_rate(60))),
    Panel(31, "Lag over time", _m("spark_consumer_lag_total")),
    Panel(40, "Spark batch duration", (_line("metrics_app_.*_driver_spark_streaming_.*_triggerExecution_Value", regex=True),),
          "green", [(30_000, "yellow"), (60_000, "red")]),
    Panel(41, "Input rows per batch", (_line("metrics_app_.*_driver_spark_streaming_.*_inputRate_total_Value", regex=True),)),
    Panel(42, "Per-partition Kafka lag", _m("spark_consumer_lag_per_partition")),
    Panel(50, "Timeline events (cumulative)", _m("hudi_deltacommit_count", "hudi_commit_count", "hudi_clean_count")),
    Panel(51, "Parquet base files vs log files", _m("hudi_base_files_total", "hudi_log_files_total")),
    Panel(52, "Hudi table size", _m("hudi_table_size_bytes")),
    Panel(61, "Kafka ingestion rate (msgs/sec)", (_line(OFFSET, "rate", 60),)),
]


def panels(samples: DataFrame, specs: Sequence[Panel] = tuple(PANELS), step_s: int = PANEL_STEP_S, lookback_s: int = LOOKBACK_S,
           start: str | None = None, end: str | None = None, chunk_s: int = S.DEFAULT_CHUNK_S) -> DataFrame:
    """(panel, ts, t, metric, series, value, status, text) of several panels; ``metric`` names the line.

    ``start``/``end`` ('yyyy-MM-dd HH:mm:ss') restrict them to a dashboard time
    range, with the values that they have unrestricted: samples are read from
    ``start`` minus the longest reach of any line, up to ``end``.
    """
    every = [v for p in specs for line in p.lines for v in line.values]
    first = last = None
    if start is not None:
        reach = max(v.reach(lookback_s) for v in every)
        first = F.lit(start).cast("timestamp")
        samples = read_window(samples, first - F.expr(f"INTERVAL {reach} SECONDS"), None)
    if end is not None:
        last = F.lit(end).cast("timestamp")
        samples = read_window(samples, None, last)

    def shown(p: Panel, metric: Column, value: Column, when: Column) -> Column:
        status = threshold_status(value, p.base, p.steps) if p.base else F.lit(None).cast("string")
        text = value_text(value, p.mapping) if p.mapping else F.lit(None).cast("string")
        return F.when(when & value.isNotNull(), F.struct(F.lit(p.pid).alias("panel"), metric.alias("metric"), value.cast("double").alias("value"),
                                                         status.alias("status"), text.alias("text")))

    def exploded(df: DataFrame, cells: list[Column]) -> DataFrame:
        return df.select("t", "series", F.explode(F.array_compact(F.array(*cells))).alias("_c")).select(
            "_c.panel", F.timestamp_seconds("t").alias("ts"), "t", "_c.metric", "series", "_c.value", "_c.status", "_c.text")

    plain = [(p, line) for p in specs for line in p.lines if line.of is None]
    made = [(p, line) for p in specs for line in p.lines if line.of is not None]
    parts = []
    # Each part computes the grid of its own metrics.
    if plain:
        name = F.col("metric")
        grid = points(samples, [line.values[0] for _, line in plain], step_s, lookback_s, chunk_s)
        parts.append(exploded(grid, [shown(p, F.lit(line.legend) if line.legend else name, line.values[0].column(), line.values[0].of(name))
                                     for p, line in plain]))
    if made:
        values = [v for _, line in made for v in line.values]
        rows, col = beside(points(samples, values, step_s, lookback_s, chunk_s), values)
        parts.append(exploded(rows, [shown(p, F.lit(line.legend), line.of(*[col[v] for v in line.values]), F.lit(True)) for p, line in made]))
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    if first is not None:
        out = out.filter(F.col("ts") >= first)
    return out if last is None else out.filter(F.col("ts") <= last)


def panel(samples: DataFrame, pid: int, step_s: int = PANEL_STEP_S, lookback_s: int = LOOKBACK_S,
          start: str | None = None, end: str | None = None) -> DataFrame:
    """One panel, as ``panels`` has it."""
    return panels(samples, [p for p in PANELS if p.pid == pid], step_s, lookback_s, start, end)

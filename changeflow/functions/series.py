"""Time-series functions over samples (WIN-1..4, JOIN-3..5, FN-13, FN-20).

Samples are rows (ts, metric, labels map, value). A series is (metric,
labels); ``series_key`` turns the label map into a sortable string so it can
be a grouping key. Ranges are right-closed, ``(t - r, t]``, evaluated at each
sample's own time on integer seconds; only samples inside the range count and
there is no edge extrapolation.

Skew: a window over a whole series would put a hot series (say a third of
all samples) in one task. Range functions therefore split each series into
time chunks and copy the last ``halo`` seconds of every chunk into the next
one; the frame of any row then lies inside its own chunk, so every task is
bounded by the chunk size. Running state that is unbounded in time (how long
a condition has held) is carried across chunks through a per-chunk summary.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_CHUNK_S = 86_400


def series_key(labels: Column) -> Column:
    """Canonical ``k=v,k=v`` text of a label map (keys sorted)."""
    entries = F.array_sort(F.map_entries(labels))
    return F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",")


def with_series(samples: DataFrame) -> DataFrame:
    """Add ``series`` (label text) and ``t`` (epoch seconds)."""
    out = samples
    if "series" not in out.columns:
        out = out.withColumn("series", series_key(F.col("labels")))
    if "t" not in out.columns:
        out = out.withColumn("t", F.unix_seconds(F.col("ts")))
    return out


def select_metric(samples: DataFrame, pattern: str) -> DataFrame:
    """FN-20: ``{__name__=~pattern}``, anchored at both ends."""
    return samples.filter(F.col("metric").rlike(f"^(?:{pattern})$"))


def _chunked(df: DataFrame, chunk_s: int, halo_s: int) -> DataFrame:
    """Each row in its own chunk (``own``) plus a copy in every later chunk
    whose start lies within ``halo_s`` after it (one copy when the halo is
    shorter than a chunk, as with the defaults)."""
    c = F.floor(F.col("t") / F.lit(chunk_s))
    later = -(-halo_s // chunk_s)  # chunks a halo can reach
    copies = F.array(
        F.struct(c.alias("chunk"), F.lit(True).alias("own")),
        *[F.when(F.col("t") >= (c + j) * chunk_s - halo_s,
                 F.struct((c + j).alias("chunk"), F.lit(False).alias("own")))
          for j in range(1, later + 1)],
    )
    return df.select("*", F.explode(copies).alias("_c")).filter(F.col("_c").isNotNull()) \
        .select("*", F.col("_c.chunk").alias("chunk"), F.col("_c.own").alias("own")).drop("_c")


def _keys(df: DataFrame) -> list[str]:
    return [c for c in ("metric", "series") if c in df.columns]


def increase(samples: DataFrame, range_s: int, kind: str = "counter", chunk_s: int = DEFAULT_CHUNK_S) -> DataFrame:
    """WIN-1 / WIN-2: ``increase`` and ``rate`` of each series over ``(t - range_s, t]``.

    ``kind="counter"`` corrects counter resets (a drop counts as a restart
    from zero); ``kind="gauge"`` takes plain differences. ``rate`` = increase /
    seconds covered by the samples in range; both are null with fewer than two
    samples in range, and so is the rate of samples in one second. Samples of
    one second are taken by value. Adds columns ``increase``, ``rate``,
    ``n_in_range``.
    """
    df = with_series(samples)
    keys = _keys(df)
    ch = _chunked(df, chunk_s, range_s)
    part = Window.partitionBy(*keys, "chunk").orderBy("t")
    prev = F.lag("value").over(Window.partitionBy(*keys, "chunk").orderBy("t", "value"))
    if kind == "counter":
        d = F.when(prev.isNull(), F.lit(0.0)).when(F.col("value") >= prev, F.col("value") - prev).otherwise(F.col("value"))
    else:
        d = F.coalesce(F.col("value") - prev, F.lit(0.0))
    ch = ch.withColumn("_d", d)
    frame = part.rangeBetween(-(range_s - 1), 0)
    inc = F.sum("_d").over(frame) - F.min(F.struct("t", "value", "_d")).over(frame)["_d"]
    first_t = F.first("t").over(frame)
    n = F.count(F.lit(1)).over(frame)
    out = ch.select("*", inc.alias("_inc"), first_t.alias("_t0"), n.alias("n_in_range")).filter("own")
    covered = F.col("t") - F.col("_t0")
    return out.select(
        *[c for c in df.columns],
        F.when(F.col("n_in_range") >= 2, F.col("_inc")).alias("increase"),
        F.when(F.col("n_in_range") >= 2, F.try_divide(F.col("_inc"), covered)).alias("rate"),
        "n_in_range",
    )


def range_at_grid(samples: DataFrame, range_s: int, step_s: int, kind: str = "counter",
                  chunk_s: int = DEFAULT_CHUNK_S) -> DataFrame:
    """WIN-1 / WIN-2 evaluated on the step grid, as a rule engine does.

    At each grid time t the samples in ``(t - range_s, t]`` give
    ``increase`` (reset-corrected for counters) and ``rate`` = increase /
    (last − first sample time in range). Grid points with fewer than two
    samples in range yield nothing. Returns (metric, series, t, ts,
    increase, rate).
    """
    df = with_series(samples)
    keys = _keys(df)
    bounds = df.groupBy(*keys).agg(F.min("t").alias("t0"), F.max("t").alias("t1"))
    grid = _grid(bounds.select(*keys, (F.ceil(F.col("t0") / step_s) * step_s).cast("bigint").alias("lo"),
                               (F.col("t1") + range_s).cast("bigint").alias("hi")), keys, step_s, chunk_s)
    rows = df.select(*keys, "t", "value", F.lit(False).alias("is_grid")).unionByName(
        grid.select(*keys, "t", F.lit(None).cast("double").alias("value"), F.lit(True).alias("is_grid")))
    ch = _chunked(rows, chunk_s, range_s)
    part = Window.partitionBy(*keys, "chunk").orderBy("t", "is_grid", "value")
    prev = F.last("value", ignorenulls=True).over(part.rowsBetween(Window.unboundedPreceding, -1))
    if kind == "counter":
        d = F.when(prev.isNull(), F.lit(0.0)).when(F.col("value") >= prev, F.col("value") - prev).otherwise(F.col("value"))
    else:
        d = F.coalesce(F.col("value") - prev, F.lit(0.0))
    ch = ch.withColumn("_d", F.when(~F.col("is_grid"), d))
    frame = Window.partitionBy(*keys, "chunk").orderBy("t").rangeBetween(-(range_s - 1), 0)
    st = F.when(~F.col("is_grid"), F.col("t"))
    out = ch.select(*keys, "t", "own", "is_grid",
                    (F.sum("_d").over(frame) - F.min(F.when(~F.col("is_grid"), F.struct("t", "value", "_d"))).over(frame)["_d"]).alias("_inc"),
                    F.count("_d").over(frame).alias("_n"),
                    (F.last(st, ignorenulls=True).over(frame) - F.first(st, ignorenulls=True).over(frame)).alias("_cov"))
    out = out.filter(F.col("own") & F.col("is_grid") & (F.col("_n") >= 2))
    return out.select(*keys, "t", F.timestamp_seconds("t").alias("ts"), F.col("_inc").alias("increase"),
                      (F.try_divide(F.col("_inc"), F.col("_cov"))).alias("rate"))


def _grid(bounds: DataFrame, keys: list[str], step_s: int, chunk_s: int) -> DataFrame:
    """Grid points lo, lo+step, ... ≤ hi per series, generated in two steps
    (chunks, then points within a chunk) so no single row expands into a
    whole series' time span."""
    per_chunk = max(1, chunk_s // step_s) * step_s
    # A series whose first grid point lies after its last (e.g. one sample and
    # a lookback shorter than the step) has no grid points.
    bounds = bounds.filter(F.col("lo") <= F.col("hi"))
    starts = bounds.select(*keys, "hi", F.explode(F.sequence(
        F.col("lo"), F.col("hi"), F.lit(per_chunk).cast("bigint"))).alias("c0"))
    starts = starts.repartition(*keys, "c0")
    end = F.least(F.col("hi"), F.col("c0") + per_chunk - step_s)
    return starts.select(*keys, F.explode(F.sequence(F.col("c0"), end, F.lit(step_s).cast("bigint"))).alias("t"))


def instant(samples: DataFrame, step_s: int, lookback_s: int = 300, start: Column | None = None,
            end: Column | None = None, chunk_s: int = DEFAULT_CHUNK_S) -> DataFrame:
    """WIN-4: value of each series on an evaluation grid of ``step_s`` seconds.

    The value at grid time t is the newest sample in ``[t - lookback_s, t]``
    (a stale value is carried while scrapes fail, up to the lookback). The
    grid of a series runs from its first to its last sample, aligned to
    multiples of ``step_s``. Grid points with no sample in the lookback are
    dropped.
    """
    df = with_series(samples)
    keys = _keys(df)
    bounds = df.groupBy(*keys).agg(F.min("t").alias("t0"), F.max("t").alias("t1"))
    lo = F.ceil(F.col("t0") / step_s) * step_s if start is None else start
    hi = F.col("t1") + lookback_s if end is None else end
    grid = _grid(bounds.select(*keys, lo.cast("bigint").alias("lo"), hi.cast("bigint").alias("hi")), keys,
                 step_s, chunk_s)
    rows = df.select(*keys, "t", "value", F.lit(False).alias("is_grid")).unionByName(
        grid.select(*keys, "t", F.lit(None).cast("double").alias("value"), F.lit(True).alias("is_grid")))
    ch = _chunked(rows, chunk_s, lookback_s)
    frame = Window.partitionBy(*keys, "chunk").orderBy("t").rangeBetween(-lookback_s, 0)
    v = F.last("value", ignorenulls=True).over(frame)
    out = ch.select(*keys, "t", "own", "is_grid", v.alias("v")).filter(F.col("own") & F.col("is_grid") & F.col("v").isNotNull())
    return out.select(*keys, F.timestamp_seconds("t").alias("ts"), "t", F.col("v").alias("value"))


def inc_name(range_s: int, kind: str) -> str:
    return f"increase_{range_s}_{kind}"


def rate_name(range_s: int, kind: str) -> str:
    return f"rate_{range_s}_{kind}"


def grid_points(samples: DataFrame, step_s: int, lookback_s: int, ranges: Sequence[tuple[int, str]] = (),
                reach: Column | None = None, chunk_s: int = DEFAULT_CHUNK_S, asked: Mapping[int, Column] | None = None) -> DataFrame:
    """WIN-1, WIN-2 and WIN-4 for all series in one pass over the samples.

    One row per (metric, series, grid time t) that some sample reaches:
    ``value`` is the newest sample in ``[t - lookback_s, t]`` (null if there is
    none), and for each (range, kind) in ``ranges`` the reset-corrected
    ``increase_*`` and the ``rate_*`` over ``(t - range, t]`` (null with fewer
    than two samples in range). ``reach`` limits, per metric, how many seconds
    after a sample its grid points go on; by default the longest of all.
    ``asked`` names, by range, the metrics that have it; others get null there.

    A sample makes the grid points up to the next sample or the end of its
    reach, so sparse series cost what their samples cost and not their time
    span. A range needs the samples' running sum at its newest and its oldest
    sample only. The oldest is carried forward: at the grid time when a sample
    leaves a range a mark names the next one, so a grid point costs the same
    however many samples its ranges hold.
    """
    df = with_series(samples)
    longest = max([lookback_s, *(r - 1 for r, _ in ranges)])
    df = df.select("metric", "series", "t", "value", (F.lit(longest) if reach is None else reach).alias("_reach"))
    ch = _chunked(df, chunk_s, longest)
    part = Window.partitionBy("metric", "series", "chunk")
    by_time = part.orderBy("t", "value")
    prev = F.lag("value").over(by_time)
    deltas = {
        "counter": F.when(prev.isNull(), F.lit(0.0)).when(F.col("value") >= prev, F.col("value") - prev).otherwise(F.col("value")),
        "gauge": F.coalesce(F.col("value") - prev, F.lit(0.0)),
    }
    kinds = sorted({k for _, k in ranges})
    sums = [f"_sum_{k}" for k in kinds]
    ch = ch.select("*", F.lead("t").over(by_time).alias("_next"), F.row_number().over(by_time).alias("_i"),
                   *[deltas[k].alias(f"_d_{k}") for k in kinds])
    run = by_time.rowsBetween(Window.unboundedPreceding, 0)
    ch = ch.select("*", *[F.sum(f"_d_{k}").over(run).alias(f"_sum_{k}") for k in kinds])
    ch = ch.select("*", *[F.lead(n).over(by_time).alias(f"_next{n}") for n in sums])

    def up(t: Column) -> Column:
        return (F.ceil(t / F.lit(step_s)) * step_s).cast("bigint")

    lo = up(F.greatest(F.col("t"), F.col("chunk") * chunk_s))
    hi = F.least(F.coalesce(F.col("_next") - 1, F.col("t") + F.col("_reach")), F.col("t") + F.col("_reach"), (F.col("chunk") + 1) * chunk_s - 1)
    hi = hi.cast("bigint")
    none = F.array().cast("array<bigint>")
    grid = F.when(lo <= hi, F.sequence(lo, hi, F.lit(step_s).cast("bigint"))).otherwise(none)

    def point(mark: int, at: Column, i: Column, t: Column, totals: list[Column]) -> Column:
        return F.struct(F.lit(mark).alias("mark"), at.alias("at"), i.alias("i"), t.alias("t"), *[x.alias(n) for n, x in zip(sums, totals, strict=True)])

    def marks(r: int) -> Column:
        """The sample that is a range's oldest from a grid time on: the first one, and the one after each that leaves."""
        own = point(r, up(F.col("t")), F.col("_i"), F.col("t"), [F.col(n) for n in sums])
        after = point(r, up(F.col("t") + r), F.col("_i") + 1, F.col("_next"), [F.col(f"_next{n}") for n in sums])
        # Of samples that leave between two grid times the last one counts.
        last = F.col("_next").isNull() | (up(F.col("_next") + r) > up(F.col("t") + r))
        wanted = F.lit(True) if asked is None else asked[r]
        return F.array(F.when(wanted & (F.col("_i") == 1), own), F.when(wanted & last, after))

    every = sorted({r for r, _ in ranges})
    at = F.transform(grid, lambda x: point(0, x, F.col("_i"), F.col("t"), [F.col(n) for n in sums]))
    if every:
        at = F.concat(at, F.array_compact(F.concat(*[marks(r) for r in every])))
    rows = ch.select("metric", "series", "chunk", "value", F.explode(at).alias("_p"))
    rows = rows.select("metric", "series", "chunk", "value", F.col("_p.mark").alias("_mark"), F.col("_p.at").alias("t"),
                       F.col("_p.i").alias("_i"), F.col("_p.t").alias("_t"), *[F.col(f"_p.{n}").alias(n) for n in sums])
    if every:
        so_far = part.orderBy("t").rangeBetween(Window.unboundedPreceding, 0)
        rows = rows.select("*", *[F.max(F.when(F.col("_mark") == r, F.struct("_i", "_t", *sums))).over(so_far).alias(f"_first_{r}") for r in every])
    out = rows.filter("_mark = 0")
    cols = [F.when(F.col("t") - F.col("_t") <= lookback_s, F.col("value")).alias("value")]
    for r, k in ranges:
        two = F.col(f"_first_{r}._i") < F.col("_i")
        inc = F.col(f"_sum_{k}") - F.col(f"_first_{r}._sum_{k}")
        cols += [F.when(two, inc).alias(inc_name(r, k)), F.when(two, F.try_divide(inc, F.col("_t") - F.col(f"_first_{r}._t"))).alias(rate_name(r, k))]
    return out.select("metric", "series", "t", *cols)


def firing(cond: DataFrame, hold_s: int, step_s: int, chunk_s: int = DEFAULT_CHUNK_S,
           keys: Sequence[str] | None = None) -> DataFrame:
    """WIN-3: alert state of a condition that must hold for ``hold_s`` seconds.

    ``cond`` has (keys..., t, active). A run of active evaluations breaks on an
    inactive row or a gap longer than ``step_s``. Returns the active rows
    with ``active_since`` and ``state`` ∈ {pending, firing} (firing once
    ``t - active_since >= hold_s``).

    The run start is a running max of run-start times: computed inside time
    chunks and carried across chunks through a small per-chunk summary, so no
    task holds a whole series.
    """
    keys = list(keys) if keys is not None else [c for c in ("alert", "metric", "series") if c in cond.columns]
    ch = _chunked(cond, chunk_s, step_s + 1)
    part = Window.partitionBy(*keys, "chunk").orderBy("t")
    prev_t, prev_a = F.lag("t").over(part), F.lag("active").over(part)
    starts = F.col("active") & (prev_t.isNull() | ~prev_a | (F.col("t") - prev_t > step_s))
    ch = ch.withColumn("_start", F.when(starts, F.col("t"))).filter("own")
    run = Window.partitionBy(*keys, "chunk").orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    ch = ch.withColumn("_in", F.max("_start").over(run))
    summary = ch.groupBy(*keys, "chunk").agg(F.max("_start").alias("_m"))
    carry_w = Window.partitionBy(*keys).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    carry = summary.select(*keys, "chunk", F.max("_m").over(carry_w).alias("_carry"))
    out = ch.filter("active").join(carry, [*keys, "chunk"], "left")
    since = F.coalesce(F.col("_in"), F.col("_carry"))
    return out.select(
        *[c for c in cond.columns if c not in ("chunk", "own")],
        since.alias("active_since"),
        F.when(F.col("t") - since >= hold_s, F.lit("firing")).otherwise(F.lit("pending")).alias("state"),
    )


def and_series(a: DataFrame, b: DataFrame, on: Sequence[str] | None = None) -> DataFrame:
    """JOIN-3 / JOIN-4: rule-language ``a and b`` (match on time + labels) or ``a and on(...) b``.

    ``on=None`` matches the label set; ``on=[]`` matches time only (keep a
    whenever any b sample exists at that time).
    """
    keys = ["t", "series"] if on is None else ["t", *on]
    return a.join(b.select(*keys).distinct(), keys, "left_semi")


def combine(a: DataFrame, b: DataFrame, op: str, name: str = "value") -> DataFrame:
    """JOIN-5: binary arithmetic between two series matched on (time, labels)."""
    ops = {"-": lambda x, y: x - y, "+": lambda x, y: x + y, "*": lambda x, y: x * y, "/": lambda x, y: x / y}
    j = a.select("t", "series", F.col("value").alias("_a")).join(
        b.select("t", "series", F.col("value").alias("_b")), ["t", "series"])
    return j.select("t", "series", ops[op](F.col("_a"), F.col("_b")).alias(name))


def clamp_min(x: Column, n: float) -> Column:
    """FN-13; null stays null (``greatest`` alone would skip it)."""
    return F.when(x.isNotNull(), F.greatest(x, F.lit(n)))

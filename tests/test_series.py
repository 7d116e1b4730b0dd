"""Time-series functions: resets, ranges, grid, hold, and chunking invariance."""

import datetime as dt

import pandas as pd
from pyspark.sql import functions as F

from changeflow.functions import series as S

T0 = dt.datetime(2024, 1, 1)


def _samples(spark, rows, metric="m"):
    data = [(T0 + dt.timedelta(seconds=t), metric, {"p": p}, float(v)) for p, t, v in rows]
    return spark.createDataFrame(data, "ts timestamp, metric string, labels map<string,string>, value double")


def _brute_increase(rows, r):
    df = pd.DataFrame(rows, columns=["p", "t", "v"]).sort_values(["p", "t"])
    out = {}
    for p, g in df.groupby("p"):
        ts, vs = list(g.t), list(g.v)
        for i, t in enumerate(ts):
            idx = [j for j in range(len(ts)) if t - r < ts[j] <= t]
            if len(idx) < 2:
                out[(f"p={p}", t)] = (None, None)
                continue
            inc = sum((vs[j] - vs[j - 1]) if vs[j] >= vs[j - 1] else vs[j] for j in idx[1:])
            out[(f"p={p}", t)] = (inc, inc / (t - ts[idx[0]]))
    return out


ROWS = [("a", t, v) for t, v in [(0, 1), (10, 5), (20, 9), (30, 2), (40, 6), (200, 7), (210, 8), (215, 1)]] + \
       [("b", t, v) for t, v in [(50, 100), (60, 100), (70, 130)]]


def test_increase_rate_match_brute_force(spark):
    t0 = int(T0.replace(tzinfo=dt.timezone.utc).timestamp())
    got = {(r["series"], r["t"] - t0): (r["increase"], r["rate"])
           for r in S.increase(_samples(spark, ROWS), 30).collect()}
    assert got == _brute_increase(ROWS, 30)


def test_chunking_does_not_change_results(spark):
    s = _samples(spark, ROWS)
    a = sorted(tuple(r) for r in S.increase(s, 30, chunk_s=86_400).select("series", "t", "increase").collect())
    b = sorted(tuple(r) for r in S.increase(s, 30, chunk_s=25).select("series", "t", "increase").collect())
    assert a == b


def test_increase_never_negative(spark):
    got = [r["increase"] for r in S.increase(_samples(spark, ROWS), 100).collect() if r["increase"] is not None]
    assert min(got) >= 0


def test_instant_carries_stale_values(spark):
    s = _samples(spark, [("a", 0, 1), ("a", 100, 2)])
    got = {r["t"]: r["value"] for r in S.instant(s, step_s=30, lookback_s=60).collect()}
    t0 = int(T0.replace(tzinfo=dt.timezone.utc).timestamp())
    assert got == {t0: 1.0, t0 + 30: 1.0, t0 + 60: 1.0, t0 + 120: 2.0, t0 + 150: 2.0}


def _cond(spark, pattern, step=30):
    rows = [("s", i * step, c == "1") for i, c in enumerate(pattern) if c != "."]
    return spark.createDataFrame(rows, "series string, t bigint, active boolean")


def test_hold_flicker(spark):
    # true for 2 evaluations (60 s), false, then true for 4 (≥ 90 s hold at the 4th).
    st = S.firing(_cond(spark, "110111 1".replace(" ", "1")), hold_s=90, step_s=30, keys=["series"])
    got = [(r["t"], r["state"]) for r in st.orderBy("t").collect()]
    assert got == [(0, "pending"), (30, "pending"), (90, "pending"), (120, "pending"), (150, "pending"),
                   (180, "firing"), (210, "firing")]


def test_hold_gap_breaks_run(spark):
    st = S.firing(_cond(spark, "111.111"), hold_s=60, step_s=30, keys=["series"])
    got = [(r["t"], r["state"]) for r in st.orderBy("t").collect()]
    assert got == [(0, "pending"), (30, "pending"), (60, "firing"), (120, "pending"), (150, "pending"), (180, "firing")]


def test_hold_chunk_invariance(spark):
    c = _cond(spark, "1111111110111111111111", step=30)
    a = sorted(tuple(r) for r in S.firing(c, 120, 30, keys=["series"]).collect())
    b = sorted(tuple(r) for r in S.firing(c, 120, 30, chunk_s=70, keys=["series"]).collect())
    assert a == b


def test_and_on_empty_rhs(spark):
    a = S.with_series(_samples(spark, [("a", 0, 1)]))
    b = S.with_series(_samples(spark, [("a", 0, 1)])).filter(F.lit(False))
    assert S.and_series(a, b, on=[]).count() == 0
    assert S.and_series(a, S.with_series(_samples(spark, [("z", 0, 1)])), on=[]).count() == 1
    assert S.and_series(a, S.with_series(_samples(spark, [("z", 0, 1)]))).count() == 0


def test_range_at_grid_matches_brute_force(spark):
    step, r = 10, 30
    t0 = int(T0.replace(tzinfo=dt.timezone.utc).timestamp())
    got = {(row["series"], row["t"] - t0): (row["increase"], row["rate"])
           for row in S.range_at_grid(_samples(spark, ROWS), r, step).collect()}
    df = pd.DataFrame(ROWS, columns=["p", "t", "v"])
    want = {}
    for p, g in df.groupby("p"):
        g = g.sort_values("t")
        for gt in range(int(g.t.min() + step - 1) // step * step, int(g.t.max()) + r + 1, step):
            w = g[(g.t > gt - r) & (g.t <= gt)]
            if len(w) < 2:
                continue
            vs = list(w.v)
            inc = sum((b - a) if b >= a else b for a, b in zip(vs, vs[1:]))
            want[(f"p={p}", gt)] = (inc, inc / (w.t.max() - w.t.min()))
    assert got == want


def test_gauge_rate_can_be_negative(spark):
    s = _samples(spark, [("a", 0, 10), ("a", 10, 4)])
    t0 = int(T0.replace(tzinfo=dt.timezone.utc).timestamp())
    g = {r["t"] - t0: r["rate"] for r in S.range_at_grid(s, 30, 10, kind="gauge").collect()}
    c = {r["t"] - t0: r["rate"] for r in S.range_at_grid(s, 30, 10, kind="counter").collect()}
    assert g[10] == -0.6 and c[10] == 0.4

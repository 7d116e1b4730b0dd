"""Property tests (hypothesis) of latest-wins and range functions against brute force."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from changeflow.functions import series as S
from changeflow.operators.latest import precombine

SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
T0 = dt.datetime(2024, 1, 1)

rows_st = st.lists(st.tuples(
    st.sampled_from(["a", "b", "c"]),               # key
    st.one_of(st.none(), st.integers(0, 20)),       # ts seconds (null loses)
    st.integers(0, 2),                              # partition
    st.integers(0, 10_000),                         # offset
), min_size=1, max_size=40, unique_by=lambda r: r[3])


@SETTINGS
@given(rows=rows_st)
def test_precombine_matches_brute_force(spark, rows):
    data = [(k, None if t is None else T0 + dt.timedelta(seconds=t), p, o) for k, t, p, o in rows]
    df = spark.createDataFrame(data, "k string, ts timestamp, p int, o bigint")
    got = {r["k"]: r["o"] for r in precombine(df, ["k"], ["ts", "p", "o"]).collect()}
    want = {}
    for k, t, p, o in rows:
        key = (-1 if t is None else t, p, o)
        if k not in want or key > want[k][0]:
            want[k] = (key, o)
    assert got == {k: v[1] for k, v in want.items()}


series_st = st.lists(st.tuples(st.integers(0, 300), st.integers(0, 50)), min_size=1, max_size=30,
                     unique_by=lambda r: r[0])


@SETTINGS
@given(points=series_st, range_s=st.integers(2, 120), chunk_s=st.sampled_from([37, 100, 86_400]))
def test_increase_matches_brute_force(spark, points, range_s, chunk_s):
    pts = sorted(points)
    data = [(T0 + dt.timedelta(seconds=t), "m", {"p": "x"}, float(v)) for t, v in pts]
    df = spark.createDataFrame(data, "ts timestamp, metric string, labels map<string,string>, value double")
    t0 = int(T0.replace(tzinfo=dt.timezone.utc).timestamp())
    got = {r["t"] - t0: (r["increase"], r["rate"]) for r in S.increase(df, range_s, chunk_s=chunk_s).collect()}
    want = {}
    for i, (t, _) in enumerate(pts):
        idx = [j for j in range(len(pts)) if t - range_s < pts[j][0] <= t]
        if len(idx) < 2:
            want[t] = (None, None)
            continue
        vs = [pts[j][1] for j in idx]
        inc = float(sum((b - a) if b >= a else b for a, b in zip(vs, vs[1:])))
        want[t] = (inc, inc / (t - pts[idx[0]][0]))
    assert got == want


cond_st = st.lists(st.tuples(st.integers(0, 200), st.booleans()), min_size=1, max_size=40, unique_by=lambda r: r[0])


@SETTINGS
@given(points=cond_st, hold_s=st.integers(0, 60), step_s=st.sampled_from([5, 10]),
       chunk_s=st.sampled_from([7, 23, 86_400]))
def test_firing_matches_brute_force(spark, points, hold_s, step_s, chunk_s):
    pts = sorted(points)
    df = spark.createDataFrame([("s", t, a) for t, a in pts], "series string, t bigint, active boolean")
    got = sorted((r["t"], r["active_since"], r["state"])
                 for r in S.firing(df, hold_s, step_s, chunk_s=chunk_s, keys=["series"]).collect())
    want, start, prev = [], None, None
    for t, a in pts:
        if a and (prev is None or not prev[1] or t - prev[0] > step_s):
            start = t
        if a:
            want.append((t, start, "firing" if t - start >= hold_s else "pending"))
        prev = (t, a)
    assert got == want


table_rows_st = st.lists(st.tuples(
    st.sampled_from(["A", "B", "C"]),             # key
    st.one_of(st.none(), st.integers(0, 9)),      # ts seconds
    st.sampled_from(["2024-01-01", "2024-01-02"]),  # dt
    st.booleans(),                                # delete
), min_size=1, max_size=12)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=table_rows_st, scope=st.sampled_from(["partition", "global"]))
def test_table_with_deletes_matches_brute_force(spark, rows, scope):
    from changeflow.operators import table as tbl
    from changeflow.operators.table import TableSpec
    from changeflow.session import scratch_dir

    spec = TableSpec(root=scratch_dir(spark, "prop"), key_scope=scope, deletes="apply", min_deltas=2)
    schema = "tracking_id string, status string, ts timestamp, dt string, kafka_partition int, kafka_offset bigint"
    full = [(k, f"s{i}", None if t is None else T0 + dt.timedelta(seconds=t), d, 0, i, dl)
            for i, (k, t, d, dl) in enumerate(rows)]
    for b in range(3):
        part = [r for r in full if r[5] % 3 == b]
        good = spark.createDataFrame([r[:6] for r in part if not r[6]], schema)
        dels = spark.createDataFrame([r[:6] for r in part if r[6]], schema)
        tbl.apply_changes(spark, spec, tbl.change_batch(good, dels), b)
    got = sorted((r["dt"], r["tracking_id"], r["kafka_offset"]) for r in tbl.snapshot_view(spark, spec).collect())
    best = {}
    for k, _, ts, d, p, o, dl in full:
        g = (d, k) if scope == "partition" else k
        order = (-1 if ts is None else (ts - T0).total_seconds(), p, o)
        if g not in best or order > best[g][0]:
            best[g] = (order, (d, k, o), dl)
    want = sorted(v[1] for v in best.values() if not v[2])
    assert got == want


@SETTINGS
@given(points=series_st, step_s=st.sampled_from([5, 10, 30]), lookback_s=st.integers(1, 90),
       chunk_s=st.sampled_from([13, 40, 86_400]))
def test_instant_matches_brute_force(spark, points, step_s, lookback_s, chunk_s):
    pts = sorted(points)
    data = [(T0 + dt.timedelta(seconds=t), "m", {"p": "x"}, float(v)) for t, v in pts]
    df = spark.createDataFrame(data, "ts timestamp, metric string, labels map<string,string>, value double")
    t0 = int(T0.replace(tzinfo=dt.timezone.utc).timestamp())
    got = {r["t"] - t0: r["value"] for r in S.instant(df, step_s, lookback_s, chunk_s=chunk_s).collect()}
    want = {}
    lo = -(-(t0 + pts[0][0]) // step_s) * step_s - t0
    for g in range(lo, pts[-1][0] + lookback_s + 1, step_s):
        inside = [v for t, v in pts if g - lookback_s <= t <= g]
        if inside:
            want[g] = float(inside[-1])
    assert got == want

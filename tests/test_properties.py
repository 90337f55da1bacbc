"""Property tests for the two distributed rewrites: random inputs with many equal instants and alerts placed at,
just inside and just outside the window bounds, against plain Python."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidemark.operators.interval import correlate
from tidemark.operators.running import running_aggregate

T0 = dt.datetime(2024, 3, 1, 12, 0, 0)
HALF = dt.timedelta(minutes=30)
US = dt.timedelta(microseconds=1)

# offsets (minutes) drawn from a small set, so instants repeat often
minutes = st.sampled_from([0, 0, 0, 1, 15, 29, 30, 31, 45, 60, 61, 90, 120])
rows = st.lists(st.tuples(minutes, st.integers(-500, 500)), min_size=1, max_size=40)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=rows, ranges=st.integers(1, 6))
def test_running_sum_matches_python(spark, rows, ranges):
    data = [(i, T0 + dt.timedelta(minutes=m), Decimal(p) / 100) for i, (m, p) in enumerate(rows)]
    df = spark.createDataFrame(data, "id long, ts timestamp, v decimal(18,4)")
    got = {r.id: (r.c, r.p) for r in running_aggregate(df, ["ts", "id"], {"c": "v"}, {"p": "c"}, ranges).collect()}
    want, total, peak = {}, Decimal(0), None
    for i, ts, v in sorted(data, key=lambda r: (r[1], r[0])):
        total += v
        peak = total if peak is None else max(peak, total)
        want[i] = (total, peak)
    assert got == want


edges = st.sampled_from([-HALF - US, -HALF, -HALF + US, -US, dt.timedelta(0), US, HALF - US, HALF, HALF + US,
                         dt.timedelta(hours=2)])


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    trades=st.lists(minutes, min_size=1, max_size=12),
    alerts=st.lists(st.tuples(st.integers(0, 11), edges, st.integers(0, 15), st.sampled_from(["a", "b", "c"])),
                    max_size=25),
)
def test_correlation_matches_python(spark, trades, alerts):
    tr = [(i, T0 + dt.timedelta(minutes=m)) for i, m in enumerate(trades)]
    al = [(100 + j, tr[k % len(tr)][1] + off, lv, d) for j, (k, off, lv, d) in enumerate(alerts)]
    tdf = spark.createDataFrame(tr, "id long, entry_ts timestamp")
    adf = spark.createDataFrame(al, "id long, timestamp timestamp, rule_level int, rule_description string")
    got = {r.id: (r.n, r.nh, r.d) for r in correlate(
        tdf, adf, trade_key="id", trade_ts="entry_ts", group_cols=["id", "entry_ts"], alert_key="id",
        alert_ts="timestamp", alert_level="rule_level", alert_desc="rule_description", count_col="n",
        high_col="nh", desc_col="d", key_in_group=True, partitions=3).collect()}
    want = {}
    for i, ts in tr:
        hits = [a for a in al if ts - HALF <= a[1] <= ts + HALF]
        descs = sorted({a[3] for a in hits})
        want[i] = (len(hits), sum(1 for a in hits if a[2] >= 10), "; ".join(descs) if descs else None)
    assert got == want

"""Marts kept up load by load: equal to a full rebuild, reading the new load alone, made up for after a gap."""

from __future__ import annotations

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tidemark.operators import keyed_load
from tidemark.plans import incremental, marts, staging
from tidemark.session import scratch_path
from tidemark.sources import fixtures as fx

FULL = {
    "daily_pnl": lambda t, a: marts.daily_pnl(t), "trades_rollup": lambda t, a: marts.trades_rollup(staging.stg_trades(t)),
    "alerts_daily": lambda t, a: marts.alerts_daily(a), "alert_top_sources": lambda t, a: marts.alert_top_sources(a),
    "alerts_rollup": lambda t, a: marts.alerts_rollup(staging.stg_alerts(a)),
}


def test_second_day_equals_a_full_rebuild_and_reads_one_load(spark):
    sources = {"trades": (fx.trades(spark, SF_SMALL).drop("loaded_at"), ("trade_id", "source"), "entry_ts"),
               "alerts": (fx.alerts(spark, SF_SMALL).drop("loaded_at"), ("id",), "timestamp")}
    tables, base = {n: scratch_path(spark, n) for n in sources}, scratch_path(spark, "partials")

    def deliver(condition):
        for name, (rows, keys, ts) in sources.items():
            keyed_load.keyed_append(spark, tables[name], rows.where(condition(F.dayofmonth(ts))), keys)

    deliver(lambda day: day % 3 == 0)
    assert incremental.update(spark, tables, base) == {name: [1] for name in FULL}
    deliver(lambda day: day % 3 == 1)             # a day on which the marts are not built
    deliver(lambda day: F.lit(True))              # the rest, and the keys there already
    for name, mart in incremental.marts().items():
        loads = incremental.missing_loads(spark, tables[mart.source], f"{base}/{name}")
        assert loads == [2, 3]
        files = incremental.fresh_rows(spark, tables[mart.source], loads[1:])
        plan = files._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(load_id" in plan
        assert files.count() == keyed_load.last_load(spark, tables[mart.source]).inserted
    assert incremental.update(spark, tables, base) == {name: [2, 3] for name in FULL}
    assert incremental.update(spark, tables, base) == {name: [] for name in FULL}       # a rerun has nothing to do
    t, a = (keyed_load.read_table(spark, tables[n]) for n in ("trades", "alerts"))
    full = {n: v.withColumn("loaded_at", F.current_timestamp()) for n, v in (("trades", t), ("alerts", a))}
    for name, rebuild in FULL.items():
        got = incremental.read(spark, base, name, t if incremental.marts()[name].source == "trades" else a)
        want = rebuild(full["trades"], full["alerts"])
        assert sorted(got.columns) == sorted(want.columns)
        key = lambda r: tuple(str(x) for x in r)
        assert sorted(map(tuple, got.select(want.columns).collect()), key=key) == sorted(map(tuple, want.collect()), key=key)


def test_no_load_gives_an_empty_mart(spark):
    source = fx.trades(spark, SF_SMALL).drop("loaded_at").limit(0)
    assert incremental.read(spark, scratch_path(spark, "none"), "trades_rollup", source).count() == 0

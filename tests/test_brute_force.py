"""The distributed rewrites against direct computations on small inputs derived from the driver's tables, with a
hot instant that holds a third of the rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tidemark.operators.running import running_aggregate
from tidemark.plans import marts
from tidemark.sources import fixtures as fx

HOT = dt.datetime(2024, 1, 10, 12, 0, 0)


def _skewed_trades(spark):
    t = fx.trades(spark, SF_SMALL)
    return t.withColumn("entry_ts", F.when(F.col("id") % 3 == 0, F.lit(HOT)).otherwise(F.col("entry_ts")))


def _skewed_alerts(spark):
    a = fx.alerts(spark, SF_SMALL)
    near = F.lit(HOT) + F.make_dt_interval(secs=(F.col("id") % 7 - 3).cast("decimal(8,6)") * 600)
    return a.withColumn("timestamp", F.when(F.col("id") % 3 == 0, F.lit(HOT)).when(F.col("id") % 3 == 1, near)
                        .otherwise(F.col("timestamp")))


def test_running_sum_and_peak_equal_single_window(spark):
    t = _skewed_trades(spark).select("id", "entry_ts", "pnl_usd")
    got = {r.id: (r.c, r.p) for r in running_aggregate(
        t, ["entry_ts", "id"], {"c": "pnl_usd"}, {"p": "c"}, partitions=5).collect()}
    w = Window.orderBy("entry_ts", "id").rowsBetween(Window.unboundedPreceding, 0)
    naive = t.withColumn("c", F.sum("pnl_usd").over(w)).withColumn("p", F.max("c").over(w))
    want = {r.id: (r.c, r.p) for r in naive.collect()}
    assert got == want


def test_running_sum_over_many_ranges(spark):
    t = spark.range(0, 6000, 1, 8).select("id", (F.col("id") % 7).cast("decimal(20,8)").alias("x"))
    got = running_aggregate(t, ["id"], {"c": "x"}, {"p": "c"}, partitions=600)
    last = got.agg(F.max("c"), F.max("p"), F.count("*")).first()
    assert (last[0], last[1], last[2]) == (sum(i % 7 for i in range(6000)),) * 2 + (6000,)


def test_correlation_equals_nested_loop(spark):
    trades, alerts = _skewed_trades(spark), _skewed_alerts(spark)
    got = {r.trade_pk: (r.alerts_within_30min, r.high_severity_alerts, r.alert_descriptions)
           for r in marts.trading_vs_security(trades, alerts, partitions=6).collect()}
    tl = [(r.id, r.entry_ts) for r in trades.select("id", "entry_ts").collect()]
    al = [(r.timestamp, r.rule_level, r.rule_description)
          for r in alerts.select("timestamp", "rule_level", "rule_description").collect()]
    half = dt.timedelta(minutes=30)
    want = {}
    for tid, ts in tl:
        hits = [a for a in al if a[0] is not None and ts - half <= a[0] <= ts + half]
        descs = sorted({a[2] for a in hits if a[2] is not None})
        want[tid] = (len(hits), sum(1 for a in hits if a[1] >= 10), "; ".join(descs) if descs else None)
    assert got == want
    assert sum(v[0] for v in got.values()) > 0


def test_keyed_load_matches_first_row_per_key(spark):
    from tidemark.plans import scenarios

    rows = scenarios.load_trades(spark, SF_SMALL)
    v = scenarios.validated_trades(spark, SF_SMALL)
    w = Window.partitionBy("trade_id", "source").orderBy("exit_ts", "pnl_usd")
    want = v.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")
    assert rows.exceptAll(want).count() == 0 and want.exceptAll(rows).count() == 0


def test_running_sum_on_decimal_key(spark):
    t = _skewed_trades(spark).select("id", "pnl_usd")
    got = {r.id: r.c for r in running_aggregate(t, ["pnl_usd", "id"], {"c": "pnl_usd"}, partitions=4).collect()}
    w = Window.orderBy("pnl_usd", "id").rowsBetween(Window.unboundedPreceding, 0)
    assert got == {r.id: r.c for r in t.withColumn("c", F.sum("pnl_usd").over(w)).collect()}


def test_running_values_within_groups_split_a_hot_group(spark):
    t = spark.range(900).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 11).alias("g"),
        (F.col("id") % 13).alias("at"), "id", (F.col("id") * 37 % 101).alias("x"))
    for n in (1, 4, 40):
        got = running_aggregate(t, ["g", "at", "id"], {"c": "x"}, xors={"h": "x"}, within=["g"], partitions=n)
        w = Window.partitionBy("g").orderBy("at", "id").rowsBetween(Window.unboundedPreceding, 0)
        want = t.withColumn("c", F.sum("x").over(w)).withColumn("h", F.bit_xor("x").over(w))
        assert sorted(map(tuple, got.select("id", "c", "h").collect())) == sorted(
            map(tuple, want.select("id", "c", "h").collect()))
    assert running_aggregate(t.limit(0), ["g", "id"], {"c": "x"}, within=["g"], partitions=4).count() == 0


def test_a_hot_instant_is_cut_into_ranges(spark):
    from tidemark.operators.running import RANGE_ID, ranged

    t = spark.range(6000).select("id", F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("at"))
    sizes = [r["count"] for r in ranged(t, ["at", "id"], 12).groupBy(RANGE_ID).count().collect()]
    assert len(sizes) == 12 and max(sizes) < 2 * 500


def test_descriptions_split_a_hot_bucket_without_adaptive_execution(spark):
    from tidemark.operators.interval import SALTS, window_descriptions

    half = 30 * 60 * 1_000_000
    kw = dict(trade_key="id", trade_ts="entry_ts", alert_key="id", alert_ts="timestamp", alert_desc="rule_description",
              half_width_micros=half)
    trades, alerts = _skewed_trades(spark), _skewed_alerts(spark)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")       # the segments are shuffled as large ones would be
    try:
        found = window_descriptions(trades, alerts, **kw)
        got = {tuple(r) for r in found.distinct().collect()}
        # the rows of the hot bucket lie in many tasks of the join
        hot = trades.where(F.col("entry_ts") == F.lit(HOT)).select("id")
        tasks = found.select("id", F.spark_partition_id().alias("task")).join(F.broadcast(hot), "id").distinct()
        spread = {r.task: r["count"] for r in tasks.groupBy("task").count().collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    tl = [(r.id, r.entry_ts) for r in trades.select("id", "entry_ts").collect()]
    al = [(r.timestamp, r.rule_description) for r in alerts.select("timestamp", "rule_description").collect()
          if r.timestamp is not None and r.rule_description is not None]
    delta = dt.timedelta(microseconds=half)
    assert got == {(i, d) for i, ts in tl for at, d in al if abs(at - ts) <= delta}
    assert SALTS >= 8 and len(spread) == 8 and max(spread.values()) < 0.4 * sum(spread.values())

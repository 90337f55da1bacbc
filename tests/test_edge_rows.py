"""Hand-written edge rows (FIXTURES.md section 4)."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.functions.expressions import severity_label
from tidemark.operators import cleaning, keyed_load
from tidemark.plans import marts, quality
from tidemark.session import scratch_path
from tidemark.sources import alert_json, lake

TRADE_COLS = "trade_id string, source string, pnl_usd string, entry_ts string, exit_ts string"


def _reasons(spark, rows):
    df = spark.createDataFrame(rows, TRADE_COLS)
    return {r["trade_id"]: r["reject_reason"] for r in cleaning.with_reject_reason(df).collect()}


def test_pnl_rules(spark):
    rows = [(f"t{i}", "s", p, "2024-01-01 00:00:00", "2024-01-01 01:00:00")
            for i, p in enumerate(["n/a", "NaN", "", "inf", "12.5", "12d", "1f", "0x1p3", " +1.5e2 "])]
    got = _reasons(spark, rows)
    assert got["t0"] == got["t1"] == got["t2"] == cleaning.REASON_PNL
    assert got["t3"] is None  # infinity is numeric: kept, as the reference keeps it
    assert got["t4"] is None and got["t8"] is None
    assert got["t5"] == got["t6"] == got["t7"] == cleaning.REASON_PNL  # suffixes and hexadecimal are not numbers
    inf = spark.createDataFrame([rows[3]], TRADE_COLS)
    assert cleaning.validate_trades(inf, decimal_pnl=True).count() == 0


def test_time_rules(spark):
    rows = [
        ("eq", "s", "1", "2024-01-01 00:00:00", "2024-01-01 00:00:00"),
        ("rev", "s", "1", "2024-01-01 02:00:00", "2024-01-01 01:00:00"),
        ("bad", "s", "1", "yesterday", "2024-01-01 01:00:00"),
        ("mixed", "s", "1", "01/05/2024 10:00", "2024-01-05T11:00:00"),
    ]
    got = _reasons(spark, rows)
    assert got["eq"] == got["rev"] == got["bad"] == cleaning.REASON_TIME
    assert got["mixed"] is None  # each row is parsed on its own, whatever the first row's layout


def test_id_rules_and_first_rule_wins(spark):
    rows = [
        (None, "s", "1", "2024-01-01 00:00:00", "2024-01-01 01:00:00"),
        ("", "s", "1", "2024-01-01 00:00:00", "2024-01-01 01:00:00"),
        ("   ", "s", "1", "2024-01-01 00:00:00", "2024-01-01 01:00:00"),
        ("\t", "s", "1", "2024-01-01 00:00:00", "2024-01-01 01:00:00"),
        ("\t ", "s", "n/a", "2024-01-01 00:00:00", "2024-01-01 01:00:00"),
    ]
    df = spark.createDataFrame(rows, TRADE_COLS)
    counts = {r["reject_reason"]: r["row_count"] for r in cleaning.reject_counts(df).collect()}
    assert counts == {cleaning.REASON_ID: 4, cleaning.REASON_PNL: 1}


def _batch(spark, rows):
    return spark.createDataFrame(rows, "trade_id string, source string, pnl_usd double, exit_ts string")


def test_keyed_load_is_idempotent(spark):
    path = scratch_path(spark, "keyed")
    rows = [("a", "oanda", 1.0, "x"), ("a", "kraken", 2.0, "x"), ("a", "oanda", 0.5, "y"), ("b", "oanda", 3.0, "z")]
    first = keyed_load.keyed_append(spark, path, _batch(spark, rows).coalesce(1), ("trade_id", "source"), surrogate="id")
    assert (first.attempted, first.inserted, first.skipped) == (4, 3, 1)
    table = {(r.trade_id, r.source): r.pnl_usd for r in keyed_load.read_table(spark, path).collect()}
    assert table == {("a", "oanda"): 1.0, ("a", "kraken"): 2.0, ("b", "oanda"): 3.0}  # same id, two sources: both
    assert sorted(r.id for r in keyed_load.read_table(spark, path).collect()) == [1, 2, 3]
    again = keyed_load.keyed_append(spark, path, _batch(spark, rows), ("trade_id", "source"), surrogate="id")
    assert (again.attempted, again.inserted, again.skipped, again.rows_before, again.rows_after) == (4, 0, 4, 3, 3)

    more = keyed_load.keyed_append(spark, path, _batch(spark, [("c", "oanda", 1.0, "x"), (None, "oanda", 1.0, "x")]),
                                   ("trade_id", "source"), surrogate="id")
    assert (more.load_id, more.inserted, more.skipped, more.rows_after) == (3, 1, 1, 4)
    assert sorted(r.id for r in keyed_load.read_table(spark, path).collect()) == [1, 2, 3, 4]


def test_keyed_load_order_of_columns(spark):
    path = scratch_path(spark, "keyed_order")
    rows = [("a", "oanda", 1.0, "x"), ("a", "oanda", 0.5, "y"), ("a", "oanda", 9.0, "w"), ("b", "oanda", 3.0, "z")]
    keyed_load.keyed_append(spark, path, _batch(spark, rows), ("trade_id", "source"), order_by=("exit_ts",))
    got = {r.trade_id: r.pnl_usd for r in keyed_load.read_table(spark, path).collect()}
    assert got == {"a": 9.0, "b": 3.0}


def test_typed_trades(spark):
    row = {"trade_id": "t", "source": "s", "pnl_usd": "0.00001234", "hour_utc": "7.0", "entry_price": "1e3",
           "exit_price": "12d", "signal_score": None, "entry_ts": "2024-01-01 00:00:00", "exit_ts": "2024-01-01 01:00:00"}
    df = spark.createDataFrame([tuple(row.values())], ", ".join(f"{k} string" for k in row))
    got = cleaning.typed_trades(cleaning.validate_trades(df, decimal_pnl=True)).first()
    assert (got.pnl_usd, got.hour_utc, got.entry_price, got.exit_price) == (Decimal("0.00001234"), 7, 1000, None)
    assert got.indicators == "{}" and got.balance_at_entry is None and len(got) == 17


def test_snapshot_rerun_with_nothing_keeps_the_day(spark):
    base, day = scratch_path(spark, "exports"), dt.date(2024, 1, 1)
    df = spark.range(5)
    path = lake.snapshot(df, base, "t", day)
    assert lake.snapshot(df.limit(0), base, "t", day) is None
    assert spark.read.parquet(path).count() == 5


def test_lake_append_with_keys(spark):
    path = scratch_path(spark, "lake_keys")
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 1)), (1, dt.datetime(2024, 1, 1)), (2, dt.datetime(2024, 1, 2))],
                               "id int, ts timestamp")
    assert lake.append(df, path, "ts", dedup_keys=("id",)) == 1
    assert lake.append(df, path, "ts", dedup_keys=("id",)) is None
    assert sorted(r.id for r in lake.scan(spark, path).collect()) == [1, 2]
    assert lake.version_report(spark, {"none": scratch_path(spark, "nothing")}).count() == 0


def test_small_pnl_is_not_cut(spark):
    d = dt.datetime(2024, 1, 1)
    rows = [(i, "A", d + dt.timedelta(days=i), d + dt.timedelta(days=i, hours=1), Decimal(x))
            for i, x in enumerate(("0.00001", "0.00002", "0.00004"))]
    for kind in ("decimal(20,8)", "double"):
        t = spark.createDataFrame(rows, "id long, symbol string, entry_ts timestamp, exit_ts timestamp, "
                                        "pnl_usd decimal(20,8)").withColumn("pnl_usd", F.col("pnl_usd").cast(kind))
        assert marts.sharpe(t).first()[0] == pytest.approx(24.2487, abs=1e-4)
        one = t.where("id = 0").withColumn("hour_utc", F.hour("entry_ts"))
        assert marts.heatmap_view(one).first().avg_pnl_usd == 0.00001
    run = marts.running_pnl(t.withColumn("pnl_usd", F.col("pnl_usd").cast("decimal(20,8)"))).orderBy("id").collect()
    assert [r.cumulative_pnl for r in run] == [0.00001, 0.00003, 0.00007]


def test_lake_append_twice_and_as_of(spark):
    path = scratch_path(spark, "lake")
    df = spark.createDataFrame(
        [(1, dt.datetime(2024, 1, 1, 5)), (2, dt.datetime(2024, 1, 2, 6))], "id int, ts timestamp"
    )
    assert lake.append(df, path, "ts") == 1
    assert lake.append(df, path, "ts") == 2
    assert lake.scan(spark, path).count() == 4
    assert sorted(r.id for r in lake.as_of(spark, path, 1).collect()) == [1, 2]
    assert lake.append(df.limit(0), path, "ts") is None  # empty frames are not written
    assert lake.versions(spark, path) == [1, 2]


def test_lake_compaction_keeps_retained_versions(spark):
    path = scratch_path(spark, "lake_c")
    for day in (1, 2, 3):
        lake.append(spark.createDataFrame([(day, dt.datetime(2024, 1, day))], "id int, ts timestamp"), path, "ts")
    before = {v: sorted(r.id for r in lake.as_of(spark, path, v).collect()) for v in (2, 3)}
    out = scratch_path(spark, "lake_c_out")
    assert lake.compact(spark, path, retain=2, out=out) == 2
    assert lake.versions(spark, out) == [2, 3] and lake.versions(spark, path) == [1, 2, 3]
    after = {v: sorted(r.id for r in lake.as_of(spark, out, v).collect()) for v in (2, 3)}
    assert before == after == {2: [1, 2], 3: [1, 2, 3]}


def _lines(spark, lines):
    return spark.createDataFrame([(x,) for x in lines], "value string")


def test_alert_lookback_boundary(spark):
    now = dt.datetime(2024, 1, 2, 12, 0, 0)
    cutoff = alert_json.lookback_cutoff(24, now=now)
    at = '{"timestamp": "2024-01-01 12:00:00", "rule": {"id": 1}, "full_log": "a"}'
    older = '{"timestamp": "2024-01-01 11:59:59.999999", "rule": {"id": 1}, "full_log": "b"}'
    missing = '{"rule": {"id": 1}, "full_log": "c"}'
    got = alert_json.alerts_from_lines(_lines(spark, [at, older, missing, "", "{bad"]), cutoff=cutoff).collect()
    assert sorted(r.full_log for r in got) == ["a", "c"]
    assert [r.timestamp for r in got if r.full_log == "c"] == [None]  # kept, flagged by the not-null check
    report = alert_json.parse_report(_lines(spark, [at, older, missing, "", "{bad", "[1]"])).first()
    assert (report.blank_lines, report.parse_errors, report.alerts) == (1, 2, 3)


def test_alert_without_rule_and_src_ip_fallback(spark):
    import hashlib

    line = '{"timestamp": "2024-01-01 00:00:00", "data": {"srcip": "", "src_ip": "1.2.3.4"}, "full_log": "x"}'
    r = alert_json.alerts_from_lines(_lines(spark, [line])).first()
    assert r.rule_id is None and r.src_ip == "1.2.3.4" and r.rule_description == ""
    assert r.alert_id == hashlib.md5(b"2024-01-01 00:00:00Nonex").hexdigest()


def test_interval_boundaries_and_no_match(spark):
    t0 = dt.datetime(2024, 1, 1, 12, 0, 0)
    us = dt.timedelta(microseconds=1)
    half = dt.timedelta(minutes=30)
    trades = spark.createDataFrame([
        (1, "T1", "s", "X", "BUY", t0, t0 + half, Decimal("1.0000"), Decimal("0.0000")),
        (2, "T2", "s", "X", "BUY", t0 + dt.timedelta(days=3), t0 + dt.timedelta(days=3, hours=1),
         Decimal("1.0000"), Decimal("0.0000")),
    ], "id long, trade_id string, source string, symbol string, side string, entry_ts timestamp, exit_ts timestamp, "
       "pnl_usd decimal(18,4), signal_score decimal(18,4)")
    alerts = spark.createDataFrame([
        (10, t0 - half, 12, "b"), (11, t0 + half, 3, "a"), (12, t0 - half - us, 12, "z"), (13, t0 + half + us, 12, "z"),
    ], "id long, timestamp timestamp, rule_level int, rule_description string")
    got = {r.trade_pk: r for r in marts.trading_vs_security(trades, alerts).collect()}
    assert (got[1].alerts_within_30min, got[1].high_severity_alerts, got[1].alert_descriptions) == (2, 1, "a; b")
    assert (got[2].alerts_within_30min, got[2].high_severity_alerts, got[2].alert_descriptions) == (0, 0, None)


def _trades(spark, rows):
    return spark.createDataFrame(
        rows, "id long, symbol string, entry_ts timestamp, exit_ts timestamp, pnl_usd decimal(18,4)"
    )


def test_kpi_edges(spark):
    d = dt.datetime(2024, 1, 1, 10)
    one_day = _trades(spark, [(1, "A", d, d + dt.timedelta(minutes=5), Decimal("-1")),
                              (2, "A", d + dt.timedelta(hours=1), d + dt.timedelta(hours=2), Decimal("-2"))])
    k = marts.kpi(one_day).first()
    assert k.sharpe_ratio is None  # one trading day: no spread
    assert k.max_drawdown_pct == 0.0  # cumulative P&L never positive
    assert k.total_trades == 2 and k.best_symbol == "A"
    empty = marts.kpi(one_day.limit(0)).first()
    assert empty.total_trades == 0 and empty.win_rate_pct is None and empty.best_symbol is None


def test_row_count_drift():
    assert not quality.count_drifted(7, None) and not quality.count_drifted(0, 0)
    assert [quality.count_drifted(n, 100) for n in (49, 50, 150, 151)] == [True, False, False, True]


def test_strict_json_lines(spark):
    good = '{"timestamp": "2024-01-01 00:00:00", "full_log": "x"}'
    bad = [good + good, good + " xyz", good + ", " + good, good + "], [" + good, "{'full_log': 'x'}", "[1]", "7", '"x"', "{"]
    blank = ["", " \t ", "\u00a0", "\x1c"]
    report = alert_json.parse_report(_lines(spark, [good, " \t" + good + "\r", *bad, *blank])).first()
    assert (report.alerts, report.parse_errors, report.blank_lines) == (2, len(bad), len(blank))


def test_severity_labels(spark):
    df = spark.createDataFrame([(x,) for x in (0, 1, 5, 6, 9, 10, None)], "lv int")
    got = [r[0] for r in df.select(severity_label("lv")).collect()]
    assert got == ["unknown", "low", "low", "medium", "medium", "high", "unknown"]


def test_quality_suite_flags_missing_timestamp_and_skips_empty(spark):
    rows = [("a", None, 3), ("a", dt.datetime(2024, 1, 1), 16)]
    df = spark.createDataFrame(rows, "alert_id string, timestamp timestamp, rule_level int")
    res = {(r.check, r.column): r for r in quality.run_suite(df, "s", quality.ALERTS_SUITE).collect()}
    assert not res[("expect_column_values_to_not_be_null", "timestamp")].success
    assert res[("expect_column_values_to_be_unique", "alert_id")].failed_rows == 1
    assert res[("expect_column_values_to_be_between", "rule_level")].failed_rows == 1
    assert not res[("expect_table_columns_to_match_set", "agent_name,full_log,raw,rule_description,rule_id,src_ip")].success
    skipped = quality.run_suite(df.limit(0), "s", quality.ALERTS_SUITE, skip_when_empty=True).first()
    assert skipped.skipped and skipped.success


def test_quality_baseline_saved_even_on_failure(spark):
    path = scratch_path(spark, "baseline")
    trades = spark.createDataFrame([("t", "BUY", -1.0)], "trade_id string, side string, entry_price double")
    alerts = spark.createDataFrame([], "alert_id string, timestamp timestamp, rule_level int")
    with pytest.raises(quality.QualityFailed):
        quality.checkpoint_suites(spark, trades, alerts, path)
    assert quality.read_baseline(spark, path) == ({"stg_trades": 1, "stg_wazuh_alerts": 0}, 1)
    good = spark.createDataFrame([("t", "BUY", 1.0)], "trade_id string, side string, entry_price double")
    for run, n in ((2, 7), (3, 1)):       # each run is compared with the one before it
        rows = good.unionByName(spark.range(n - 1).selectExpr("'u' AS trade_id", "'BUY' AS side", "1.0D AS entry_price"))
        with pytest.raises(quality.QualityFailed):
            quality.checkpoint_suites(spark, rows, alerts, path)
        assert quality.read_baseline(spark, path) == ({"stg_trades": n, "stg_wazuh_alerts": 0}, run)


def test_missing_inputs_give_empty_frames(spark):
    from tidemark.sources import broker_csv

    assert alert_json.read_lines(spark, "/nonexistent/tidemark/alerts").count() == 0
    empty = broker_csv.read_broker_csv(spark, "/nonexistent/tidemark/trades.csv", "oanda")
    assert empty.count() == 0 and "indicators" in empty.columns


def test_broker_csv_packs_extras_and_rejects_missing_shared(spark, tmp_path):
    from tidemark.sources import broker_csv

    header = ",".join(broker_csv.SHARED_COLS) + ",rsi,note"
    row = ",".join(["T1", "EUR/USD", "BUY", "win", "tp", "2024-01-01 00:00:00", "2024-01-01 01:00:00", "0",
                    "1", "2", "3", "4", "5", "6", "7"]) + ",30.5,NA"
    p = tmp_path / "b.csv"
    p.write_text(header + "\n" + row + "\n")
    r = broker_csv.read_broker_csv(spark, str(p), "oanda", {"rsi": "double"}).first()
    assert r.source == "oanda" and r.indicators == '{"rsi":30.5}'  # NA is missing: left out
    bad = tmp_path / "bad.csv"
    bad.write_text("trade_id,symbol\nT1,X\n")
    with pytest.raises(broker_csv.MissingColumns):
        broker_csv.read_broker_csv(spark, str(bad), "oanda")


def test_security_null_severity_has_no_top_ip(spark):
    d = dt.datetime(2024, 1, 1, 1)
    fct = spark.createDataFrame(
        [(d, "high", "1.1.1.1"), (d, "high", "2.2.2.2"), (d, "high", "2.2.2.2"), (d, None, "3.3.3.3")],
        "alert_ts timestamp, severity_label string, src_ip string",
    )
    got = {r.severity_label: (r.alert_count, r.top_src_ip) for r in marts.security(fct).collect()}
    assert got == {"high": (3, "2.2.2.2"), None: (1, None)}


def test_best_symbol_ties_and_null_group(spark):
    d = dt.datetime(2024, 1, 1)
    t = _trades(spark, [(1, "B", d, d, Decimal("5")), (2, "A", d, d, Decimal("5")), (3, None, d, d, Decimal("5"))])
    assert marts.best_symbol(t).first().best_symbol == "A"
    t2 = _trades(spark, [(1, "B", d, d, Decimal("1")), (2, None, d, d, Decimal("9"))])
    assert marts.best_symbol(t2).first().best_symbol is None  # the NULL symbol is a group of its own


def test_decimal_rounding_half_up(spark):
    from tidemark.functions.expressions import round_half_up_ratio

    df = spark.createDataFrame([(1, 8), (1, 32), (1, 4000), (2, 3), (0, 0)], "n long, d long")
    got = [r[0] for r in df.select(round_half_up_ratio(F.col("n") * 100, F.col("d"), 2)).collect()]
    assert got == [12.5, 3.13, 0.03, 66.67, None]


def test_grouped_correlation_merges_copies(spark):
    from tidemark.operators.interval import correlate

    t0 = dt.datetime(2024, 1, 1, 12)
    trades = spark.createDataFrame(
        [(1, "T1", t0), (2, "T1", t0), (3, "T2", t0 + dt.timedelta(hours=5))], "id long, trade_id string, entry_ts timestamp")
    alerts = spark.createDataFrame(
        [(10, t0 + dt.timedelta(minutes=5), 12, "x"), (11, t0 - dt.timedelta(minutes=10), 2, "y")],
        "id long, timestamp timestamp, rule_level int, rule_description string")
    got = {r.trade_id: (r.alerts_within_30min, r.high_severity_alerts, r.alert_descriptions) for r in correlate(
        trades, alerts, trade_key="id", trade_ts="entry_ts", group_cols=["trade_id", "entry_ts"], alert_key="id",
        alert_ts="timestamp", alert_level="rule_level", alert_desc="rule_description").collect()}
    assert got == {"T1": (4, 2, "x; y"), "T2": (0, 0, None)}  # two copies: each pair counted per copy

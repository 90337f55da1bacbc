"""Ingest, load, lake, quality and streaming runs over the driver's tables.

Each function takes (spark, sf_dir), writes only under a fresh folder of the shared checkpoint area, and returns
a DataFrame read back from what it wrote, so the whole path (text or CSV files -> parse -> clean -> load ->
read) is exercised on all rows of the inputs.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import cleaning, keyed_load
from tidemark.plans import quality
from tidemark.session import scratch_path
from tidemark.sources import alert_json, broker_csv, lake
from tidemark.sources import fixtures as fx
from tidemark.streaming import alerts as alert_stream

TS_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
TRADE_KEYS = ("trade_id", "source")
TRADE_ORDER = ("exit_ts", "pnl_usd")     # a broker lists its trades as they close
PRICE_START = dt.date(2024, 1, 8)


# ---- broker files (S1-S4) ------------------------------------------------------------------------------------

BROKER_EXTRAS = {
    # broker -> indicator columns written to its file and their types
    "oanda": {"k": "int", "regime": "string"},
    "kraken": {"k": "int", "grade": "string"},
    "paper": {},
}


def _broker_rows(trades: DataFrame, source: str) -> DataFrame:
    k = F.get_json_object("indicators", "$.k").cast("int")
    extras = {
        "k": k,
        "regime": F.when(k % 3 == 0, None).otherwise(F.concat(F.lit("r"), (k % 3).cast("string"))),
        "grade": F.when(k % 4 == 0, "NA").otherwise(F.concat(F.lit("g"), (k % 4).cast("string"))),
    }
    kinds = dict(trades.dtypes)
    text = lambda c: F.col(c).cast("string").alias(c) if kinds[c].startswith("decimal") else F.col(c)
    cols = [text(c) for c in broker_csv.SHARED_COLS] + [extras[c].alias(c) for c in BROKER_EXTRAS[source]]
    return trades.where(F.col("source") == source).select(*cols)


def write_broker_files(spark: SparkSession, sf_dir: str) -> list[tuple[str, str, dict]]:
    trades = fx.trades(spark, sf_dir)
    base = scratch_path(spark, "brokers")
    files = []
    for source, types in BROKER_EXTRAS.items():
        path = f"{base}/{source}"
        (_broker_rows(trades, source).write.option("header", True).option("timestampFormat", TS_TEXT)
         .mode("overwrite").csv(path))
        files.append((path, source, types))
    return files


def scan_trades_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return broker_csv.read_brokers(spark, write_broker_files(spark, sf_dir)).select(
        "trade_id", "source", "symbol", "side", "entry_ts", "exit_ts", "pnl_usd", "indicators"
    )


def union_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The brokers' files as one frame, by source."""
    rows = broker_csv.read_brokers(spark, write_broker_files(spark, sf_dir))
    return rows.groupBy("source").agg(
        F.count(F.lit(1)).alias("trades"), F.count_distinct("trade_id").alias("ids"),
        F.sum(cleaning.number("pnl_usd", "decimal(20,8)")).cast("double").alias("pnl"))


def empty_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of three brokers only one has delivered its files; the others, a folder that isn't there and a pattern that
    matches nothing, give no rows and no failure."""
    there = write_broker_files(spark, sf_dir)[0]
    base = scratch_path(spark, "nothing")
    files = [there, (f"{base}/absent", "kraken", {}), (f"{base}/*.csv", "paper", {})]
    return broker_csv.read_brokers(spark, files).groupBy("source").agg(F.count(F.lit(1)).alias("trades"))


def pack_indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_trades_csv(spark, sf_dir).select("trade_id", "source", "indicators")


# ---- cleaning (P1-P4) ----------------------------------------------------------------------------------------

def _dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.trades_dirty(spark, sf_dir).drop("trade_id_raw")


def validated_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.validate_trades(_dirty(spark, sf_dir))


def validate_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.reject_counts(_dirty(spark, sf_dir))


# ---- alert lines (S5, S6, P5-P10) ----------------------------------------------------------------------------

def write_alert_lines(spark: SparkSession, sf_dir: str) -> str:
    """The alert text as files, the way the alert manager writes them."""
    base = scratch_path(spark, "alert_lines")
    fx.alert_lines(spark, sf_dir).select("line").write.mode("overwrite").text(base)
    return base


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alert_json.read_lines(spark, write_alert_lines(spark, sf_dir))


def alert_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alert_json.alerts_from_lines(_lines(spark, sf_dir))


def alert_parse_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alert_json.parse_report(_lines(spark, sf_dir))


def alert_lookback(spark: SparkSession, sf_dir: str, hours: int = 24) -> DataFrame:
    """Alerts of the last `hours` before the newest alert (the batch job uses the wall clock instead)."""
    lines = _lines(spark, sf_dir)
    newest = alert_json.alerts_from_lines(lines).agg(F.max("timestamp")).first()[0]
    cutoff = alert_json.lookback_cutoff(hours, now=newest) if newest else None
    return alert_json.alerts_from_lines(lines, cutoff=cutoff)


# ---- prices (S7) ---------------------------------------------------------------------------------------------

def benchmark_ingest(spark: SparkSession, sf_dir: str, start: dt.date = PRICE_START) -> DataFrame:
    p = fx.benchmark_prices(spark, sf_dir)
    return p.where((F.col("date") >= F.lit(start)) & F.col("symbol").isNotNull() & (F.col("symbol") != "")).select(
        "date", "symbol", F.col("close_price").cast("double").alias("close_price")
    )


# ---- keyed loads (L1-L5) -------------------------------------------------------------------------------------

def _trade_loads(spark: SparkSession, sf_dir: str) -> tuple[str, list[keyed_load.LoadStats]]:
    """Three daily runs: the first sees only the oanda file, the next two see both brokers. The validated batch is
    written once as the day's snapshot and the loads read it from there."""
    snap = lake.snapshot(validated_trades(spark, sf_dir), scratch_path(spark, "exports"), "trades", dt.date(2024, 2, 1))
    clean = spark.read.parquet(snap)
    path = scratch_path(spark, "raw_trades")
    stats = [
        keyed_load.keyed_append(spark, path, batch, TRADE_KEYS, order_by=TRADE_ORDER)
        for batch in (clean.where(F.col("source") == "oanda"), clean, clean)
    ]
    return path, stats


def load_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, _ = _trade_loads(spark, sf_dir)
    return keyed_load.read_table(spark, path).select("trade_id", "source", "pnl_usd", "entry_ts", "exit_ts")


def load_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, stats = _trade_loads(spark, sf_dir)
    return keyed_load.stats_frame(spark, stats)


def load_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed_load.attempted_by_source(validated_trades(spark, sf_dir))


def load_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    alerts = alert_ingest(spark, sf_dir).withColumn("day", alert_json.alert_day())
    path = scratch_path(spark, "raw_alerts")
    for _ in range(2):
        keyed_load.keyed_append(spark, path, alerts, ("alert_id",), prune_col="day")
    return keyed_load.read_table(spark, path).select(*alert_json.ALERT_COLUMNS)


def load_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    prices = fx.benchmark_prices(spark, sf_dir)
    path = scratch_path(spark, "raw_prices")
    for _ in range(2):
        keyed_load.keyed_append(spark, path, prices, ("date", "symbol"))
    return keyed_load.read_table(spark, path).select("date", "symbol", "close_price")


# ---- snapshots and the lake (L8-L13, S8, S9) -----------------------------------------------------------------

def snapshot_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = validated_trades(spark, sf_dir)
    base = scratch_path(spark, "exports")
    run_date = dt.date(2024, 2, 1)
    out = None
    for _ in range(2):  # a rerun on the same day replaces the day's snapshot
        out = lake.snapshot(clean, base, "trades", run_date)
    return spark.read.parquet(out)


def lake_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = fx.trades(spark, sf_dir)
    path = scratch_path(spark, "lake_trades")
    lake.append(clean, path, "entry_ts")
    lake.append(clean, path, "entry_ts")
    return lake.scan(spark, path)


def _one_append(df: DataFrame, name: str, ts: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    lake.append(df, path, ts)
    return lake.scan(df.sparkSession, path)


def lake_scan_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _one_append(fx.trades(spark, sf_dir), "lake_trades", "entry_ts")


def lake_scan_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _one_append(alert_ingest(spark, sf_dir), "lake_alerts", "timestamp")


def lake_scan_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _one_append(fx.benchmark_prices(spark, sf_dir), "lake_prices", "date")


def _alert_syncs(spark: SparkSession, sf_dir: str, bounds: tuple[int, ...]) -> str:
    """Alerts appended in syncs of consecutive day-of-month ranges ending at each bound."""
    alerts = alert_ingest(spark, sf_dir)
    path = scratch_path(spark, "lake_alerts")
    lo = 0
    for hi in bounds:
        dom = F.coalesce(F.dayofmonth("timestamp"), F.lit(1))      # alerts without a time come with the first sync
        lake.append(alerts.where((dom > lo) & (dom <= hi)), path, "timestamp")
        lo = hi
    return path


def lake_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _alert_syncs(spark, sf_dir, (15, 31))
    return lake.as_of(spark, path, 1)


def lake_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {
        "trades": scratch_path(spark, "lake_trades"),
        "wazuh_alerts": _alert_syncs(spark, sf_dir, (15, 31)),
        "benchmark_prices": scratch_path(spark, "lake_prices"),
    }
    clean = fx.trades(spark, sf_dir)
    lake.append(clean, tables["trades"], "entry_ts")
    lake.append(clean, tables["trades"], "entry_ts")
    lake.append(fx.benchmark_prices(spark, sf_dir), tables["benchmark_prices"], "date")
    return lake.version_report(spark, tables)


def lake_compact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three syncs, and a copy that keeps the two newest versions: every row is still there, and reading as of the
    oldest retained version gives the rows of the first two syncs."""
    path = _alert_syncs(spark, sf_dir, (10, 20, 31))
    out = scratch_path(spark, "lake_alerts_compact")
    lake.compact(spark, path, retain=2, out=out)
    return lake.scan(spark, out)


# ---- quality (Q1-Q10) ----------------------------------------------------------------------------------------

def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    trades, alerts = fx.trades(spark, sf_dir), alert_ingest(spark, sf_dir)
    return quality.checkpoint_suites(
        spark, trades, alerts, scratch_path(spark, "quality_baseline"), raise_on_failure=False
    )


def quality_three_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The row-count check of three runs (all trades, a tenth, all) against each one's last run: run, row_count,
    last_count, success. A failing run raises after its count is saved, so the next is compared with it."""
    trades, alerts = fx.trades(spark, sf_dir), spark.createDataFrame([], alert_json.ALERT_SCHEMA)
    path, out = scratch_path(spark, "quality_baseline"), []
    for run, rows in enumerate((trades, trades.where("id % 10 = 0"), trades), start=1):
        last = quality.read_baseline(spark, path)[0].get("stg_trades")
        try:
            quality.checkpoint_suites(spark, rows, alerts, path)
            ok = True
        except quality.QualityFailed:
            ok = False
        counts, number = quality.read_baseline(spark, path)
        assert number == run
        out.append((run, counts["stg_trades"], last, ok))
    return spark.createDataFrame(out, "run int, row_count long, last_count long, success boolean")


def model_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark import catalog
    facts = {"fct_trades": catalog._fct_trades(spark, sf_dir, ()), "fct_alerts": catalog._fct_alerts(spark, sf_dir, ()),
             "dim_date": catalog._dim_date(spark, sf_dir)}
    out = None
    for name, df in facts.items():
        part = quality.run_suite(df, name, quality.MODEL_CHECKS[name])
        out = part if out is None else out.unionByName(part)
    return out.drop("skipped")


def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows written per table, their lake version, and each suite's status, as one frame."""
    clean, alerts = fx.trades(spark, sf_dir), alert_ingest(spark, sf_dir)
    prices = fx.benchmark_prices(spark, sf_dir)
    rows, versions = {}, {}
    for name, df, ts in (("trades", clean, "entry_ts"), ("wazuh_alerts", alerts, "timestamp"),
                         ("benchmark_prices", prices, "date")):
        path = scratch_path(spark, f"lake_{name}")
        versions[name] = lake.append(df, path, ts)
        rows[name] = lake.scan(spark, path).count()
    report = quality.checkpoint_suites(
        spark, clean, alerts, scratch_path(spark, "quality_baseline"), raise_on_failure=False
    )
    status = report.groupBy("suite").agg(F.bool_and("success").alias("success"))
    tables = spark.createDataFrame(
        [(k, int(rows[k]), versions[k]) for k in rows], "table string, rows_written long, version int"
    )
    return tables.join(
        status.select(F.when(F.col("suite") == "stg_trades", "trades").otherwise("wazuh_alerts").alias("table"),
                      F.col("success").alias("checks_passed")),
        "table", "left",
    )


# ---- streams (ST1, ST2) --------------------------------------------------------------------------------------

def _stream_syncs(spark: SparkSession, sf_dir: str) -> Iterator[str]:
    """Four syncs of alert text, one after the other: the folder they land in, after each. Every seventh line is held back:
    those of day 20 come with the third sync and those of day 30 with the fourth, less than 24 hours late; those of the
    first five days come with the fourth, weeks late. The lines are sorted into syncs once, a folder each; a sync's files
    are written from its folder by as many tasks as its size asks for."""
    lines = fx.alert_lines(spark, sf_dir)
    ev = fx.table(spark, sf_dir, "events").select("event_id", F.dayofmonth("ts").alias("dom"))
    held = F.col("event_id") % 7 == 3
    sync = (F.when(held & ((F.col("dom") <= 5) | (F.col("dom") == 30)), 4).when(held & (F.col("dom") == 20), 3)
            .when(F.col("dom") <= 10, 1).when(F.col("dom") <= 20, 2).otherwise(3))
    sorted_in = scratch_path(spark, "alert_syncs")
    lines.join(ev, "event_id").select("line", sync.alias("sync")).write.partitionBy("sync").parquet(sorted_in)
    tagged = spark.read.schema("line string, sync int").parquet(sorted_in)
    path = scratch_path(spark, "alert_sync")
    for number in range(1, 5):
        tagged.where(F.col("sync") == number).select("line").write.mode("append").text(path)
        yield path


def _stream_input(spark: SparkSession, sf_dir: str) -> str:
    """The folder with all four syncs."""
    *_, path = _stream_syncs(spark, sf_dir)
    return path


def stream_parse_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = _stream_input(spark, sf_dir)
    out, ckpt = scratch_path(spark, "stream_counts"), scratch_path(spark, "stream_counts_ckpt")
    alert_stream.parse_counts_stream(spark, src, out, ckpt)
    return spark.read.parquet(out)


def stream_alert_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, ckpt = scratch_path(spark, "stream_alerts"), scratch_path(spark, "stream_alerts_ckpt")
    for src in _stream_syncs(spark, sf_dir):     # a micro-batch per sync, however many files it has
        alert_stream.ingest_alerts(spark, src, out, ckpt, one_batch=True)
    return keyed_load.read_table(spark, out).select(*alert_json.ALERT_COLUMNS)


def stream_alerts_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = _stream_input(spark, sf_dir)
    out, ckpt = scratch_path(spark, "stream_daily"), scratch_path(spark, "stream_daily_ckpt")
    alert_stream.daily_counts_stream(spark, src, out, ckpt)
    return spark.read.parquet(out)



def _checks_of(kind: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """One check kind of both suites, run over the clean trades and the ingested alerts."""
    trades, alerts = fx.trades(spark, sf_dir), alert_ingest(spark, sf_dir)
    t = quality.run_suite(trades, "stg_trades", [c for c in quality.TRADES_SUITE if c.kind == kind])
    a = quality.run_suite(alerts, "stg_wazuh_alerts", [c for c in quality.ALERTS_SUITE if c.kind == kind])
    return t.unionByName(a).drop("skipped")


def check_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _checks_of("not_null", spark, sf_dir)


def check_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _checks_of("unique", spark, sf_dir)


def check_in_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _checks_of("in_set", spark, sf_dir)


def check_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _checks_of("between", spark, sf_dir)


def check_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trade suite's column set against the raw broker rows (which lack most columns) and the clean trades."""
    dirty = _dirty(spark, sf_dir)
    check = [c for c in quality.TRADES_SUITE if c.kind == "columns"]
    return quality.run_suite(dirty, "trades_dirty", check).unionByName(
        quality.run_suite(fx.trades(spark, sf_dir), "stg_trades", check)).drop("skipped")


def check_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs: the first (clean trades) sets the baseline, the second (validated broker rows) is checked
    against half to one and a half times it."""
    path = scratch_path(spark, "quality_baseline")
    check = [c for c in quality.TRADES_SUITE if c.kind == "row_count"]
    out = []
    for run, df in enumerate((fx.trades(spark, sf_dir), validated_trades(spark, sf_dir)), start=1):
        previous = quality.read_baseline(spark, path)[0].get("stg_trades")
        report, n = quality.run_suite_counted(df, "stg_trades", check, previous)
        out.append(report.withColumn("run", F.lit(run)))
        quality.save_baseline(spark, path, {"stg_trades": n}, run)
    return out[0].unionByName(out[1]).drop("skipped")


def models_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole model build over the raw tables, written under a fresh warehouse folder: rows per model."""
    from tidemark.plans import pipeline

    paths = pipeline.build_models(
        spark, fx.trades(spark, sf_dir), fx.alerts(spark, sf_dir), fx.benchmark_prices(spark, sf_dir),
        fx.ip_geo(spark, sf_dir), scratch_path(spark, "warehouse"),
    )
    return pipeline.model_rows(spark, paths)


# ---- the daily run -------------------------------------------------------------------------------------------------

def _daily(spark: SparkSession, sf_dir: str, days: int = 1) -> dict[str, str]:
    """Daily runs over the same inputs (a second one loads nothing new): model -> path of the last run's tables."""
    from tidemark.plans import daily

    inputs = daily.Inputs(write_broker_files(spark, sf_dir), write_alert_lines(spark, sf_dir),
                          fx.benchmark_prices(spark, sf_dir), fx.ip_geo(spark, sf_dir))
    base = scratch_path(spark, "daily")
    paths = {}
    for day in range(days):
        run_date = dt.date(2024, 2, 1) + dt.timedelta(days=day)
        paths = daily.run(spark, inputs, base, run_date=run_date, raise_on_failure=False).models
    return paths


def daily_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(_daily(spark, sf_dir, days=2)["mart_daily_pnl"])


def daily_run_security(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(_daily(spark, sf_dir)["mart_security"])


def daily_run_cross_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(_daily(spark, sf_dir)["mart_cross_domain"])


def daily_run_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two days: on the first neither broker nor alert file is delivered, on the second all are. Rows per loaded table
    after each day."""
    from tidemark.plans import daily

    brokers, lines = write_broker_files(spark, sf_dir), write_alert_lines(spark, sf_dir)
    nowhere = scratch_path(spark, "not_delivered")
    missing = [(f"{nowhere}/{source}", source, types) for _, source, types in brokers]
    base = scratch_path(spark, "daily_empty")
    out = None
    for day, (files, text) in enumerate(((missing, f"{nowhere}/alerts"), (brokers, lines)), start=1):
        inputs = daily.Inputs(files, text, fx.benchmark_prices(spark, sf_dir), fx.ip_geo(spark, sf_dir))
        ran = daily.run(spark, inputs, base, run_date=dt.date(2024, 2, day), raise_on_failure=False)
        for name, rows in ran.rows.items():
            one = spark.createDataFrame([(day, name, rows)], "run int, table string, rows long")
            out = one if out is None else out.unionByName(one)
    return out


# ---- marts kept up load by load --------------------------------------------------------------------------------------

def _kept_up(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The mart after two loads of its source's table, with its partials brought up to date after each: first the rows
    of even days, then all rows (so the second load has days before, between and after those of the first)."""
    from tidemark.plans import incremental

    mart = incremental.marts()[name]
    rows, keys, ts = ((fx.trades(spark, sf_dir), TRADE_KEYS, "entry_ts") if mart.source == "trades"
                      else (fx.alerts(spark, sf_dir), ("id",), "timestamp"))
    rows = rows.drop("loaded_at")
    table, base = scratch_path(spark, f"raw_{mart.source}"), scratch_path(spark, "partials")
    even = F.coalesce(F.dayofmonth(ts) % 2 == 0, F.lit(False))
    for batch in (rows.where(even), rows):
        keyed_load.keyed_append(spark, table, batch, keys)
        incremental.update(spark, {"trades": table, "alerts": table}, base, only=(name,))
    return incremental.read(spark, base, name, keyed_load.read_table(spark, table))


def incremental_daily_pnl(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _kept_up(spark, sf_dir, "daily_pnl")


def incremental_trades_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _kept_up(spark, sf_dir, "trades_rollup")


def incremental_alerts_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _kept_up(spark, sf_dir, "alerts_daily")


def incremental_alert_top_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _kept_up(spark, sf_dir, "alert_top_sources")


def incremental_alerts_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _kept_up(spark, sf_dir, "alerts_rollup")

"""The daily run, end to end: broker files, alert lines and prices to checked loads, lake tables and models.

Order of a run: read and validate the broker rows, write the day's snapshot, load trades (typed, with surrogate ids
and the load time), alerts and prices into their keyed tables, append the new rows to the lake, check the loaded
tables, bring the partial aggregates up to date with the new loads, build the models into a folder of the run, and only
if the checks and the models' own column tests pass name that folder as the published one. Every step reads what the step before has written.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import cleaning, keyed_load
from tidemark.plans import incremental, pipeline, quality
from tidemark.sources import alert_json, broker_csv, lake


@dataclass(frozen=True)
class Inputs:
    brokers: Sequence[tuple[str, str, Mapping[str, str] | None]]      # path, source, types of extra columns
    alert_lines: str
    prices: DataFrame                                                 # date, symbol, close_price
    ip_geo: DataFrame


@dataclass(frozen=True)
class Result:
    loads: dict[str, keyed_load.LoadStats]
    rows: dict[str, int]                                              # of each loaded table after the run
    versions: dict[str, int | None]
    checks: DataFrame
    models: dict[str, str]
    published: bool


def run(spark: SparkSession, inputs: Inputs, base: str, run_date: dt.date | None = None,
        now: dt.datetime | None = None, lookback_hours: int | None = None, raise_on_failure: bool = True) -> Result:
    """`lookback_hours`: skip alerts older than that before `now` (all are taken without it)."""
    base = base.rstrip("/")
    run_date = run_date or dt.date.today()
    raw = {name: f"{base}/raw/{name}" for name in ("trades", "alerts", "prices")}

    clean = cleaning.validate_trades(broker_csv.read_brokers(spark, inputs.brokers), decimal_pnl=True)
    typed = cleaning.typed_trades(clean)
    snapshot = lake.snapshot(typed, f"{base}/exports", "trades", run_date)
    lines = alert_json.read_lines(spark, inputs.alert_lines)
    cutoff = alert_json.lookback_cutoff(lookback_hours, now) if lookback_hours is not None else None
    alerts = alert_json.alerts_from_lines(lines, cutoff).withColumn("day", alert_json.alert_day())

    loads = {}
    if snapshot:
        loads["trades"] = keyed_load.keyed_append(spark, raw["trades"], spark.read.parquet(snapshot),
                                                  ("trade_id", "source"), now, surrogate="id")
    loads["alerts"] = keyed_load.keyed_append(spark, raw["alerts"], alerts, ("alert_id",), now, prune_col="day",
                                              surrogate="id")
    loads["prices"] = keyed_load.keyed_append(spark, raw["prices"], inputs.prices, ("date", "symbol"), now)

    # tables exist with their declared columns from the first run, whatever was delivered
    schemas = {"trades": keyed_load.table_schema(typed, "id"), "alerts": keyed_load.table_schema(alerts, "id"),
               "prices": keyed_load.table_schema(inputs.prices)}
    tables = {name: keyed_load.read_table(spark, path, schemas[name]) for name, path in raw.items()}
    versions = {}
    for name, ts in (("trades", "entry_ts"), ("alerts", "timestamp"), ("prices", "date")):
        if name in loads and loads[name].inserted:
            fresh = tables[name].where(F.col(keyed_load.LOAD_ID) == loads[name].load_id)
            versions[name] = lake.append(fresh.drop("day"), f"{base}/lake/{name}", ts)

    checks = quality.checkpoint_suites(spark, tables["trades"], tables["alerts"], f"{base}/quality_baseline",
                                       raise_on_failure=raise_on_failure)
    # M9 groups trades by their attributes: its key must be unique, as the load guarantees
    keys = quality.run_suite(tables["trades"].select(F.struct("trade_id", "source").alias("key")), "trade_key",
                             (quality.Check("unique", "key"),))
    # marts that are merges of partial aggregates read the new load alone
    incremental.update(spark, raw, f"{base}/partials")
    kept_up = {model: incremental.read(spark, f"{base}/partials", name, tables[source]) for model, name, source in (
        ("mart_daily_pnl", "daily_pnl", "trades"), ("mart_iceberg_trades", "trades_rollup", "trades"),
        ("mart_iceberg_alerts", "alerts_rollup", "alerts"))}
    models = pipeline.build_models(spark, tables["trades"], tables["alerts"], tables["prices"], inputs.ip_geo,
                                   f"{base}/warehouse/run_date={run_date.isoformat()}", kept_up=kept_up)
    tests = pipeline.model_tests(spark, models)
    report = checks.drop("skipped").unionByName(keys.drop("skipped")).unionByName(tests)
    ok = report.where(~F.col("success")).isEmpty()
    if ok:
        spark.createDataFrame([(run_date, models["mart_kpi"].rsplit("/", 1)[0])], "run_date date, folder string") \
            .coalesce(1).write.mode("append").parquet(f"{base}/published")
    elif raise_on_failure:
        raise quality.QualityFailed("model checks failed")
    rows = {name: loads[name].rows_after if name in loads else tables[name].count() for name in raw}
    return Result(loads, rows, versions, report, models, ok)

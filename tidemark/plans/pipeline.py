"""The model build: staging as views, dimensions, facts and marts as tables, in dependency order.

Staging models stay lazy DataFrames (views). Every table model is written once under `out_dir/<model>` and read
back, and the models downstream of it read the written table, so each is computed once per run and a lost
executor never sends a later model back to the raw inputs. The ingest runs that produce the raw tables are in
`tidemark.plans.scenarios`.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans import marts, quality, staging, star

# Build order of the table models, dependencies first.
TABLE_MODELS: tuple[str, ...] = (
    "dim_date", "dim_symbol", "dim_source", "dim_rule", "fct_trades", "fct_alerts",
    "mart_daily_pnl", "mart_kpi", "mart_heatmap", "mart_security", "mart_cross_domain", "mart_attack_geo",
    "mart_iceberg_trades", "mart_iceberg_alerts", "mart_iceberg_prices",
)


def build_models(
    spark: SparkSession,
    raw_trades: DataFrame,
    raw_alerts: DataFrame,
    raw_prices: DataFrame,
    ip_geo: DataFrame,
    out_dir: str,
    calendar: tuple[dt.date, dt.date] | None = None,
    kept_up: Mapping[str, DataFrame] | None = None,
) -> dict[str, str]:
    """Build every model; returns model -> path of its table. `kept_up`: models that are there already, as merges of
    partial aggregates (`incremental.py`), and are not computed from the whole history."""
    views = {
        "stg_trades": staging.stg_trades(raw_trades),
        "stg_alerts": staging.stg_alerts(raw_alerts),
        "stg_prices": staging.stg_prices(raw_prices),
    }
    cal = calendar or star.calendar_years((raw_trades, "entry_ts"), (raw_alerts, "timestamp"))
    built: dict[str, DataFrame] = {}
    paths: dict[str, str] = {}

    def t(name: str) -> DataFrame:
        return built[name]

    recipes: dict[str, Callable[[], DataFrame]] = {
        "dim_date": lambda: star.dim_date(spark, *cal),
        "dim_symbol": lambda: star.dim_symbol(views["stg_trades"], views["stg_prices"]),
        "dim_source": lambda: star.dim_source(views["stg_trades"]),
        "dim_rule": lambda: star.dim_rule(views["stg_alerts"]),
        # the dimensions are already written tables here: the planner sees their size
        "fct_trades": lambda: star.fct_trades(
            views["stg_trades"], {"date": t("dim_date"), "symbol": t("dim_symbol"), "source": t("dim_source")}),
        "fct_alerts": lambda: star.fct_alerts(views["stg_alerts"], {"date": t("dim_date"), "rule": t("dim_rule")}),
        "mart_daily_pnl": lambda: marts.daily_pnl(t("fct_trades")),
        "mart_kpi": lambda: marts.kpi(t("fct_trades")),
        "mart_heatmap": lambda: marts.heatmap(t("fct_trades")),
        "mart_security": lambda: marts.security(t("fct_alerts")),
        "mart_cross_domain": lambda: marts.cross_domain(t("fct_trades"), t("fct_alerts")),
        "mart_attack_geo": lambda: marts.attack_geo(ip_geo, views["stg_alerts"]),
        "mart_iceberg_trades": lambda: marts.trades_rollup(views["stg_trades"]),
        "mart_iceberg_alerts": lambda: marts.alerts_rollup(views["stg_alerts"]),
        "mart_iceberg_prices": lambda: marts.prices(views["stg_prices"]),
    }
    for name in TABLE_MODELS:
        df = kept_up[name] if kept_up and name in kept_up else recipes[name]()
        path = f"{out_dir.rstrip('/')}/{name}"
        df.write.mode("overwrite").parquet(path)
        built[name] = spark.read.schema(df.schema).parquet(path)
        paths[name] = path
    return paths


def model_rows(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """(model, rows) for the written tables; Parquet counts come from the file footers."""
    frames = [spark.read.parquet(p).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(m).alias("model"), "rows")
              for m, p in paths.items()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def model_tests(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """The column tests declared on the models (unique / not null / accepted values)."""
    frames = [quality.run_suite(spark.read.parquet(paths[m]), m, checks)
              for m, checks in quality.MODEL_CHECKS.items()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out.drop("skipped")

"""Registered queries: name -> (spark, sf_dir) -> DataFrame. Every query reads the driver's tables through the
fixture views and runs over all of their rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.plans import marts, staging, star
from tidemark.session import materialize
from tidemark.sources import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(name: str) -> Callable[[Query], Query]:
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return deco


# ---- shared building blocks ----------------------------------------------------------------------------------

def _stg_trades(spark, d):
    return staging.stg_trades(fx.trades(spark, d))


def _stg_alerts(spark, d):
    return staging.stg_alerts(fx.alerts(spark, d))


def _stg_prices(spark, d):
    return staging.stg_prices(fx.benchmark_prices(spark, d))


def _calendar(spark, d):
    return star.calendar_years((fx.trades(spark, d), "entry_ts"), (fx.alerts(spark, d), "timestamp"))


def _dim_date(spark, d):
    return star.dim_date(spark, *_calendar(spark, d))


def _dims(spark, d, *names):
    """The named dimensions, written and read back, so the planner sees their size."""
    recipes = {
        "date": lambda: _dim_date(spark, d),
        "symbol": lambda: star.dim_symbol(_stg_trades(spark, d), _stg_prices(spark, d)),
        "source": lambda: star.dim_source(_stg_trades(spark, d)),
        "rule": lambda: star.dim_rule(_stg_alerts(spark, d)),
    }
    return {n: materialize(recipes[n](), f"dim_{n}") for n in names}


def _fct_trades(spark, d, dims=star.TRADE_DIMS):
    return star.fct_trades(_stg_trades(spark, d), _dims(spark, d, *dims))


def _fct_alerts(spark, d, dims=star.ALERT_DIMS):
    return star.fct_alerts(_stg_alerts(spark, d), _dims(spark, d, *dims))


def _cross_domain(spark, d):
    """M9 reads no dimension attribute; the two facts are written once with the columns it uses, and every branch of the
    correlation reads those."""
    trades = _fct_trades(spark, d, ()).select("id", "trade_id", "symbol", "source", "side", "entry_ts", "exit_ts",
                                              "pnl_usd", "signal_score", "is_win")
    alerts = _fct_alerts(spark, d, ()).select("alert_id", "alert_ts", "rule_level", "rule_description")
    return marts.cross_domain(materialize(trades, "fct_trades"), materialize(alerts, "fct_alerts"))


# ---- staging, dimensions, facts ------------------------------------------------------------------------------

register("stg_trades")(_stg_trades)
register("stg_alerts")(_stg_alerts)
register("stg_prices")(_stg_prices)
register("dim_date")(_dim_date)
register("dim_symbol")(lambda s, d: star.dim_symbol(_stg_trades(s, d), _stg_prices(s, d)))
register("dim_source")(lambda s, d: star.dim_source(_stg_trades(s, d)))
register("dim_rule")(lambda s, d: star.dim_rule(_stg_alerts(s, d)))
register("fct_trades")(_fct_trades)
register("fct_alerts")(_fct_alerts)

# ---- marts ---------------------------------------------------------------------------------------------------

register("trading_summary")(lambda s, d: marts.trading_summary(fx.trades(s, d)))
register("running_pnl")(lambda s, d: marts.running_pnl(fx.trades(s, d)))
register("running_peak")(lambda s, d: marts.running_peak(fx.trades(s, d)))
register("daily_pnl")(lambda s, d: marts.daily_pnl(fx.trades(s, d)))
register("kpi")(lambda s, d: marts.kpi(fx.trades(s, d)))
register("kpi_view")(lambda s, d: marts.kpi(fx.trades(s, d), flavour="view"))
register("sharpe")(lambda s, d: marts.sharpe(fx.trades(s, d)))
register("max_drawdown")(lambda s, d: marts.max_drawdown(fx.trades(s, d)))
register("best_symbol")(lambda s, d: marts.best_symbol(fx.trades(s, d)))
register("heatmap_view")(lambda s, d: marts.heatmap_view(fx.trades(s, d)))
register("heatmap")(lambda s, d: marts.heatmap(_fct_trades(s, d, ("date",))))
register("alerts_daily")(lambda s, d: marts.alerts_daily(fx.alerts(s, d)))
register("alert_top_sources")(lambda s, d: marts.alert_top_sources(fx.alerts(s, d)))
register("security")(lambda s, d: marts.security(_fct_alerts(s, d, ("rule",))))
register("top_ip_per_day")(lambda s, d: marts.top_ip_per_day(_fct_alerts(s, d, ("rule",))))
register("trading_vs_security")(lambda s, d: marts.trading_vs_security(fx.trades(s, d), fx.alerts(s, d)))
register("interval_join")(lambda s, d: marts.interval_counts(fx.trades(s, d), fx.alerts(s, d)))
register("cross_domain")(_cross_domain)
register("attack_geo")(lambda s, d: marts.attack_geo(fx.ip_geo(s, d), _stg_alerts(s, d)))
register("trades_rollup")(lambda s, d: marts.trades_rollup(_stg_trades(s, d)))
register("alerts_rollup")(lambda s, d: marts.alerts_rollup(_stg_alerts(s, d)))
register("prices")(lambda s, d: marts.prices(_stg_prices(s, d)))
register("equity_vs_benchmark")(lambda s, d: marts.equity_vs_benchmark(fx.trades(s, d), _stg_prices(s, d)))
register("win_rate_trend")(lambda s, d: marts.win_rate_trend(fx.trades(s, d)))
register("duration_histogram")(lambda s, d: marts.duration_histogram(fx.trades(s, d)))

# ---- ingest, cleaning, loads, lake, quality, streams ---------------------------------------------------------

from tidemark.plans import scenarios as sc  # noqa: E402

for _name in (
    "scan_trades_csv", "pack_indicators", "validate_rejects", "alert_ingest", "alert_parse_errors", "alert_lookback",
    "benchmark_ingest", "load_trades", "load_stats", "load_by_source", "load_alerts", "load_prices",
    "snapshot_roundtrip", "lake_append", "lake_scan_trades", "lake_scan_alerts", "lake_scan_prices", "lake_as_of",
    "lake_versions", "lake_compact", "quality_report", "model_checks", "run_summary", "stream_alert_ingest",
    "stream_alerts_daily", "check_not_null", "check_unique", "check_in_set", "check_between", "check_columns",
    "check_row_count", "models_run", "empty_source", "union_sources", "quality_three_runs", "stream_parse_errors",
    "daily_run", "daily_run_security", "daily_run_cross_domain", "daily_run_empty",
    "incremental_daily_pnl", "incremental_trades_rollup", "incremental_alerts_daily", "incremental_alert_top_sources",
    "incremental_alerts_rollup",
):
    register(_name)(getattr(sc, _name))
register("validate_trades")(sc.validated_trades)

# ---- output representation -----------------------------------------------------------------------------------
# Money columns are exact decimals inside every plan. Queries that return them as stored give them as DOUBLE:
# the conversion of an exact value is the same in every engine, whatever client converts the results.

MONEY = ("entry_price", "exit_price", "pnl_usd", "pnl_pct", "signal_score", "position_size_usd", "balance_at_entry")
DECIMAL_OUTPUTS: dict[str, tuple[str, ...]] = {
    "stg_trades": MONEY, "fct_trades": MONEY, "trading_summary": MONEY, "lake_append": MONEY,
    "lake_scan_trades": MONEY, "stg_prices": ("close_price",), "load_prices": ("close_price",),
    "lake_scan_prices": ("close_price",),
}


def _as_doubles(fn: Query, cols: tuple[str, ...]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = fn(spark, sf_dir)
        return df.withColumns({c: df[c].cast("double") for c in cols})
    return run


for _name, _cols in DECIMAL_OUTPUTS.items():
    REGISTRY[_name] = _as_doubles(REGISTRY[_name], _cols)

"""Staging models: typed, renamed views over the raw tables (a projection each; Catalyst prunes and fuses them)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.expressions import UNKNOWN_IP, blank_to_null, duration_minutes, is_win

# The columns of the staging views.
TRADE_NUMERIC = (
    "entry_price", "exit_price", "pnl_usd", "pnl_pct", "signal_score", "position_size_usd", "balance_at_entry",
)


def stg_trades(raw_trades: DataFrame) -> DataFrame:
    keep = ["id", "trade_id", "source", "symbol", "side", "outcome", "reason", "entry_ts", "exit_ts", "hour_utc"]
    out = [F.col(c) for c in keep]
    out += [F.col(c) for c in TRADE_NUMERIC]
    out.append(F.col("indicators").alias("bot_indicators"))
    out.append(F.col("loaded_at"))
    out.append(duration_minutes("entry_ts", "exit_ts").alias("trade_duration_minutes"))
    out.append(is_win("pnl_usd").alias("is_win"))
    return raw_trades.select(*out)


def stg_alerts(raw_alerts: DataFrame) -> DataFrame:
    out = [
        F.col("id"), F.col("alert_id"), F.col("timestamp").alias("alert_ts"), F.col("rule_id"), F.col("rule_level"),
        F.col("rule_description"), F.col("agent_name"),
        F.coalesce(blank_to_null("src_ip"), F.lit(UNKNOWN_IP)).alias("src_ip"),
        F.col("full_log"), F.col("raw"), F.col("loaded_at"),
    ]
    return raw_alerts.select(*out)


def stg_prices(raw_prices: DataFrame) -> DataFrame:
    out = [F.col("date").cast("date").alias("price_date"), F.col("symbol").cast("string"), F.col("close_price")]
    if "loaded_at" in raw_prices.columns:
        out.append(F.col("loaded_at"))
    return raw_prices.select(*out)

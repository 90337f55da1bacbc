"""Star schema: date, symbol, source and rule dimensions; trade and alert facts.

Dimensions are small but their size depends on the data, so they are materialized (written to the shared folder
and read back) before a fact is joined to them: the planner then sees their real size and broadcasts them only
under `spark.sql.autoBroadcastJoinThreshold`, falling back to a sort-merge join above it. The calendar is written and
read back like the others.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.expressions import (
    asset_class, day_abbrev, severity_label, source_display_name, weekday_monday0,
)


def dim_date(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """One row per day from start to end inclusive, generated in parallel by `range`."""
    days = (end - start).days + 1
    d = F.date_add(F.lit(start), F.col("id").cast("int"))
    return (
        spark.range(0, max(days, 0))
        .select(d.alias("date_day"))
        .select(
            "date_day",
            weekday_monday0("date_day").alias("day_of_week"),
            day_abbrev("date_day").alias("day_name"),
            F.month("date_day").cast("int").alias("month"),
            F.quarter("date_day").cast("int").alias("quarter"),
            (F.weekday("date_day") >= 5).alias("is_weekend"),
        )
    )


def calendar_years(*ts_cols: tuple[DataFrame, str]) -> tuple[dt.date, dt.date]:
    """Whole calendar years spanning the given timestamp columns: one aggregation job, two scalars to the driver."""
    dates = None
    for df, c in ts_cols:
        part = df.select(F.to_date(c).alias("d"))
        dates = part if dates is None else dates.unionByName(part)
    row = dates.agg(F.min("d").alias("lo"), F.max("d").alias("hi")).first()
    if row["lo"] is None:
        today = dt.date.today()
        return dt.date(today.year, 1, 1), dt.date(today.year, 12, 31)
    return dt.date(row["lo"].year, 1, 1), dt.date(row["hi"].year, 12, 31)


def dim_symbol(stg_trades: DataFrame, stg_prices: DataFrame) -> DataFrame:
    syms = (
        stg_trades.where(F.col("symbol").isNotNull()).select("symbol")
        .union(stg_prices.where(F.col("symbol").isNotNull()).select("symbol"))
        .distinct()
    )
    return syms.select("symbol", asset_class("symbol").alias("asset_class"))


def dim_source(stg_trades: DataFrame) -> DataFrame:
    src = stg_trades.where(F.col("source").isNotNull()).select("source").distinct()
    return src.select("source", source_display_name("source").alias("display_name"))


def dim_rule(stg_alerts: DataFrame) -> DataFrame:
    """One row per rule_id: the attributes of its earliest alert (alert_ts, then id; alerts without a time last). The
    earliest time and then the smallest id are found by hash aggregations of numbers with map-side combine, so a rule
    that fires a third of all alerts is reduced in every task; only the picked rows are joined back."""
    alerts = stg_alerts.where(F.col("rule_id").isNotNull()).select("rule_id", "alert_ts", "id", "rule_level",
                                                                   "rule_description")
    times = alerts.groupBy(F.col("rule_id").alias("r")).agg(F.min("alert_ts").alias("first_ts"))
    first = alerts.join(times, (F.col("rule_id") == F.col("r")) & F.col("alert_ts").eqNullSafe(F.col("first_ts")))
    ids = first.groupBy(F.col("rule_id").alias("k")).agg(F.min("id").alias("first_id"))
    picked = first.drop("r", "first_ts").join(ids, (F.col("rule_id") == F.col("k")) & (F.col("id") == F.col("first_id")))
    return picked.select("rule_id", "rule_level", "rule_description", severity_label("rule_level").alias("severity_label"))


TRADE_DIMS, ALERT_DIMS = ("date", "symbol", "source"), ("date", "rule")


def fct_trades(stg_trades: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Trades with the attributes of the given (written) dimensions: `date`, `symbol`, `source`."""
    out, more = stg_trades, []
    if "date" in dims:
        d = dims["date"].select("date_day", "day_of_week", "day_name", "month", "quarter", "is_weekend")
        out = out.join(d, F.to_date("entry_ts") == F.col("date_day"), "left")
        more += ["day_of_week", "day_name", "month", "quarter", "is_weekend"]
    if "symbol" in dims:
        out = out.join(dims["symbol"].select("symbol", "asset_class"), "symbol", "left")
        more += ["asset_class"]
    if "source" in dims:
        out = out.join(dims["source"].select("source", F.col("display_name").alias("source_display_name")), "source", "left")
        more += ["source_display_name"]
    return out.select(*stg_trades.columns, *more)


def fct_alerts(stg_alerts: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Alerts with the attributes of the given (written) dimensions: `date`, `rule`."""
    cols = ["id", "alert_id", "alert_ts", "rule_id", "rule_level", "rule_description", "agent_name", "src_ip", "loaded_at"]
    out, more = stg_alerts, []
    if "date" in dims:
        d = dims["date"].select("date_day", "day_of_week", "day_name", "month", "quarter")
        out = out.join(d, F.to_date("alert_ts") == F.col("date_day"), "left")
        more += ["day_of_week", "day_name", "month", "quarter"]
    if "rule" in dims:
        out = out.join(dims["rule"].select("rule_id", "severity_label"), "rule_id", "left")
        more += ["severity_label"]
    return out.select(*cols, *more)

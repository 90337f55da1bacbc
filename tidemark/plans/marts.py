"""Analytic marts. Each is a function of DataFrames returning a DataFrame; measures that the reference computes in
NUMERIC are summed exactly as decimals and rounded half away from zero on integers before being returned as
DOUBLE, so results do not depend on the order in which partitions are added."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.expressions import (
    HIGH_SEVERITY_LEVEL, TRADING_DAYS_PER_YEAR, day_abbrev, duration_minutes, exact, exact_scale, floor_div, is_win,
    round_half_up_ratio, weekday_sunday0,
)
from tidemark.operators.interval import correlate
from tidemark.operators.running import running_aggregate

MICROS_PER_MINUTE = 60_000_000


def _dbl(c) -> F.Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")


def _win_rate(wins: F.Column, n: F.Column) -> F.Column:
    return round_half_up_ratio(wins * F.lit(100), n, 2)


# ---- running totals (W1, W2, M1, C1) ------------------------------------------------------------------------

def with_running_pnl(trades: DataFrame, peak: bool = False, partitions: int | None = None) -> DataFrame:
    """Adds `cumulative_pnl` (and `peak_pnl`) ordered by (entry_ts, id), as exact decimals."""
    return running_aggregate(
        trades,
        order_by=["entry_ts", "id"],
        sums={"cumulative_pnl": "pnl_usd"},
        peaks={"peak_pnl": "cumulative_pnl"} if peak else None,
        partitions=partitions,
    )


def trading_summary(trades: DataFrame) -> DataFrame:
    """M1: every trade with its cumulative P&L, duration in minutes and win flag."""
    run = with_running_pnl(trades)
    return run.select(
        *[c for c in trades.columns],
        _dbl("cumulative_pnl").alias("cumulative_pnl"),
        duration_minutes("entry_ts", "exit_ts").alias("trade_duration_minutes"),
        is_win("pnl_usd").alias("is_win"),
    )


def running_pnl(trades: DataFrame) -> DataFrame:
    """C1 equity curve."""
    run = with_running_pnl(trades.select("id", "entry_ts", "pnl_usd"))
    return run.select("id", "entry_ts", _dbl("pnl_usd").alias("pnl_usd"), _dbl("cumulative_pnl").alias("cumulative_pnl"))


def running_peak(trades: DataFrame) -> DataFrame:
    """Running maximum of the cumulative P&L."""
    run = with_running_pnl(trades.select("id", "entry_ts", "pnl_usd"), peak=True)
    return run.select(
        "id", "entry_ts", _dbl("cumulative_pnl").alias("cumulative_pnl"), _dbl("peak_pnl").alias("peak_pnl")
    )


# ---- daily P&L (M2), KPIs (M3) -------------------------------------------------------------------------------

def daily_pnl(trades: DataFrame) -> DataFrame:
    win = is_win("pnl_usd")
    n, wins = F.count(F.lit(1)), F.count_if(win)
    return trades.groupBy(F.to_date("entry_ts").alias("date"), "source").agg(
        _dbl(F.sum("pnl_usd")).alias("total_pnl_usd"),
        n.alias("trade_count"),
        wins.alias("win_count"),
        _win_rate(wins, n).alias("win_rate_pct"),
        _dbl(F.min("pnl_usd")).alias("max_single_loss"),
        _dbl(F.max("pnl_usd")).alias("max_single_win"),
    )


def sharpe_from(daily: DataFrame) -> DataFrame:
    """Sharpe ratio over the per-day totals `dpnl`: one row, NULL with fewer than two days or zero spread."""
    agg = daily.agg(F.avg(_dbl("dpnl")).alias("mean"), F.stddev_samp(_dbl("dpnl")).alias("std"),
                    (F.min("dpnl") < F.max("dpnl")).alias("spread"))
    ratio = F.when(F.col("spread"), F.col("mean") / F.col("std") * F.sqrt(F.lit(float(TRADING_DAYS_PER_YEAR))))
    return agg.select(F.round(ratio, 4).alias("sharpe_ratio"))


def _mean_pnl(df: DataFrame, digits: int) -> F.Column:
    """Mean of pnl_usd, rounded once from the exact sum at the input's own scale."""
    kind = df.schema["pnl_usd"].dataType
    return round_half_up_ratio(F.sum(exact("pnl_usd", kind)), F.count(F.lit(1)), digits, exact_scale(kind))


def _drawdown() -> F.Column:
    """Percent below the running peak; 0 while the peak is not positive."""
    fall = _dbl(F.col("peak_pnl") - F.col("cumulative_pnl")) / _dbl("peak_pnl") * F.lit(100.0)
    return F.when(F.col("peak_pnl") > 0, fall).otherwise(F.lit(0.0))


def kpi(trades: DataFrame, flavour: str = "model") -> DataFrame:
    """M3: one row of headline figures. `flavour="view"` gives the column names of the hand-written view."""
    run = with_running_pnl(
        trades.select("id", "entry_ts", "exit_ts", "symbol", "pnl_usd"), peak=True
    )
    n, wins = F.count(F.lit(1)), F.count_if(is_win("pnl_usd"))
    micros = F.timestamp_diff("MICROSECOND", F.col("entry_ts"), F.col("exit_ts"))
    base = run.agg(
        n.alias("total_trades"),
        _win_rate(wins, n).alias("win_rate_pct"),
        _dbl(F.sum("pnl_usd")).alias("total_pnl_usd"),
        F.round(F.max(_drawdown()), 4).alias("max_drawdown_pct"),
        round_half_up_ratio(F.sum(micros), n * F.lit(MICROS_PER_MINUTE), 2).alias("avg_duration_minutes"),
    )
    daily = trades.groupBy(F.to_date("entry_ts").alias("d")).agg(F.sum("pnl_usd").alias("dpnl"))
    sharpe = sharpe_from(daily)
    best = best_symbol(trades)
    # Three one-row frames side by side: a union and a max per column (no cross join).
    typed = {
        "total_trades": "long", "win_rate_pct": "double", "total_pnl_usd": "double", "sharpe_ratio": "double",
        "max_drawdown_pct": "double", "best_symbol": "string", "avg_duration_minutes": "double",
    }

    def widen(df: DataFrame) -> DataFrame:
        return df.select(*[
            (F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c) for c, t in typed.items()
        ])

    out = widen(base).unionByName(widen(sharpe)).unionByName(widen(best)).agg(
        *[F.max(c).alias(c) for c in typed]
    )
    if flavour == "view":
        out = out.withColumnRenamed("win_rate_pct", "overall_win_rate_pct").withColumnRenamed(
            "avg_duration_minutes", "avg_trade_duration_minutes"
        )
    return out


def best_symbol(trades: DataFrame) -> DataFrame:
    """O2: symbol with the largest total P&L (ties: symbol ascending, NULL symbol last). One row, NULL when
    there are no trades. The per-symbol totals are a partial aggregation; the pick is a global min_by."""
    per = trades.groupBy("symbol").agg(F.sum("pnl_usd").alias("s"))
    order = F.struct((-F.col("s")).alias("neg"), F.col("symbol").isNull().alias("isnull"), F.col("symbol"))
    return per.agg(F.min_by("symbol", order).alias("best_symbol"))


def max_drawdown(trades: DataFrame) -> DataFrame:
    run = with_running_pnl(trades.select("id", "entry_ts", "pnl_usd"), peak=True)
    return run.agg(F.round(F.max(_drawdown()), 4).alias("max_drawdown_pct"))


def sharpe(trades: DataFrame) -> DataFrame:
    return sharpe_from(trades.groupBy(F.to_date("entry_ts").alias("d")).agg(F.sum("pnl_usd").alias("dpnl")))


# ---- heatmaps (M4, M5) ---------------------------------------------------------------------------------------

def heatmap_view(trades: DataFrame) -> DataFrame:
    """M4: hour x weekday (Sunday = 0) from entry_ts."""
    n = F.count(F.lit(1))
    return trades.groupBy(
        "hour_utc", weekday_sunday0("entry_ts").alias("day_of_week"), day_abbrev("entry_ts").alias("day_name")
    ).agg(
        _mean_pnl(trades, 6).alias("avg_pnl_usd"),
        n.alias("trade_count"),
    )


def heatmap(fct_trades: DataFrame) -> DataFrame:
    """M5: hour x weekday (Monday = 0) from the calendar attributes of the fact."""
    n = F.count(F.lit(1))
    return fct_trades.groupBy("hour_utc", "day_of_week", "day_name").agg(
        _mean_pnl(fct_trades, 6).alias("avg_pnl_usd"),
        n.alias("trade_count"),
    )


# ---- alerts (M6, M6b, M7, M10, M12) --------------------------------------------------------------------------

def alerts_daily(alerts: DataFrame, ts: str = "timestamp") -> DataFrame:
    return alerts.groupBy(F.to_date(ts).alias("date"), "rule_level").agg(F.count(F.lit(1)).alias("alert_count"))


def alert_top_sources(alerts: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Per (date, src_ip), blank and missing IPs excluded (no limit, as in the reference)."""
    return (
        alerts.where(F.col("src_ip").isNotNull() & (F.col("src_ip") != ""))
        .groupBy(F.to_date(ts).alias("date"), "src_ip")
        .agg(F.count(F.lit(1)).alias("alert_count"), F.min("rule_level").alias("min_level"),
             F.max("rule_level").alias("max_level"))
    )


def _ip_counts(fct_alerts: DataFrame) -> DataFrame:
    return fct_alerts.groupBy(F.to_date("alert_ts").alias("date"), "severity_label", "src_ip").agg(
        F.count(F.lit(1)).alias("ip_count")
    )


def _busiest(by_ip: DataFrame) -> DataFrame:
    """The rows of the busiest address per (date, severity): the largest count by hash aggregation, then the smallest
    address among the few that reach it."""
    most = by_ip.groupBy(F.col("date").alias("d"), F.col("severity_label").alias("s")).agg(
        F.max("ip_count").alias("most"), F.sum("ip_count").alias("alert_count"))
    tied = by_ip.join(most, F.col("date").eqNullSafe(F.col("d")) & F.col("severity_label").eqNullSafe(F.col("s"))
                      & (F.col("ip_count") == F.col("most")))
    return tied.groupBy("date", "severity_label", "ip_count", "alert_count").agg(F.min("src_ip").alias("src_ip"))


def security(fct_alerts: DataFrame) -> DataFrame:
    """M7: per (date, severity) the alert count and its busiest source address. A NULL severity keeps its count but
    gets no address, as the reference's equality join on the label would."""
    top = _busiest(_ip_counts(fct_alerts))
    return top.select("date", "severity_label", "alert_count",
                      F.when(F.col("severity_label").isNotNull() & F.col("date").isNotNull(), F.col("src_ip")
                             ).alias("top_src_ip"))


def top_ip_per_day(fct_alerts: DataFrame) -> DataFrame:
    """The rank-1 address per (date, severity) with its count."""
    return _busiest(_ip_counts(fct_alerts)).select("date", "severity_label", "src_ip", "ip_count")


def attack_geo(ip_geo: DataFrame, stg_alerts: DataFrame) -> DataFrame:
    """Per located address. Alerts are reduced per address before the join, so the join sees one row per
    address on each side."""
    per_ip = stg_alerts.where(F.col("src_ip").isNotNull()).groupBy("src_ip").agg(
        F.count("id").alias("n"), F.min("alert_ts").alias("first_seen"), F.max("alert_ts").alias("last_seen")
    )
    geo_cols = ["src_ip", "country", "country_code", "city", "latitude", "longitude", "isp"]
    geo = ip_geo.where((F.col("status") == "success") & F.col("country").isNotNull()).select(*geo_cols)
    joined = geo.join(per_ip, "src_ip")
    return joined.groupBy(*geo_cols).agg(
        F.sum("n").alias("alert_count"), F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen")
    )


def alerts_rollup(stg_alerts: DataFrame) -> DataFrame:
    """M12."""
    return stg_alerts.groupBy("rule_level", "rule_description").agg(
        F.count(F.lit(1)).alias("alert_count"), F.min("alert_ts").alias("first_seen"), F.max("alert_ts").alias("last_seen")
    )


# ---- trades and prices rollups (M11, M13) --------------------------------------------------------------------

def trades_rollup(stg_trades: DataFrame) -> DataFrame:
    """Totals and means as numeric(12,4)."""
    n = F.count(F.lit(1))
    return stg_trades.groupBy("symbol", "side", "outcome").agg(
        n.alias("trade_count"),
        _dbl(F.sum("pnl_usd").cast("decimal(12,4)")).alias("total_pnl_usd"),
        _mean_pnl(stg_trades, 4).alias("avg_pnl_usd"),
        F.min("entry_ts").alias("first_trade_ts"),
        F.max("entry_ts").alias("last_trade_ts"),
    )


def prices(stg_prices: DataFrame) -> DataFrame:
    """M13."""
    return stg_prices.select("price_date", "symbol", _dbl("close_price").alias("close_price"))


# ---- trades against alerts (M8, M9) --------------------------------------------------------------------------

def trading_vs_security(trades: DataFrame, alerts: DataFrame, partitions: int | None = None) -> DataFrame:
    """M8: per trade, the alerts within 30 minutes of its entry."""
    return correlate(
        trades, alerts, trade_key="id", trade_ts="entry_ts",
        group_cols=[F.col("id").alias("trade_pk"), "trade_id", "symbol", "source", "side", "entry_ts", "exit_ts",
                    _dbl("pnl_usd").alias("pnl_usd"), _dbl("signal_score").alias("signal_score")],
        alert_key="id", alert_ts="timestamp", alert_level="rule_level", alert_desc="rule_description",
        high_level=HIGH_SEVERITY_LEVEL, partitions=partitions, key_in_group=True,
    )


def interval_counts(trades: DataFrame, alerts: DataFrame, half_width_minutes: int = 30,
                    partitions: int | None = None) -> DataFrame:
    """J3 on its own: every trade with the number of alerts (and of high-severity alerts) whose time lies within
    +-h of its entry, computed by the sweep (no pairs are formed)."""
    from tidemark.operators.interval import window_counts

    counts = window_counts(
        trades, alerts, trade_key="id", trade_ts="entry_ts", alert_key="id", alert_ts="timestamp",
        alert_flag=F.col("rule_level") >= HIGH_SEVERITY_LEVEL,
        half_width_micros=half_width_minutes * MICROS_PER_MINUTE, partitions=partitions,
    )
    return trades.select("id", "entry_ts").join(counts, "id", "left").select(
        F.col("id").alias("trade_pk"), "entry_ts",
        F.coalesce(F.col("__n"), F.lit(0)).alias("alerts_within_window"),
        F.coalesce(F.col("__nf"), F.lit(0)).alias("high_severity_alerts"),
    )


def cross_domain(fct_trades: DataFrame, fct_alerts: DataFrame, partitions: int | None = None) -> DataFrame:
    """M9: the same on the facts, grouped by the trade's attributes (not its surrogate key)."""
    return correlate(
        fct_trades, fct_alerts, trade_key="id", trade_ts="entry_ts",
        group_cols=["trade_id", "symbol", "source", "side", "entry_ts", "exit_ts",
                    _dbl("pnl_usd").alias("pnl_usd"), _dbl("signal_score").alias("signal_score"), "is_win"],
        alert_key="alert_id", alert_ts="alert_ts", alert_level="rule_level", alert_desc="rule_description",
        high_level=HIGH_SEVERITY_LEVEL, partitions=partitions,
    )


# ---- equity against benchmark (M14), dashboard cards (C2, C3) ------------------------------------------------

def equity_vs_benchmark(trades: DataFrame, stg_prices: DataFrame) -> DataFrame:
    """M14 (our definition; the reference declares it without SQL): per price date and symbol, the symbol's
    return since its first close in percent, next to the bot's cumulative P&L carried forward to that date.
    Dates with trades but no prices appear with a NULL symbol. Windows here run over one row per day."""
    daily = trades.groupBy(F.to_date("entry_ts").alias("date")).agg(F.sum("pnl_usd").alias("dpnl"))
    dates = daily.select("date").union(stg_prices.select(F.col("price_date").alias("date"))).distinct()
    by_day = Window.orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    equity = dates.join(daily, "date", "left").select(
        "date", _dbl(F.sum("dpnl").over(by_day)).alias("bot_cum_pnl_usd")
    )
    first = stg_prices.groupBy("symbol").agg(F.min_by("close_price", "price_date").alias("first_close"))
    ret = stg_prices.join(first, "symbol").select(
        F.col("price_date").alias("date"), "symbol", _dbl("close_price").alias("close_price"),
        (_dbl(F.col("close_price") - F.col("first_close")) / _dbl("first_close") * F.lit(100.0)).alias(
            "benchmark_return_pct"),
    )
    return equity.join(ret, "date", "left").select(
        "date", "symbol", "close_price", "benchmark_return_pct", "bot_cum_pnl_usd"
    )


def win_rate_trend(trades: DataFrame, days: int = 7) -> DataFrame:
    """Daily win rate and the win rate over the trailing `days` trading days (ratio of sums)."""
    per_day = trades.groupBy(F.to_date("entry_ts").alias("date")).agg(
        F.count(F.lit(1)).alias("trade_count"), F.count_if(is_win("pnl_usd")).alias("win_count")
    )
    trail = Window.orderBy("date").rowsBetween(-(days - 1), 0)
    return per_day.select(
        "date", "trade_count", "win_count",
        _win_rate(F.col("win_count"), F.col("trade_count")).alias("win_rate_pct"),
        _win_rate(F.sum("win_count").over(trail), F.sum("trade_count").over(trail)).alias("rolling_win_rate_pct"),
    )


def duration_histogram(trades: DataFrame, width_minutes: int = 30) -> DataFrame:
    """Trades per duration band of `width_minutes`."""
    micros = F.timestamp_diff("MICROSECOND", F.col("entry_ts"), F.col("exit_ts")).cast("decimal(38,0)")
    width = F.lit(width_minutes * MICROS_PER_MINUTE).cast("decimal(38,0)")
    band = F.when(micros >= 0, floor_div(micros, width)).otherwise(-floor_div(-micros + width - 1, width))
    return trades.where(F.col("entry_ts").isNotNull() & F.col("exit_ts").isNotNull()).groupBy(
        (band * F.lit(width_minutes)).cast("long").alias("duration_band_start_min")
    ).agg(F.count(F.lit(1)).alias("trade_count"))


"""Trade, alert, price and geo inputs derived from the driver's tables.

The driver ships TPC-H-like tables plus an `events` stream, not broker files. These views give the same shapes as
the reference's inputs (FIXTURES.md §3). Each reads only the columns it needs, so the scans are pruned; the same
definitions exist as DuckDB SQL in `tidemark.oracle`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import prepare

DEC = "decimal(18,4)"
PNL = "decimal(20,8)"     # eight fraction digits, as crypto sizes give


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _events(spark: SparkSession, sf_dir: str, *cols: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(*cols)


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean trades, the shape of the `raw.trades` table (id, trade_id, source, ... , indicators)."""
    ev = _events(spark, sf_dir, "event_id", "ts", "user_id", "event_type", "value", "props").where(
        F.col("event_type") != "error"
    )
    eid, uid = F.col("event_id"), F.col("user_id")
    entry = F.col("ts").cast("timestamp")
    tail = F.concat(F.lit("0.00000"), F.lpad((eid % 1000).cast("string"), 3, "0")).cast(PNL)
    pnl = (F.col("value").cast(DEC) - F.lit(50) + tail).cast(PNL)
    symbol = (
        F.when(uid % 6 == 0, "EUR/USD")
        .when(uid % 6 == 1, "GBP/USD")
        .when(uid % 6 == 2, "BTC-USD")
        .when(uid % 6 == 3, "ETH-USD")
        .when(uid % 6 == 4, "XAU_USD")
    )
    return ev.select(
        eid.alias("id"),
        F.concat(F.lit("T"), eid.cast("string")).alias("trade_id"),
        F.when(eid % 10 == 9, "paper").when(uid % 2 == 0, "oanda").otherwise("kraken").alias("source"),
        symbol.alias("symbol"),
        F.when(eid % 3 == 0, "SELL").otherwise("BUY").alias("side"),
        F.col("event_type").alias("outcome"),
        F.when(eid % 4 == 0, "tp").otherwise("sl").alias("reason"),
        entry.alias("entry_ts"),
        (entry + F.make_dt_interval(mins=(F.lit(1) + eid % 240).cast("int"))).alias("exit_ts"),
        F.hour(entry).cast("int").alias("hour_utc"),
        (F.lit(100) + uid).cast(DEC).alias("entry_price"),
        (F.col("value").cast(DEC) + F.lit(100) + uid).cast(DEC).alias("exit_price"),
        pnl.alias("pnl_usd"),
        pnl.alias("pnl_pct"),
        (uid % 100).cast(DEC).alias("signal_score"),
        F.lit(1000).cast(DEC).alias("position_size_usd"),
        (F.lit(10000) + eid).cast(DEC).alias("balance_at_entry"),
        F.col("props").alias("indicators"),
        (entry + F.make_dt_interval(days=F.lit(1))).alias("loaded_at"),
    )


def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts, the shape of the `raw.wazuh_alerts` table."""
    ev = _events(spark, sf_dir, "event_id", "ts", "user_id", "event_type", "props").where(
        F.col("event_type") == "error"
    )
    eid, uid = F.col("event_id"), F.col("user_id")
    return ev.select(
        eid.alias("id"),
        F.md5(F.concat(eid.cast("string"), F.col("event_type"))).alias("alert_id"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.when(uid % 20 != 0, (F.lit(5700) + uid % 20).cast("int")).alias("rule_id"),
        (uid % 17).cast("int").alias("rule_level"),
        F.concat(F.lit("rule "), (uid % 20).cast("string")).alias("rule_description"),
        F.lit("hub").alias("agent_name"),
        F.when(uid % 11 == 0, None)
        .when(uid % 7 == 0, "")
        .otherwise(F.concat(F.lit("10.0.0."), (uid % 50).cast("string")))
        .alias("src_ip"),
        F.col("props").alias("full_log"),
        F.col("props").alias("raw"),
        (F.col("ts").cast("timestamp") + F.make_dt_interval(days=F.lit(1))).alias("loaded_at"),
    )


def benchmark_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily close per (date, symbol): the highest event value of that day and parity."""
    ev = _events(spark, sf_dir, "event_id", "ts", "value")
    return ev.groupBy(
        F.to_date(F.col("ts")).alias("date"),
        F.when(F.col("event_id") % 2 == 0, "BTC-USD").otherwise("ETH-USD").alias("symbol"),
    ).agg(F.max("value").cast(DEC).alias("close_price"))


def ip_geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One located address per supplier (all of them; the alerts use the first fifty addresses)."""
    sup = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    nat = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (
        sup.join(nat, sup.s_nationkey == nat.n_nationkey)
        .select(
            F.concat(F.lit("10.0.0."), F.col("s_suppkey").cast("string")).alias("src_ip"),
            F.col("n_name").alias("country"),
            F.concat(F.lit("C"), F.col("n_nationkey").cast("string")).alias("country_code"),
            F.col("s_name").alias("city"),
            F.col("s_acctbal").cast("double").alias("latitude"),
            (F.lit(0) - F.col("s_acctbal")).cast("double").alias("longitude"),
            F.lit("isp").alias("isp"),
            F.when(F.col("s_suppkey") % 5 == 4, "fail").otherwise("success").alias("status"),
        )
    )


def alert_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alert JSON text lines (event_id, line): most readable, some without a time, some blank (empty, or white space
    only), some malformed (cut off, two objects on a line, text after the object, single quotes)."""
    ev = _events(spark, sf_dir, "event_id", "ts", "user_id", "event_type").where(F.col("event_type") == "error")
    eid, uid = F.col("event_id"), F.col("user_id")
    time = F.concat(F.lit('"timestamp": "'), F.col("ts").cast("string"), F.lit('", '))
    rest = F.concat(
        F.lit('"rule": {"id": "'), (F.lit(5700) + uid % 20).cast("string"),
        F.lit('", "level": '), (uid % 17).cast("string"),
        F.lit(', "description": "rule '), (uid % 20).cast("string"),
        F.lit('"}, "agent": {"name": "hub"}, "data": {"srcip": "10.0.0.'), (uid % 50).cast("string"),
        F.lit('"}, "full_log": "k '), uid.cast("string"), F.lit('"}'),
    )
    line = (
        F.when(eid % 97 == 0, "{bad").when(eid % 89 == 0, "").when(eid % 79 == 0, " \t ")
        .when(eid % 73 == 0, "{'full_log': 'x'}").when(eid % 71 == 0, '{"full_log": "x"} {"full_log": "y"}')
        .when(eid % 67 == 0, '{"full_log": "x"} xyz').when(eid % 83 == 0, F.concat(F.lit("{"), rest))
        .otherwise(F.concat(F.lit("{"), time, rest))
    )
    return ev.select(eid, line.alias("line"))


def trades_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Broker rows as text with blank ids, non-numeric P&L, bad and reversed times and duplicate keys."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_linestatus", "l_shipdate"
    )
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    key = F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string"))
    return li.join(od, li.l_orderkey == od.o_orderkey).select(
        key.alias("trade_id_raw"),
        F.when(F.col("l_partkey") % 41 == 0, "  ").otherwise(key).alias("trade_id"),
        F.when(F.col("l_linestatus") == "F", "oanda").otherwise("kraken").alias("source"),
        F.when(F.col("l_partkey") % 37 == 0, "n/a").when(F.col("l_partkey") % 31 == 0, "12d")
        .when(F.col("l_partkey") % 29 == 0, " 0x1p3").when(F.col("l_partkey") % 23 == 0, "+1.5e2 ")
        .otherwise(F.col("l_extendedprice").cast("decimal(18,2)").cast("string"))
        .alias("pnl_usd"),
        F.col("o_orderdate").cast("string").alias("entry_ts"),
        F.when(F.col("l_suppkey") % 43 == 0, "bad").otherwise(F.col("l_shipdate").cast("string")).alias("exit_ts"),
    )

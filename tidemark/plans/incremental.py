"""Marts kept up load by load: M2, M6, M6b, M11 and M12 from mergeable partial aggregates.

Each of these marts is a merge (sum, minimum, maximum) of partial aggregates. The partials of a load are made from that
load's rows alone, pruned by its `load_id` folder, and written as `<base>/<mart>/load_id=N`; dynamic partition overwrite
makes writing them again replace them. A day's run reads the day's load, however late its rows' own days are, and the
mart is the merge of all partials: a row per key and load rather than per record. A run that died, or was left out, is
made up for by the next: every load that has an entry and no partials is taken.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.expressions import exact, exact_scale, is_win, round_half_up_ratio
from tidemark.operators import keyed_load
from tidemark.operators.keyed_load import LOAD_ID, partition_values

MERGE: Mapping[str, Callable[[str], Column]] = {"n": F.sum, "sum": F.sum, "low": F.min, "high": F.max}


@dataclass(frozen=True)
class Mart:
    """`keys`: key columns over the source rows. `parts`: partial column -> (kind, value column). `finish`: the mart's
    columns from the merged partials, given the exact scale of the summed money."""
    source: str
    keys: Mapping[str, Column]
    parts: Mapping[str, tuple[str, Column]]
    finish: Callable[[int], Mapping[str, Column]]
    where: Column | None = None


def _dbl(c: str) -> Column:
    return F.col(c).cast("double")


def marts() -> dict[str, Mart]:
    pnl, entry, ts, ip = F.col("pnl_usd"), F.col("entry_ts"), F.col("timestamp"), F.col("src_ip")
    level, one = F.col("rule_level"), F.lit(1).cast("bigint")
    count = {"alert_count": ("n", one)}
    same = lambda *names: lambda scale: {c: F.col(c) for c in names}
    return {
        "daily_pnl": Mart(
            "trades", {"date": F.to_date(entry), "source": F.col("source")},
            {"n": ("n", one), "wins": ("n", F.when(is_win("pnl_usd"), 1).otherwise(0).cast("bigint")), "pnl": ("sum", pnl),
             "low": ("low", pnl), "high": ("high", pnl)},
            lambda scale: {"total_pnl_usd": _dbl("pnl"), "trade_count": F.col("n"), "win_count": F.col("wins"),
                           "win_rate_pct": round_half_up_ratio(F.col("wins") * F.lit(100), F.col("n"), 2),
                           "max_single_loss": _dbl("low"), "max_single_win": _dbl("high")}),
        "trades_rollup": Mart(
            "trades", {c: F.col(c) for c in ("symbol", "side", "outcome")},
            {"n": ("n", one), "pnl": ("sum", pnl), "first_trade_ts": ("low", entry), "last_trade_ts": ("high", entry)},
            lambda scale: {"trade_count": F.col("n"), "total_pnl_usd": F.col("pnl").cast("decimal(12,4)").cast("double"),
                           "avg_pnl_usd": round_half_up_ratio(F.col("pnl"), F.col("n"), 4, scale),
                           "first_trade_ts": F.col("first_trade_ts"), "last_trade_ts": F.col("last_trade_ts")}),
        "alerts_daily": Mart("alerts", {"date": F.to_date(ts), "rule_level": level}, count, same("alert_count")),
        "alert_top_sources": Mart(
            "alerts", {"date": F.to_date(ts), "src_ip": ip},
            count | {"min_level": ("low", level), "max_level": ("high", level)},
            same("alert_count", "min_level", "max_level"), where=ip.isNotNull() & (ip != "")),
        "alerts_rollup": Mart(
            "alerts", {"rule_level": level, "rule_description": F.col("rule_description")},
            count | {"first_seen": ("low", ts), "last_seen": ("high", ts)},
            same("alert_count", "first_seen", "last_seen")),
    }


def _merged(rows: DataFrame, keys: Sequence[str], parts: Mapping[str, tuple[str, Column]]) -> DataFrame:
    return rows.groupBy(*keys).agg(*[MERGE[kind](c).alias(c) for c, (kind, _) in parts.items()])


def partials(rows: DataFrame, mart: Mart) -> DataFrame:
    """The partial aggregates of source rows with a `load_id`, per load."""
    rows = rows if mart.where is None else rows.where(mart.where)
    values = {}
    for c, (kind, value) in mart.parts.items():
        if kind == "sum":
            value = exact(value, rows.select(value.alias("v")).schema["v"].dataType)
        values[c] = value
    narrow = rows.select(LOAD_ID, *[c.alias(k) for k, c in mart.keys.items()], *[v.alias(c) for c, v in values.items()])
    return _merged(narrow, [LOAD_ID, *mart.keys], mart.parts)


def missing_loads(spark: SparkSession, table: str, path: str) -> list[int]:
    """Loads of `table` that have an entry and rows, and no partials at `path`: folder names and one row per load."""
    logged = {r.load_id for r in keyed_load.loads(spark, table).where("inserted > 0").select("load_id").collect()}
    return sorted(logged - set(partition_values(spark, path, LOAD_ID)))


def fresh_rows(spark: SparkSession, table: str, loads: Sequence[int], schema: T.StructType | None = None) -> DataFrame:
    """The rows of some loads, pruned by folder."""
    return keyed_load.read_table(spark, table, schema).where(F.col(LOAD_ID).isin(*loads))


def update(spark: SparkSession, tables: Mapping[str, str], base: str,
           only: Sequence[str] | None = None) -> dict[str, list[int]]:
    """Make the missing partials of every mart (of `only` some); returns the loads taken. `tables`: source -> path of its
    loaded table."""
    taken = {}
    for name, mart in marts().items():
        if only is not None and name not in only:
            continue
        path = f"{base}/{name}"
        taken[name] = missing_loads(spark, tables[mart.source], path)
        if taken[name]:
            made = partials(fresh_rows(spark, tables[mart.source], taken[name]), mart)
            (made.coalesce(max(1, len(taken[name]))).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy(LOAD_ID).parquet(path))
    return taken


def read(spark: SparkSession, base: str, name: str, source: DataFrame) -> DataFrame:
    """A mart from its partials. `source` gives the types of the source's columns, no rows."""
    mart, path = marts()[name], f"{base}/{name}"
    empty = partials(source.limit(0).withColumn(LOAD_ID, F.lit(0)), mart)
    rows = keyed_load.read_table(spark, path, empty.schema)
    money = [source.select(v.alias("v")).schema["v"].dataType for kind, v in mart.parts.values() if kind == "sum"]
    merged = _merged(rows, list(mart.keys), mart.parts)
    return merged.select(*mart.keys, *[c.alias(k) for k, c in mart.finish(exact_scale(money[0]) if money else 0).items()])

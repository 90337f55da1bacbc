"""Data-quality suites: every check of one table in one aggregation pass.

A suite is a list of checks; `run_suite` builds one `agg` with a `count_if` per row-level check (NULL values
are ignored by the value checks, as expectation suites do), `count - count_distinct` for uniqueness, and the
row count, then turns the single result row into one output row per check. Column-set checks need only the
schema. Row-count bounds come from the previous run's count, kept in a small baseline table.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.expressions import SIDES

RESULT_SCHEMA = "suite string, check string, column string, failed_rows long, success boolean, skipped boolean"


@dataclass(frozen=True)
class Check:
    kind: str  # not_null | unique | in_set | between | row_count | columns
    column: str | None = None
    values: tuple = ()
    min_value: float | None = None
    max_value: float | None = None
    strict_min: bool = False
    strict_max: bool = False
    expected: tuple[str, ...] = field(default_factory=tuple)

    @property
    def name(self) -> str:
        return CHECK_NAMES[self.kind]


# The names under which checks are reported.
CHECK_NAMES = {
    "not_null": "expect_column_values_to_not_be_null",
    "unique": "expect_column_values_to_be_unique",
    "in_set": "expect_column_values_to_be_in_set",
    "between": "expect_column_values_to_be_between",
    "row_count": "expect_table_row_count_to_be_between",
    "columns": "expect_table_columns_to_match_set",
}

# A table may shrink to LOW and grow to HIGH times the last run's rows (whole rows, cut off); without a last run, or
# after an empty one, any count will do.
LOW, HIGH = 0.5, 1.5


def count_drifted(count: int, last: int | None, low: float = LOW, high: float = HIGH) -> bool:
    return bool(last) and not math.floor(low * last) <= count <= math.floor(high * last)


# The columns each suite expects (extra columns are allowed).
TRADES_EXPECTED_COLS = (
    "trade_id", "symbol", "side", "outcome", "reason", "entry_ts", "exit_ts", "hour_utc", "entry_price", "exit_price",
    "pnl_usd", "pnl_pct", "signal_score", "position_size_usd", "balance_at_entry", "source", "indicators",
)
ALERTS_EXPECTED_COLS = (
    "alert_id", "timestamp", "rule_id", "rule_level", "rule_description", "agent_name", "src_ip", "full_log", "raw",
)

TRADES_SUITE = (
    Check("not_null", "trade_id"),
    Check("in_set", "side", values=SIDES),
    Check("between", "entry_price", min_value=0, strict_min=True),
    Check("row_count"),
    Check("columns", expected=TRADES_EXPECTED_COLS),
)
ALERTS_SUITE = (
    Check("not_null", "alert_id"),
    Check("unique", "alert_id"),
    Check("not_null", "timestamp"),
    Check("between", "rule_level", min_value=0, max_value=15),
    Check("row_count"),
    Check("columns", expected=ALERTS_EXPECTED_COLS),
)


def _failed_expr(c: Check) -> F.Column | None:
    col = F.col(c.column) if c.column else None
    if c.kind == "not_null":
        return F.count_if(col.isNull())
    if c.kind == "unique":
        return F.count(col) - F.count_distinct(col)
    if c.kind == "in_set":
        return F.count_if(col.isNotNull() & ~col.isin(*c.values))
    if c.kind == "between":
        bad = F.lit(False)
        if c.min_value is not None:
            bad = bad | ((col <= c.min_value) if c.strict_min else (col < c.min_value))
        if c.max_value is not None:
            bad = bad | ((col >= c.max_value) if c.strict_max else (col > c.max_value))
        return F.count_if(col.isNotNull() & bad)
    return None


def run_suite(df: DataFrame, suite: str, checks: Sequence[Check], previous_count: int | None = None,
              skip_when_empty: bool = False) -> DataFrame:
    """One row per check: (suite, check, column, failed_rows, success, skipped)."""
    return run_suite_counted(df, suite, checks, previous_count, skip_when_empty)[0]


def run_suite_counted(df: DataFrame, suite: str, checks: Sequence[Check], previous_count: int | None = None,
                      skip_when_empty: bool = False) -> tuple[DataFrame, int]:
    """`run_suite` and the table's row count, from the same pass."""
    spark = df.sparkSession
    aggs = [F.count(F.lit(1)).alias("__rows")]
    for i, c in enumerate(checks):
        e = _failed_expr(c)
        if e is not None:
            aggs.append(e.alias(f"__c{i}"))
    row = df.agg(*aggs).first()
    n = int(row["__rows"])
    if skip_when_empty and n == 0:
        return spark.createDataFrame([(suite, None, None, 0, True, True)], RESULT_SCHEMA), n
    out = []
    for i, c in enumerate(checks):
        if c.kind == "row_count":
            ok = not count_drifted(n, previous_count)
            out.append((suite, c.name, None, 0 if ok else n, ok, False))
        elif c.kind == "columns":
            missing = sorted(set(c.expected) - set(df.columns))
            out.append((suite, c.name, ",".join(missing) or None, len(missing), not missing, False))
        else:
            failed = int(row[f"__c{i}"] or 0)
            out.append((suite, c.name, c.column, failed, failed == 0, False))
    return spark.createDataFrame(out, RESULT_SCHEMA), n


# ---- baseline of row counts (Q5, Q8) -------------------------------------------------------------------------

def read_baseline(spark: SparkSession, path: str) -> tuple[dict[str, int], int]:
    """The row counts of each suite's last run, and the number of the last run (0 before the first)."""
    from tidemark.operators.keyed_load import table_exists
    if not table_exists(spark, path):
        return {}, 0
    rows = (spark.read.parquet(path).groupBy("suite")
            .agg(F.max_by("row_count", "run").alias("n"), F.max("run").alias("run")).collect())     # a row per suite
    return {r["suite"]: int(r["n"]) for r in rows}, max((int(r["run"]) for r in rows), default=0)


def save_baseline(spark: SparkSession, path: str, counts: dict[str, int], run: int) -> None:
    spark.createDataFrame([(k, int(v), run) for k, v in counts.items()], "suite string, row_count long, run long") \
        .coalesce(1).write.mode("append").parquet(path)


class QualityFailed(RuntimeError):
    pass


def checkpoint_suites(
    spark: SparkSession, trades: DataFrame, alerts: DataFrame, baseline_path: str, raise_on_failure: bool = True,
) -> DataFrame:
    """Run both suites against the previous counts, save this run's counts (also when a check fails) under the next
    run number, then raise if any suite failed. An empty alert frame is reported as skipped and successful."""
    prev, last_run = read_baseline(spark, baseline_path)
    t, n_trades = run_suite_counted(trades, "stg_trades", TRADES_SUITE, prev.get("stg_trades"))
    a, n_alerts = run_suite_counted(alerts, "stg_wazuh_alerts", ALERTS_SUITE, prev.get("stg_wazuh_alerts"),
                                    skip_when_empty=True)
    report = t.unionByName(a)
    save_baseline(spark, baseline_path, {"stg_trades": n_trades, "stg_wazuh_alerts": n_alerts}, last_run + 1)
    if raise_on_failure and not report.where(~F.col("success")).isEmpty():
        raise QualityFailed("quality checks failed")
    return report


MODEL_CHECKS = {
    "fct_trades": (Check("unique", "id"), Check("not_null", "id"), Check("not_null", "trade_id"),
                   Check("in_set", "side", values=SIDES), Check("not_null", "pnl_usd")),
    "fct_alerts": (Check("not_null", "alert_id"), Check("unique", "alert_id")),
    "dim_date": (Check("unique", "date_day"), Check("not_null", "date_day")),
}

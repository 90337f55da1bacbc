"""Trade validation: numeric P&L, readable and ordered timestamps, a non-blank id.

The rules run in order, so a row is counted under the first rule it fails; the reason is computed in the same
projection as the clean rows, so rows and reject counts come from one pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.expressions import EXACT

# Timestamp layouts accepted besides the ISO forms that a plain cast reads, told apart by their shape; each row is parsed
# on its own, and by one layout.
SLASHED: Sequence[tuple[str, str]] = (
    (r"^\d\d/\d\d/\d{4} \d\d:\d\d$", "MM/dd/yyyy HH:mm"), (r"^\d\d/\d\d/\d{4} \d\d:\d\d:\d\d$", "MM/dd/yyyy HH:mm:ss"),
)

REASON_PNL, REASON_TIME, REASON_ID = "non_numeric_pnl", "invalid_timestamps", "blank_trade_id"


def parse_timestamp(c: str | F.Column) -> F.Column:
    """Timestamp text by the one layout of its shape; NULL for anything else."""
    text = F.trim((F.col(c) if isinstance(c, str) else c).cast("string"))
    slashed = F.when(F.lit(False), F.lit(None).cast("timestamp"))
    for shape, layout in SLASHED:
        slashed = slashed.when(text.rlike(shape), F.try_to_timestamp(text, F.lit(layout)))
    return F.when(text.contains("/"), slashed).otherwise(F.try_to_timestamp(text))


# Numbers as text: digits with an optional sign, point and exponent, or infinity; no type suffixes, no hexadecimal.
NUMBER = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity))\s*$"


def number(c: str | F.Column, kind: str = "double") -> F.Column:
    """Numeric text as `kind`; NULL for anything else."""
    text = (F.col(c) if isinstance(c, str) else c).cast("string")
    return F.when(text.rlike(NUMBER), F.trim(text)).try_cast(kind)


def typed_trades(df: DataFrame) -> DataFrame:
    """The trade table's types for validated broker rows: whole hours, decimals without a cut of fraction digits;
    unreadable numbers are NULL (L6). Columns the table has and the batch lacks are NULL; indicators default to {}."""
    money = ("entry_price", "exit_price", "pnl_usd", "pnl_pct", "signal_score", "position_size_usd", "balance_at_entry")
    have = set(df.columns)
    text = lambda c: F.col(c).cast("string") if c in have else F.lit(None).cast("string")
    return df.select(
        *[text(c).alias(c) for c in ("trade_id", "source", "symbol", "side", "outcome", "reason")],
        "entry_ts", "exit_ts", number(text("hour_utc"), "double").cast("int").alias("hour_utc"),
        *[number(text(c), EXACT).alias(c) for c in money],
        F.coalesce(text("indicators"), F.lit("{}")).alias("indicators"))


def _typed(df: DataFrame, decimal_pnl: bool = False) -> DataFrame:
    """P&L and timestamps read once: inline() of one struct is an operator of its own, so no filter on the results is
    pushed below it to parse them a second time."""
    rest = [c for c in df.columns if c not in ("pnl_usd", "entry_ts", "exit_ts")]
    typed = F.struct(number("pnl_usd", EXACT if decimal_pnl else "double").alias("pnl_usd"),
                     parse_timestamp("entry_ts").alias("entry_ts"), parse_timestamp("exit_ts").alias("exit_ts"))
    return df.select(*rest, F.inline(F.array(typed))).select(*df.columns)


def _rules(decimal_pnl: bool) -> tuple[F.Column, F.Column, F.Column]:
    pnl, entry, exit_ = F.col("pnl_usd"), F.col("entry_ts"), F.col("exit_ts")
    bad_pnl = pnl.isNull() if decimal_pnl else pnl.isNull() | F.isnan(pnl)
    bad_ts = entry.isNull() | exit_.isNull() | (entry >= exit_)
    bad_id = F.col("trade_id").isNull() | F.col("trade_id").cast("string").rlike(r"^\s*$")
    return bad_pnl, bad_ts, bad_id


def with_reject_reason(df: DataFrame, decimal_pnl: bool = False) -> DataFrame:
    """Typed P&L and timestamps plus `reject_reason` (NULL for rows that pass)."""
    bad_pnl, bad_ts, bad_id = _rules(decimal_pnl)
    reason = F.when(bad_pnl, REASON_PNL).when(bad_ts, REASON_TIME).when(bad_id, REASON_ID)
    return _typed(df, decimal_pnl).withColumn("reject_reason", reason)


def validate_trades(df: DataFrame, decimal_pnl: bool = False) -> DataFrame:
    """Rows that pass every rule, with typed P&L and timestamps."""
    bad_pnl, bad_ts, bad_id = _rules(decimal_pnl)
    return _typed(df, decimal_pnl).where(~bad_pnl & ~bad_ts & ~bad_id)


def reject_counts(df: DataFrame, decimal_pnl: bool = False) -> DataFrame:
    """(reject_reason, row_count) for the rows that fail, each counted under its first failing rule."""
    r = with_reject_reason(df, decimal_pnl).where(F.col("reject_reason").isNotNull())
    return r.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("row_count"))

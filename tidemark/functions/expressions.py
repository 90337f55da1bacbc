"""Column expressions shared by staging, dimensions and marts. All are built-in Spark expressions, so they stay
inside whole-stage code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values that the results depend on (they must equal the reference's).
SIDES = ("BUY", "SELL")
SEVERITY_BANDS = (("low", 1, 5), ("medium", 6, 9))  # 'high' from HIGH_SEVERITY_LEVEL up, else 'unknown'
HIGH_SEVERITY_LEVEL = 10
SOURCE_DISPLAY_NAMES = (("oanda", "OANDA Forex"), ("kraken", "Kraken Crypto"))
FOREX_MARKER = "/"
UNKNOWN_IP = "unknown"
TRADING_DAYS_PER_YEAR = 252


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def duration_minutes(entry: str | Column, exit_: str | Column) -> Column:
    """(exit - entry) in minutes as DOUBLE; exact microseconds divided once."""
    return F.timestamp_diff("MICROSECOND", col(entry), col(exit_)) / F.lit(60_000_000.0)


def is_win(pnl: str | Column) -> Column:
    return col(pnl) > 0


def severity_label(level: str | Column) -> Column:
    lv = col(level)
    expr = None
    for label, lo, hi in SEVERITY_BANDS:
        expr = (F.when(lv.between(lo, hi), label) if expr is None else expr.when(lv.between(lo, hi), label))
    return expr.when(lv >= HIGH_SEVERITY_LEVEL, "high").otherwise("unknown")


def asset_class(symbol: str | Column, marker: str = FOREX_MARKER) -> Column:
    return F.when(col(symbol).contains(marker), "forex").otherwise("crypto")


def source_display_name(source: str | Column) -> Column:
    low = F.lower(col(source))
    expr = None
    for needle, label in SOURCE_DISPLAY_NAMES:
        cond = low.contains(needle)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(F.initcap(col(source)))


def weekday_sunday0(ts: str | Column) -> Column:
    """0 = Sunday ... 6 = Saturday."""
    return (F.dayofweek(col(ts)) - 1).cast("int")


def weekday_monday0(d: str | Column) -> Column:
    """0 = Monday ... 6 = Sunday."""
    return F.weekday(col(d)).cast("int")


def day_abbrev(d: str | Column) -> Column:
    return F.date_format(col(d), "EEE")


def blank_to_null(c: str | Column) -> Column:
    return F.when(col(c) == "", None).otherwise(col(c))


def sorted_distinct_join(values: Column, sep: str = "; ") -> Column:
    """Finisher for a collect_set: sorted, joined; NULL when nothing was collected."""
    return F.when(F.size(values) > 0, F.array_join(F.sort_array(values), sep))


def round_half_up_ratio(num: Column, den: Column, digits: int, num_scale: int = 0) -> Column:
    """round(num / den, digits), half away from zero, exactly, returned as DOUBLE.

    `num` must be exact (integer, or decimal with at most `num_scale` fraction digits) and `den` a non-negative
    integer (0 gives NULL). The division is done on integers, so no intermediate rounding can move a value across
    a .5 boundary; the oracle SQL uses the same formula.
    """
    units = (num * F.lit(10 ** num_scale)).cast("decimal(38,0)")
    scaled_den = den.cast("decimal(38,0)") * F.lit(10 ** num_scale)
    numer = F.abs(units) * F.lit(2 * 10 ** digits) + scaled_den
    whole = F.signum(units).cast("decimal(38,0)") * floor_div(numer, F.lit(2) * scaled_den)
    return F.when(den == 0, None).otherwise(whole.cast("double") / F.lit(float(10 ** digits)))


EXACT = "decimal(38,18)"


def exact_scale(dtype: T.DataType) -> int:
    """Fraction digits of a money column as `exact` sums it."""
    return dtype.scale if isinstance(dtype, T.DecimalType) else 0 if isinstance(dtype, T.IntegralType) else 18


def exact(c: str | Column, dtype: T.DataType) -> Column:
    """The column as an exact number: decimals and integers as they are, others as DECIMAL(38,18), so that sums don't
    depend on the order of additions and no fraction digit of the input is cut."""
    return col(c) if isinstance(dtype, (T.DecimalType, T.IntegralType)) else col(c).cast(EXACT)


def floor_div(a: Column, b: Column) -> Column:
    """Exact floor(a / b) for a >= 0, b > 0 on decimals: the remainder is removed first, so the division is exact."""
    return ((a - F.pmod(a, b)) / b).cast("decimal(38,0)")

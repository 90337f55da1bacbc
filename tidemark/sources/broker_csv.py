"""Broker trade files (CSV with a header, one file set per broker).

The files are read as text (no schema inference pass over the data), the null words a spreadsheet export uses
are mapped to NULL, the shared columns are projected, and every other column is packed into one JSON object
`indicators` (NULL values are left out, as `to_json` does)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.alert_json import readable

# The shared trade columns every broker file must carry.
SHARED_COLS = (
    "trade_id", "symbol", "side", "outcome", "reason",
    "entry_ts", "exit_ts", "hour_utc",
    "entry_price", "exit_price", "pnl_usd", "pnl_pct",
    "signal_score", "position_size_usd", "balance_at_entry",
)
# Words read as missing by common CSV readers (pandas' defaults).
NULL_WORDS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A",
    "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


class MissingColumns(ValueError):
    pass


def _null_words(c: str) -> F.Column:
    return F.when(F.col(c).isin(*NULL_WORDS), None).otherwise(F.col(c)).alias(c)


def read_broker_csv(
    spark: SparkSession,
    path: str,
    source: str,
    extra_types: Mapping[str, str] | None = None,
    shared: Sequence[str] = SHARED_COLS,
) -> DataFrame:
    """Read one broker's files: shared columns as text, `source`, and `indicators` JSON of the other columns.

    `extra_types` gives the type of indicator columns (default string) so numbers stay numbers in the JSON.
    A missing shared column raises `MissingColumns`; a path that is missing or may not be read gives an empty frame.
    """
    if not readable(spark, path):
        return empty_trades(spark)
    raw = spark.read.option("header", True).option("inferSchema", False).csv(path)
    missing = [c for c in shared if c not in raw.columns]
    if missing:
        raise MissingColumns(f"{path}: missing shared columns {missing}")
    cleaned = raw.select(*[_null_words(c) for c in raw.columns])
    extra = [c for c in raw.columns if c not in shared and c != "source"]
    types = dict(extra_types or {})
    packed = (
        F.coalesce(F.to_json(F.struct(*[F.col(c).cast(types.get(c, "string")).alias(c) for c in extra])), F.lit("{}"))
        if extra else F.lit("{}")
    )
    return cleaned.select(*shared, F.lit(source).alias("source"), packed.alias("indicators"))


def empty_trades(spark: SparkSession, shared: Sequence[str] = SHARED_COLS) -> DataFrame:
    schema = T.StructType(
        [T.StructField(c, T.StringType()) for c in shared]
        + [T.StructField("source", T.StringType()), T.StructField("indicators", T.StringType())]
    )
    return spark.createDataFrame([], schema)


def read_brokers(spark: SparkSession, files: Sequence[tuple[str, str, Mapping[str, str] | None]]) -> DataFrame:
    """Union of all brokers' files: (path, source, extra_types) each."""
    frames = [read_broker_csv(spark, p, s, t) for p, s, t in files]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out

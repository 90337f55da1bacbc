"""Alert JSON lines: parse, flatten, derive the surrogate id, keep the recent ones, count what could not be read.

Lines are trimmed and blank ones skipped. A line that is not a JSON object, or whose timestamp text is present
but unreadable, is a parse error; a missing or empty timestamp is kept as NULL (the quality check flags it)."""

from __future__ import annotations

import datetime as dt

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# White space of any kind at either end of a line.
SPACE_AROUND = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"

ALERT_COLUMNS = ("alert_id", "timestamp", "rule_id", "rule_level", "rule_description", "agent_name", "src_ip",
                 "full_log", "raw")

ALERT_SCHEMA = T.StructType([
    T.StructField("alert_id", T.StringType()), T.StructField("timestamp", T.TimestampType()),
    T.StructField("rule_id", T.IntegerType()), T.StructField("rule_level", T.IntegerType()),
    T.StructField("rule_description", T.StringType()), T.StructField("agent_name", T.StringType()),
    T.StructField("src_ip", T.StringType()), T.StructField("full_log", T.StringType()),
    T.StructField("raw", T.StringType()),
])


def readable(spark: SparkSession, path: str) -> bool:
    """Whether the path (a file, a folder or a pattern) is there and may be read by this user."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    read = jvm.org.apache.hadoop.fs.permission.FsAction.READ
    try:
        found = fs.globStatus(where)
        if not found:
            return False
        for one in found:
            fs.access(one.getPath(), read)
        return True
    except Py4JJavaError as exc:
        if "AccessControlException" in str(exc.java_exception) or "Permission denied" in str(exc.java_exception):
            return False
        raise


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines (column `value`); a path that is missing or may not be read gives no lines rather than a failure."""
    if not readable(spark, path):
        return spark.createDataFrame([], "value string")
    return spark.read.text(path)


def _parsed(lines: DataFrame, value: str) -> DataFrame:
    """Every trimmed line with one Variant: an array of the line and the line's own hash. The parser stops after a first
    complete value, so the hash stands where it belongs only if the line is exactly one value."""
    text = F.regexp_replace(F.col(value), SPACE_AROUND, "")
    tail = F.xxhash64("__line")
    whole = F.try_parse_json(F.concat(F.lit("["), F.col("__line"), F.lit(","), tail.cast("string"), F.lit("]")))
    # inline() keeps the parse in one place: a filter on the result is not pushed below it and evaluated again
    return (lines.select(text.alias("__line"))
            .select(F.inline(F.array(F.struct(F.col("__line"), tail.alias("__tail"), whole.alias("__json"))))))


def _field(path: str) -> F.Column:
    """A field as text; rule.id and rule.level occur as text or as numbers. NULL if missing or null."""
    return F.try_variant_get("__json", f"$[0].{path}", "string")


def _not_object(name: str) -> F.Column:
    """Whether the field is there, and neither null nor an object."""
    kind = F.schema_of_variant(F.try_variant_get("__json", f"$[0].{name}", "variant"))
    return F.coalesce(~kind.startswith("OBJECT") & (kind != "VOID"), F.lit(False))


def classify(lines: DataFrame, value: str = "value") -> DataFrame:
    """Every line with its parse status (`blank`, `error`, `ok`) and, for `ok`, the alert columns."""
    read = F.col("__line").startswith("{") & (F.try_variant_get("__json", "$[1]", "bigint") == F.col("__tail"))
    nested = _not_object("rule") | _not_object("agent") | _not_object("data")
    parsed = _parsed(lines, value).select(
        "__line", (F.coalesce(read, F.lit(False)) & ~nested).alias("__read"), _field("timestamp").alias("ts"),
        _field("rule.id").alias("rule_id"), _field("rule.level").alias("level"), _field("rule.description").alias("rule"),
        _field("agent.name").alias("agent"), _field("data.srcip").alias("srcip"), _field("data.src_ip").alias("src_ip"),
        _field("full_log").alias("log"))
    ts = F.try_to_timestamp("ts")
    status = (F.when(F.col("__line") == "", "blank").when(~F.col("__read"), "error")
              .when((F.col("ts") != "") & ts.isNull(), "error").otherwise("ok"))
    alert_id = F.md5(F.concat(F.coalesce("ts", F.lit("")), F.coalesce("rule_id", F.lit("None")), F.coalesce("log", F.lit(""))))
    return parsed.select(F.inline(F.array(F.struct(
        status.alias("status"),
        alert_id.alias("alert_id"),
        ts.alias("timestamp"),
        F.col("rule_id").try_cast("int").alias("rule_id"),
        F.col("level").try_cast("int").alias("rule_level"),
        F.coalesce("rule", F.lit("")).alias("rule_description"),
        F.coalesce("agent", F.lit("")).alias("agent_name"),
        F.coalesce(F.when(F.col("srcip") != "", F.col("srcip")), F.col("src_ip")).alias("src_ip"),
        F.coalesce("log", F.lit("")).alias("full_log"),
        F.col("__line").alias("raw"),
    ))))


def alerts_from_lines(lines: DataFrame, cutoff: dt.datetime | None = None, value: str = "value") -> DataFrame:
    """The readable alerts, newer than `cutoff` (inclusive) when given; NULL times are kept."""
    c = classify(lines, value).where(F.col("status") == "ok")
    if cutoff is not None:
        c = c.where(F.col("timestamp").isNull() | (F.col("timestamp") >= F.lit(cutoff)))
    return c.select(*ALERT_COLUMNS)


def parse_report(lines: DataFrame, value: str = "value") -> DataFrame:
    """One row: lines read, blank lines, parse errors, readable alerts (one aggregation pass)."""
    c = classify(lines, value)
    return c.agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_if(F.col("status") == "blank").alias("blank_lines"),
        F.count_if(F.col("status") == "error").alias("parse_errors"),
        F.count_if(F.col("status") == "ok").alias("alerts"),
    )


def lookback_cutoff(hours: int = 24, now: dt.datetime | None = None) -> dt.datetime:
    now = now or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    return now - dt.timedelta(hours=hours)


def alert_day(ts: str = "timestamp") -> F.Column:
    """Partition day of an alert for keyed loads: a function of the alert id (which hashes the alert's time text);
    alerts without a time share one fixed day."""
    return F.coalesce(F.to_date(F.col(ts)), F.lit(dt.date(1970, 1, 1)))

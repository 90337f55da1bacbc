"""Append-only, day-partitioned, versioned Parquet tables, and dated snapshots.

Each append is one version: the rows get `batch_id = previous + 1` and `day` (UTC date of the table's time
column) and are written as the partitions `batch_id=<v>/day=<d>`. Reading as of version v is a partition filter
`batch_id <= v`, which is exact for an append-only table and prunes whole directories. Appends are not
de-duplicated (two appends of the same rows double them), as in the reference, unless `dedup_keys` are given. One
writer per table is assumed (the daily job).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.keyed_load import POSITION, counted, counter, first_per_key, partition_values, table_exists
from tidemark.session import materialize

BATCH, DAY = "batch_id", "day"


def versions(spark: SparkSession, path: str) -> list[int]:
    return partition_values(spark, path, BATCH)


def append(
    df: DataFrame, path: str, ts_col: str, dedup_keys: Sequence[str] | None = None
) -> int | None:
    """Append `df` as a new version; returns the version id, or None when there was nothing to append. With
    `dedup_keys` (which then decide the row's day as well) only the first row of a key not yet in the table is
    appended; the lookup reads only the days that the batch holds."""
    spark = df.sparkSession
    existing = versions(spark, path)
    version = (existing[-1] + 1) if existing else 1
    rows = df.withColumns({BATCH: F.lit(version), DAY: F.to_date(F.col(ts_col))})
    if dedup_keys:
        staged = materialize(rows.withColumn(POSITION, F.monotonically_increasing_id()), "append")
        rows = first_per_key(staged, dedup_keys).drop(POSITION)
        if existing:
            look = [DAY, *dedup_keys]
            hits = scan(spark, path).select(*look).join(staged.select(*look), look, "left_semi")
            rows = rows.join(hits, look, "left_anti")
    # Rebalance on the day before the partitioned write: each day's rows come together in few tasks (a hot day
    # is split by adaptive execution), so a version has about one file per day instead of one per task and day.
    rows.hint("rebalance", DAY).write.mode("append").partitionBy(BATCH, DAY).parquet(path)
    # an empty append writes no partition, so no version appears
    return version if version in versions(spark, path) else None


def scan(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def as_of(spark: SparkSession, path: str, version: int) -> DataFrame:
    return scan(spark, path).where(F.col(BATCH) <= version)


def version_report(spark: SparkSession, tables: dict[str, str]) -> DataFrame:
    """Per table: rows in each version (from the data) and whether it is the current version."""
    out = spark.createDataFrame([], "table string, version int, rows long, is_current boolean")
    for name, path in tables.items():
        cur = versions(spark, path)
        if not cur:
            continue
        out = out.unionByName(
            scan(spark, path).groupBy(BATCH).agg(F.count(F.lit(1)).alias("rows"))
            .select(F.lit(name).alias("table"), F.col(BATCH).alias("version"), "rows",
                    (F.col(BATCH) == cur[-1]).alias("is_current")))
    return out


def compact(spark: SparkSession, path: str, retain: int, out: str) -> int | None:
    """Write a copy of the table at `out` in which all versions up to the oldest of the `retain` newest are merged
    into that version, in few files per day. Every retained version reads the same rows as before; the table at
    `path` is not touched, readers move to the copy when it is complete. None if there is nothing to merge."""
    vs = versions(spark, path)
    if len(vs) <= retain:
        return None
    keep_from = vs[-retain]
    merged = scan(spark, path).withColumn(BATCH, F.greatest(F.col(BATCH), F.lit(keep_from)))
    merged.hint("rebalance", BATCH, DAY).write.partitionBy(BATCH, DAY).parquet(out)
    return keep_from


def snapshot(df: DataFrame, base: str, prefix: str, run_date: dt.date | None = None) -> str | None:
    """Daily snapshot `<base>/raw/<prefix>/run_date=<date>`; a rerun on the same day replaces it. An empty frame is
    not written and leaves an earlier snapshot of the day as it is."""
    run_date = run_date or dt.date.today()
    table = f"{base.rstrip('/')}/raw/{prefix}"
    seen = counter()
    rows = df.observe(seen, F.count(F.lit(1)).alias("n")).withColumn("run_date", F.lit(run_date))
    # dynamic: only the days that the rows hold are replaced, so none of them if there are no rows
    (rows.write.option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy("run_date").parquet(table))
    return f"{table}/run_date={run_date.isoformat()}" if counted(seen) else None


def exists(spark: SparkSession, path: str) -> bool:
    return table_exists(spark, path)

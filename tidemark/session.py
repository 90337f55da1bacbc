"""Session helpers: building a session, pinning the time zone and finding the shared scratch area."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, shuffle_partitions: int = 8, app: str = "tidemark") -> SparkSession:
    """Session for tests and benchmarks; on a cluster, use the session the platform gives you."""
    builder = (
        SparkSession.builder.master(master or os.environ.get("TIDEMARK_MASTER", "local[8]"))
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("TIDEMARK_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the session zone to UTC (every timestamp rule of the marts is a UTC rule) and make sure a
    checkpoint directory exists. The cluster's `spark.checkpoint.dir` is used when set."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by the cluster. Only in local mode, where driver and executors are one process, a
    folder of our own takes its place; on a cluster an unset folder is an error, since rows that executors write to
    their own disks would be missed when they are read back."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        master = sc.master or ""
        if master != "local" and not master.startswith("local["):
            raise RuntimeError(f"spark.checkpoint.dir is not set (master {master}): name a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="tidemark-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder, for tables a job writes and reads back."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/tidemark/{uuid.uuid4().hex}/{name}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the result survives the loss of the executors that computed it."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a (small) derived table to the shared folder and read it back. The read-back relation carries
    its real file size, so the planner's broadcast threshold is checked against actual bytes."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

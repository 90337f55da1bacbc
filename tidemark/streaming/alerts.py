"""Alert ingest as Structured Streaming.

The alert file is refreshed every 15 minutes; as a stream, each sync lands as a new file in a directory. Lines
are parsed with the batch parser and aggregated by (time, alert_id) under a watermark: the aggregation's state drops
repeats, and alerts older than the watermark are late and really dropped (a de-duplication operator would let them
pass: its key has no time that could be late). Each micro-batch goes through the keyed load in `foreachBatch` under its
own name, so the table stays unique on `alert_id` for repeats whose state is gone, and a micro-batch that is replayed
after a failure is counted once, whether it died before, between or after its rows and its entry.

The daily counts are an aggregation by day; `complete` mode rewrites the (small, one row per day and level)
result each batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.alert_json import ALERT_COLUMNS, alert_day, classify, parse_report

NO_DATA = "spark.sql.streaming.noDataMicroBatches.enabled"


def parse_counts_stream(
    spark: SparkSession, lines_dir: str, table_path: str, checkpoint: str, max_files_per_trigger: int | None = None,
) -> None:
    """Lines, blank lines, parse errors and readable alerts of the stream, as one row written whole on every batch."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    counts = parse_report(reader.load(lines_dir))

    def sink(batch: DataFrame, _batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(table_path)

    q = (counts.writeStream.outputMode("complete").foreachBatch(sink).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def alert_stream(spark: SparkSession, lines_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    parsed = classify(reader.load(lines_dir)).where(F.col("status") == "ok")
    return parsed.select(*ALERT_COLUMNS)


def ingest_alerts(
    spark: SparkSession, lines_dir: str, table_path: str, checkpoint: str, lateness: str = "24 hours",
    lookback_hours: int | None = None, max_files_per_trigger: int | None = None, one_batch: bool = False,
) -> None:
    """Run the incremental ingest over everything available now, then stop.

    `lateness`: alerts older than the newest time seen in earlier micro-batches minus this are dropped (the watermark
    that Spark applies to late rows is the one before the last micro-batch). `lookback_hours` applies the batch job's
    rule to each micro-batch as well: alerts older than the batch's processing time minus that many hours are dropped.
    Alerts without a time have no place on either clock: they go straight to the keyed load. `one_batch`: the run is one
    micro-batch of all new files, without the empty one that Spark adds to move the watermark on; runs after each sync then
    are the same micro-batches as one run over the syncs, whatever number of files a sync has.
    """
    from tidemark.operators.keyed_load import keyed_append

    stream = alert_stream(spark, lines_dir, max_files_per_trigger)
    if lookback_hours is not None:
        cutoff = F.current_timestamp() - F.make_dt_interval(hours=F.lit(lookback_hours))
        stream = stream.where(F.col("timestamp").isNull() | (F.col("timestamp") >= cutoff))
    rest = [c for c in ALERT_COLUMNS if c not in ("timestamp", "alert_id")]
    timed = (stream.where(F.col("timestamp").isNotNull()).withWatermark("timestamp", lateness)
             .groupBy("timestamp", "alert_id").agg(F.first(F.struct(*rest)).alias("alert"))
             .select("alert_id", "timestamp", "alert.*").select(*ALERT_COLUMNS))
    stream = timed.unionByName(stream.where(F.col("timestamp").isNull()))

    def sink(batch: DataFrame, batch_id: int) -> None:
        # partitioned by the alert's day, so each micro-batch looks up only the days it touches
        keyed_append(spark, table_path, batch.withColumn("day", alert_day()), ("alert_id",), prune_col="day",
                     batch_name=f"{checkpoint}#{batch_id}")

    writer = (stream.writeStream.outputMode("update").foreachBatch(sink).option("checkpointLocation", checkpoint)
              .trigger(availableNow=True))
    kept = spark.conf.get(NO_DATA)
    if one_batch:
        spark.conf.set(NO_DATA, "false")
    try:
        q = writer.start()         # the query keeps the session's settings as they are here
    finally:
        if one_batch:
            spark.conf.set(NO_DATA, kept)
    q.awaitTermination()


def daily_counts_stream(
    spark: SparkSession, lines_dir: str, table_path: str, checkpoint: str,
) -> None:
    """Alerts per (UTC day, level), maintained as a stream and written whole on every batch. Alerts without a time
    are counted under a NULL day, as in the batch mart."""
    counts = (
        alert_stream(spark, lines_dir)
        .groupBy(F.to_date("timestamp").alias("date"), "rule_level")
        .agg(F.count(F.lit(1)).alias("alert_count"))
    )

    def sink(batch: DataFrame, _batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(table_path)

    q = (counts.writeStream.outputMode("complete").foreachBatch(sink).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()

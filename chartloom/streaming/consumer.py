"""Streaming queries: the chart feed, native deduplication, stateful totals."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from chartloom.registry import Lake
from chartloom.sinks.tables import replace_partitions
from chartloom.sources.feed import parse_messages
from chartloom.streaming.microbatch import ChartSink
from chartloom.streaming.progress import record_progress

TRIGGER = "10 seconds"


def _triggered(writer, trigger: str | None):
    """A repeating trigger, or None to work off what is there and stop."""
    return writer.trigger(availableNow=True) if trigger is None else writer.trigger(processingTime=trigger)


def start_chart_feed(
    messages: DataFrame, lake: Lake, sink: ChartSink | None = None, trigger: str | None = TRIGGER
) -> StreamingQuery:
    """Run the feed into the lake. The checkpoint keeps offsets, so a restart continues."""
    writer = (
        parse_messages(messages).writeStream
        .foreachBatch(sink or ChartSink(lake))
        .option("checkpointLocation", lake.checkpoint("charts_streaming"))
    )
    return _triggered(writer, trigger).start()


def start_consumer(messages: DataFrame, lake: Lake, trigger: str = TRIGGER) -> None:
    """Run the feed until it is stopped; the progress of every batch is recorded in the lake."""
    record_progress(messages.sparkSession, lake)
    start_chart_feed(messages, lake, trigger=trigger).awaitTermination()


def event_time(df: DataFrame, column: str) -> DataFrame:
    """Watermarks need a zoned timestamp."""
    return df.withColumn(column, F.col(column).cast("timestamp"))


def dedup_within(stream: DataFrame, keys: list[str], time_column: str, delay: str) -> DataFrame:
    """First arrival per key; a key's state is dropped once the watermark passes it by `delay`."""
    return (
        stream.transform(event_time, time_column)
        .withWatermark(time_column, delay)
        .dropDuplicatesWithinWatermark(keys)
    )


def stateful_totals(entries: DataFrame, time_column: str, delay: str | None = None) -> DataFrame:
    """Artist-month totals kept as streaming state.

    With a `delay` the month's time takes part in the grouping key and old months leave the state.
    """
    with_streams = entries.where(F.col("streams").isNotNull()).transform(event_time, time_column)
    month = F.date_trunc("month", time_column)
    if delay:
        # each month is an event-time window of its own: the window's start orders the state
        with_streams = with_streams.withColumn(time_column, month).withWatermark(time_column, delay)
        month = F.col(time_column)
    return with_streams.groupBy("artist", month.alias("month_ts")).agg(
        F.sum("streams").alias("monthly_streams"), F.count(F.lit(1)).alias("chart_entries")
    )


def start_keyed_upserts(totals: DataFrame, path: str, checkpoint: str, trigger: str | None = TRIGGER) -> StreamingQuery:
    """Write the groups each batch changed under the batch's id (update mode)."""
    def write(batch: DataFrame, batch_id: int) -> None:
        changed = batch.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        replace_partitions(changed, path, ("batch_id",))

    writer = totals.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
    return _triggered(writer, trigger).start()


def current_totals(versions: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """The newest version of every key; each task forwards one version per key."""
    newest = F.max_by(F.struct(*values), "batch_id").alias("v")
    return versions.groupBy(*keys).agg(newest).select(*keys, "v.*")


def progress_metrics(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """What the engine still remembers of the query's batches, the latest 100 by default; `progress.records` has all."""
    rows = [
        (int(p["batchId"]), int(p["numInputRows"]), float(p["durationMs"].get("triggerExecution", 0)),
         float(p.get("processedRowsPerSecond") or 0.0), p["timestamp"])
        for p in query.recentProgress
    ]
    frame = spark.createDataFrame(
        rows, "batch_id bigint, rows bigint, processing_ms double, throughput_rows_per_sec double, ts string"
    )
    return frame.where(F.col("rows") > 0)

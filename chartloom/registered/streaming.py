"""Streaming queries: the event table as an unbounded feed, worked off in several batches, with a restart and a replay."""

from pyspark.sql import functions as F

from chartloom import bindings
from chartloom.operators.cleaning import cast_date_with_fallback, cast_numeric_columns
from chartloom.plans import serving
from chartloom.registered.catalog import query
from chartloom.registered.expected import expect
from chartloom.registry import Lake
from chartloom.sinks.staging import staging_path
from chartloom.sources.feed import file_feed, file_stream, parse_messages
from chartloom.sources.files import load_gold, read_table
from chartloom.streaming import consumer, microbatch

FILES = 4  # that each batch of the feed consists of


def _events(spark, folder):
    return file_stream(spark, f"{folder}/events.parquet", bindings.TABLES["events"])


def _consumed(spark, folder, sink=None) -> Lake:
    """A lake into which the whole feed has run: two triggers under a rate limit, a restart for the third, the second once more."""
    lake, source = Lake(staging_path(spark, "feed")), staging_path(spark, "feed-files")
    sink = sink or microbatch.ChartSink(lake)
    sink.lake = lake
    batches = [bindings.feed_batch(spark, folder, n) for n in range(bindings.FEED_BATCHES)]
    for n, messages in enumerate(batches):
        messages.repartition(FILES).write.mode("append").text(source)
        if n:
            consumer.start_chart_feed(file_feed(spark, source, max_files=FILES), lake, sink, trigger=None).awaitTermination()
    sink(parse_messages(batches[1]), 1)
    return lake


@query("stream_cleaned", expect("stream_entries", (
    'SELECT title, CAST("rank" AS BIGINT) AS "rank", artist, url, region, chart, trend, streams, track_id,'
    " CAST(chart_date AS VARCHAR) AS chart_date, year, month, CAST(month_start AS VARCHAR) AS month_start,"
    " batch_id FROM stream_entries"
)))
def stream_cleaned(spark, folder):
    return read_table(spark, _consumed(spark, folder), "silver.charts_streaming").drop("ingestion_ts")


@query("stream_bronze", expect("feed feed_batches", (
    'SELECT title, "rank", date, artist, url, region, chart, trend, streams, batch_id'
    " FROM feed JOIN feed_batches ON CAST(ingestion_ts AS DATE) BETWEEN first_of AND last_of WHERE event_id % 37 <> 9"
)))
def stream_bronze(spark, folder):
    return read_table(spark, _consumed(spark, folder), "bronze.charts_streaming").drop("ingestion_ts")


_TOTAL_ROWS = "SELECT artist, CAST(month_start AS VARCHAR) AS month_start, monthly_streams, chart_entries"


@query("incremental_totals", expect("stream_totals", f"{_TOTAL_ROWS} FROM stream_totals"))
def incremental_totals(spark, folder):
    return load_gold(spark, _consumed(spark, folder), "top_artists_streaming").select(
        "artist", "month_start", "monthly_streams", "chart_entries"
    )


@query("totals_as_of_batch", expect("stream_entries", (
    "SELECT artist, CAST(month_start AS VARCHAR) AS month_start, CAST(sum(streams) AS BIGINT) AS monthly_streams,"
    " count(*) AS chart_entries FROM stream_entries WHERE streams IS NOT NULL AND batch_id <= 1 GROUP BY artist, month_start"
)))
def totals_as_of_batch(spark, folder):
    """The streaming leaderboard as it was served after the second batch."""
    return load_gold(spark, _consumed(spark, folder), "top_artists_streaming", version=1).select(
        "artist", "month_start", "monthly_streams", "chart_entries"
    )


@query("recomputed_totals", expect("stream_totals", f"{_TOTAL_ROWS} FROM stream_totals"))
def recomputed_totals(spark, folder):
    return microbatch.recompute_totals(read_table(spark, _consumed(spark, folder), "silver.charts_streaming"))


@query("recleaned_batch", expect("stream_entries", (
    "SELECT batch_id, count(*) AS entries, CAST(sum(coalesce(streams, 0)) AS BIGINT) AS streams,"
    " CASE WHEN batch_id = 1 THEN 'recovered' ELSE 'never failed' END AS state FROM (SELECT * EXCLUDE (batch_id),"
    " coalesce((SELECT min(f.batch_id) FROM feed_batches f WHERE f.batch_id <> 1 AND s.chart_date BETWEEN first_of AND last_of), 1) AS batch_id"
    " FROM stream_entries s) GROUP BY batch_id"
)))
def recleaned_batch(spark, folder):
    """The second batch cannot be cleaned, is left out, and comes in from bronze after the third; entries by batch."""
    built = []

    def clean(raw):
        built.append(raw)
        entries = microbatch.transform_charts(raw)
        return entries.withColumn("title", F.raise_error(F.lit("no such title"))) if len(built) == 2 else entries

    sink = microbatch.ChartSink(Lake(""), clean=clean)
    lake = _consumed(spark, folder, sink)
    sink.reclean(spark)
    states = microbatch.ledger(spark, lake).select("batch_id", "state")
    entries = read_table(spark, lake, "silver.charts_streaming").groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("entries"), F.sum(F.coalesce("streams", F.lit(0))).alias("streams"))
    return entries.join(F.broadcast(states), "batch_id", "left").withColumn("state", F.coalesce("state", F.lit("never failed")))


@query("live_top10", expect("stream_totals", (
    "SELECT artist, CAST(sum(monthly_streams) AS BIGINT) AS streams FROM stream_totals GROUP BY artist"
    " ORDER BY streams DESC NULLS LAST, artist LIMIT 10"
)))
def live_top10(spark, folder):
    return serving.live_top10(load_gold(spark, _consumed(spark, folder), "top_artists_streaming"))


@query("stream_recent_100", expect("stream_recent", (
    'SELECT artist, title, region, chart, CAST("rank" AS BIGINT) AS "rank", streams,'
    " CAST(chart_date AS VARCHAR) AS chart_date FROM stream_recent"
)))
def stream_recent_100(spark, folder):
    return load_gold(spark, _consumed(spark, folder), "recent_submissions").drop("batch_id", "ingestion_ts")


@query("recent_rows_served", expect("stream_recent", (
    "SELECT artist, title, region, chart, '#' || \"rank\" AS \"rank\", coalesce(format('{:,}', streams), '—') AS streams,"
    " CAST(chart_date AS VARCHAR) AS chart_date FROM stream_recent"
    ' ORDER BY batch_id DESC, stream_recent.chart_date, region, chart, stream_recent."rank", artist, title LIMIT 20'
)))
def recent_rows_served(spark, folder):
    """The page's newest rows, from the table that serves them."""
    return serving.recent_rows(load_gold(spark, _consumed(spark, folder), "recent_submissions")).drop("ingestion_ts")


@query("stream_batch_metrics", expect("feed feed_batches", (
    "SELECT batch_id, count(*) AS rows, CAST(sum(count(*)) OVER (ORDER BY batch_id) AS BIGINT) AS bronze_total_rows, TRUE AS timed"
    " FROM feed JOIN feed_batches ON CAST(ingestion_ts AS DATE) BETWEEN first_of AND last_of WHERE event_id % 37 <> 9 GROUP BY batch_id"
)))
def stream_batch_metrics(spark, folder):
    metrics = load_gold(spark, _consumed(spark, folder), "batch_metrics")
    timed = (F.col("processing_ms") > 0) & (F.col("throughput_rows_per_sec") > 0) & F.col("ts").isNotNull()
    return metrics.select("batch_id", "rows", "bronze_total_rows", timed.alias("timed"))


@query("stateful_totals", expect("typed", (
    "SELECT artist, CAST(CAST(date_trunc('month', chart_date) AS DATE) AS VARCHAR) AS month_start,"
    " CAST(sum(streams) AS BIGINT) AS monthly_streams, count(*) AS chart_entries FROM typed"
    " WHERE event_id % 37 <> 9 AND chart_date IS NOT NULL AND streams IS NOT NULL GROUP BY ALL"
)))
def stateful_totals(spark, folder):
    """Artist-month totals held in streaming state; every batch emits the groups it changed."""
    entries = (
        parse_messages(bindings.feed_messages(_events(spark, folder)).select("value"))
        .transform(cast_date_with_fallback).transform(cast_numeric_columns)
        .where(F.col("chart_date").isNotNull())
    )
    root = staging_path(spark, "stateful")
    totals = consumer.stateful_totals(entries, "chart_date", "400 days")
    consumer.start_keyed_upserts(totals, f"{root}/versions", f"{root}/checkpoint", None).awaitTermination()
    current = consumer.current_totals(
        spark.read.parquet(f"{root}/versions"), ["artist", "month_ts"], ["monthly_streams", "chart_entries"]
    )
    return current.select(
        "artist", F.col("month_ts").cast("date").alias("month_start"), "monthly_streams", "chart_entries"
    )


@query("stream_dedup_watermark", (
    "SELECT DISTINCT user_id, event_type, CAST(CAST(ts AS DATE) AS VARCHAR) AS chart_date FROM events"
))
def stream_dedup_watermark(spark, folder):
    """One entry per user, event type and day, deduplicated by the streaming engine itself."""
    root = staging_path(spark, "dedup")
    events = _events(spark, folder).select("user_id", "event_type", "ts", F.col("ts").cast("date").alias("chart_date"))
    unique = consumer.dedup_within(events, ["user_id", "event_type", "chart_date"], "ts", "45 days")
    (
        unique.select("user_id", "event_type", "chart_date").writeStream.format("parquet")
        .option("path", f"{root}/out").option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True).start().awaitTermination()
    )
    return spark.read.parquet(f"{root}/out")



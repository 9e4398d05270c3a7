"""The feed over several micro-batches: upsert, replay, restart, failures, incremental marts."""

import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from chartloom.operators import cleaning
from chartloom.plans import runmetrics
from chartloom.registry import Lake
from chartloom.sinks import batches
from chartloom.sinks.staging import staging_path
from chartloom.sources.feed import file_feed, parse_messages
from chartloom.sources.files import load_gold, read_table
from chartloom.streaming import consumer, microbatch

URL = "https://charts.example.com/track/T{}"


def message(track, day, rank=1, region="us", chart="top200", streams="10", month=1):
    return json.dumps({
        "title": f"t{track}", "rank": str(rank), "date": f"2024-{month:02d}-{day:02d}", "artist": f"a{track % 2}",
        "url": URL.format(track), "region": region, "chart": chart, "trend": "NEW", "streams": streams,
    })


BATCHES = [
    [message(1, 1), message(2, 1, 2), message(2, 1, 3), "{broken", message(3, 1, 4, streams="")],
    [message(1, 1, streams="99"), message(1, 2), message(4, 2, 2), message(5, 2, "N/A")],
    [message(1, 2), message(6, 1, 1, month=2), message(2, 1, 2, region="gb")],
]


@pytest.fixture()
def feed_folder(tmp_path):
    folder = tmp_path / "feed"
    folder.mkdir()
    return folder


def put(folder, n, lines):
    path = folder / f"part-{n}.txt"
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    import os
    os.utime(path, (1_700_000_000 + n * 10, 1_700_000_000 + n * 10))


def run(spark, folder, lake, **kwargs):
    query = consumer.start_chart_feed(file_feed(spark, str(folder)), lake, trigger=None, **kwargs)
    query.awaitTermination()
    return query


def silver(spark, lake):
    return sorted(
        (r.track_id, r.chart_date, r.region, r["rank"], r.streams, r.batch_id)
        for r in read_table(spark, lake, "silver.charts_streaming").collect()
    )


WANT_SILVER = [
    ("T1", date(2024, 1, 1), "us", 1, 10, 0), ("T1", date(2024, 1, 2), "us", 1, 10, 1),
    ("T2", date(2024, 1, 1), "gb", 2, 10, 2), ("T2", date(2024, 1, 1), "us", 2, 10, 0),
    ("T3", date(2024, 1, 1), "us", 4, None, 0), ("T4", date(2024, 1, 2), "us", 2, 10, 1),
    ("T6", date(2024, 2, 1), "us", 1, 10, 2),
]


def totals(df):
    return sorted((r.artist, r.month_start, r.monthly_streams, r.chart_entries) for r in df.collect())


def test_three_batches_replay_and_restart(spark, feed_folder):
    lake = Lake(staging_path(spark, "lake"))
    for n, lines in enumerate(BATCHES):
        put(feed_folder, n, lines)
    run(spark, feed_folder, lake)
    assert silver(spark, lake) == WANT_SILVER

    gold = totals(load_gold(spark, lake, "top_artists_streaming"))
    assert gold == totals(microbatch.recompute_totals(read_table(spark, lake, "silver.charts_streaming")))
    partials = read_table(spark, lake, "gold.top_artists_partials")
    assert totals(microbatch.totals_as_of(partials, 0)) == [
        ("a0", date(2024, 1, 1), 10, 1), ("a1", date(2024, 1, 1), 10, 1)
    ]
    recent = microbatch.latest_snapshot(load_gold(spark, lake, "recent_submissions"))
    assert recent.count() == len(WANT_SILVER)

    metrics = load_gold(spark, lake, "batch_metrics").orderBy("batch_id").collect()
    assert [(r.batch_id, r["rows"], r.bronze_total_rows) for r in metrics] == [(0, 4, 4), (1, 4, 8), (2, 3, 11)]
    summary = runmetrics.batch_summary(load_gold(spark, lake, "batch_metrics")).first()
    assert (summary.batches, summary.total_rows) == (3, 11)

    # the middle batch is delivered again
    sink = microbatch.ChartSink(lake)
    again = parse_messages(spark.createDataFrame([(m,) for m in BATCHES[1]], "value string"))
    sink(again, 1)
    assert silver(spark, lake) == WANT_SILVER
    assert totals(load_gold(spark, lake, "top_artists_streaming")) == gold
    assert read_table(spark, lake, "bronze.charts_streaming").count() == 11
    assert load_gold(spark, lake, "batch_metrics").count() == 3

    # a restart from the checkpoint sees only what is new
    put(feed_folder, 9, [message(9, 9)])
    run(spark, feed_folder, lake)
    assert len(silver(spark, lake)) == len(WANT_SILVER) + 1
    sink(again.limit(0), 17)
    assert load_gold(spark, lake, "batch_metrics").count() == 4


def test_a_failed_silver_write_is_retried_and_loses_nothing(spark, monkeypatch):
    lake = Lake(staging_path(spark, "lake"))
    sink = microbatch.ChartSink(lake)

    write, calls = batches.write_folder, []

    def fail_once(df, path, *args, **how):
        if "silver" in path and not calls:
            calls.append(path)
            raise OSError("storage is away")
        return write(df, path, *args, **how)

    monkeypatch.setattr(batches, "write_folder", fail_once)
    batch = parse_messages(spark.createDataFrame([(message(1, 1),), (message(2, 2),)], "value string"))
    with pytest.raises(OSError, match="storage"):
        sink(batch, 0)
    assert read_table(spark, lake, "bronze.charts_streaming").count() == 2
    assert load_gold(spark, lake, "batch_metrics").count() == 0
    sink(batch, 0)
    assert read_table(spark, lake, "bronze.charts_streaming").count() == 2
    assert read_table(spark, lake, "silver.charts_streaming").count() == 2
    assert load_gold(spark, lake, "batch_metrics").count() == 1


def test_the_loader_serves_one_snapshot(spark):
    lake = Lake(staging_path(spark, "lake"))
    sink = microbatch.ChartSink(lake)
    for b in range(3):
        sink(parse_messages(spark.createDataFrame([(message(b + 1, b + 1),)], "value string")), b)
    assert load_gold(spark, lake, "recent_submissions").count() == 3
    assert load_gold(spark, lake, "recent_submissions", version=1).count() == 2
    assert read_table(spark, lake, "gold.recent_submissions").count() == 6


def test_recent_snapshot_equals_a_full_sort(spark):
    lake = Lake(staging_path(spark, "lake"))
    sink = microbatch.ChartSink(lake)
    for b in range(3):
        rows = [message(100 * b + i, 1 + i % 28, 1 + i % 100, region=f"r{i % 9}") for i in range(70)]
        sink(parse_messages(spark.createDataFrame([(m,) for m in rows], "value string")), b)
    snapshot = microbatch.latest_snapshot(load_gold(spark, lake, "recent_submissions")).drop("batch_id")
    full = microbatch.recent_entries(read_table(spark, lake, "silver.charts_streaming"))
    key = ["ingestion_ts", "region", "title", "chart_date"]
    assert snapshot.count() == 100
    assert [tuple(r[c] for c in key) for r in snapshot.orderBy(*key).collect()] == [
        tuple(r[c] for c in key) for r in full.orderBy(*key).collect()
    ]


def test_batch_and_stream_cleaning_agree(spark, feed_folder):
    put(feed_folder, 0, BATCHES[0])
    lake = Lake(staging_path(spark, "lake"))
    run(spark, feed_folder, lake)
    raw = parse_messages(spark.read.text(str(feed_folder))).withColumn("ingestion_ts", F.current_timestamp())
    want = cleaning.transform_charts(raw).dropDuplicates(microbatch.MERGE_KEY).select(*microbatch.MERGE_KEY)
    got = read_table(spark, lake, "silver.charts_streaming").select(*microbatch.MERGE_KEY)
    assert sorted(map(tuple, want.collect())) == sorted(map(tuple, got.collect()))


def entries_stream(spark, folder):
    return (
        parse_messages(file_feed(spark, str(folder)))
        .transform(cleaning.cast_date_with_fallback).transform(cleaning.cast_numeric_columns)
        .where(F.col("chart_date").isNotNull())
    )


def test_stateful_totals_upsert_changed_groups(spark, feed_folder):
    for n, lines in enumerate(BATCHES):
        put(feed_folder, n, lines)
    root = staging_path(spark, "state")
    query = consumer.start_keyed_upserts(
        consumer.stateful_totals(entries_stream(spark, feed_folder), "chart_date", "400 days"),
        f"{root}/v", f"{root}/c", None,
    )
    query.awaitTermination()
    versions = spark.read.parquet(f"{root}/v")
    current = consumer.current_totals(versions, ["artist", "month_ts"], ["monthly_streams", "chart_entries"])
    got = sorted((r.artist, r.month_ts.date(), r.monthly_streams, r.chart_entries) for r in current.collect())
    rows = [json.loads(m) for b in BATCHES for m in b if m.startswith('{"') and m.endswith("}")]
    want = {}
    for r in rows:
        if r["streams"]:
            key = (r["artist"], date.fromisoformat(r["date"]).replace(day=1))
            s, n = want.get(key, (0, 0))
            want[key] = (s + int(r["streams"]), n + 1)
    assert got == sorted((a, d, s, n) for (a, d), (s, n) in want.items())
    progress = consumer.progress_metrics(spark, query)
    assert progress.agg(F.sum("rows")).first()[0] >= len(rows)


def test_watermark_dedup_keeps_first_arrivals(spark, feed_folder):
    for n, lines in enumerate(BATCHES):
        put(feed_folder, n, lines)
    root = staging_path(spark, "dedup")
    unique = consumer.dedup_within(entries_stream(spark, feed_folder), ["url", "region", "chart_date"], "chart_date", "60 days")
    (
        unique.select("url", "region", "chart_date").writeStream.format("parquet").option("path", f"{root}/o")
        .option("checkpointLocation", f"{root}/c").trigger(availableNow=True).start().awaitTermination()
    )
    out = spark.read.parquet(f"{root}/o")
    assert out.count() == out.distinct().count() == 8

"""Tables of batches: bounded folders, replays, versions, pins; left-out batches; lasting progress."""

import json
import time
from datetime import date

import pytest
from pyspark.sql import functions as F

from chartloom import schemas
from chartloom.operators.cleaning import transform_charts
from chartloom.registry import Lake, register_views
from chartloom.sinks import batches
from chartloom.sinks.staging import staging_path
from chartloom.sources.feed import parse_messages
from chartloom.sources.files import load_gold, read_table
from chartloom.streaming import microbatch, progress

SCHEMA = schemas._struct("v bigint, month date, batch_id bigint")


def rows(spark, batch, n=3, months=(1,)):
    return spark.createDataFrame([(batch * 10 + i, date(2024, m, 1), batch) for i in range(n) for m in months], SCHEMA)


def everything(table):
    return sorted((r.v, r.month, r.batch_id) for r in table.read().collect())


def listed(table):
    """What one batch has to list: lists of versions, folders of its month, folders of the table."""
    return len(table.files.names("_live")), len(table.folders(["2024-01-01"])), len(table.files.names("data"))


def test_a_batch_lists_as_much_after_fifty_batches_as_after_a_few(spark):
    table = batches.BatchTable(spark, staging_path(spark, "batches"), SCHEMA, "month", whole=True, fold=4, keep=6)
    sizes = []
    for b in range(50):
        table.add(rows(spark, b), b)
        table.fold()
        sizes.append(listed(table))
    early, late = sizes[8:16], sizes[42:50]
    for k in range(3):
        assert max(s[k] for s in late) <= max(s[k] for s in early)
    assert max(s[1] for s in sizes) <= 4
    assert everything(table) == sorted((b * 10 + i, date(2024, 1, 1), b) for b in range(50) for i in range(3))
    assert [r.v for r in table.of_batch(17).orderBy("v").collect()] == [170, 171, 172]


def test_levels_keep_rewrites_few(spark):
    table = batches.BatchTable(spark, staging_path(spark, "batches"), SCHEMA, fold=3)
    for b in range(20):
        table.add(rows(spark, b, 1), b)
        table.fold()
    assert sorted(f.level for f in table.folders()) == [0, 0, 2, 2]  # 20 = 2 x 9 + 2
    assert table.read().count() == 20


def test_replays_and_unpublished_attempts(spark, monkeypatch):
    table = batches.BatchTable(spark, staging_path(spark, "batches"), SCHEMA, "month", whole=True, fold=2, keep=3)
    for b in range(2):
        table.add(rows(spark, b, months=(1, 2)), b)
    before = everything(table)
    publish = batches.BatchTable._publish
    monkeypatch.setattr(batches.BatchTable, "_publish", lambda self, live: (_ for _ in ()).throw(OSError("gone")))
    with pytest.raises(OSError):
        table.fold()  # written, not published
    with pytest.raises(OSError):
        table.add(rows(spark, 2), 2)
    assert everything(table) == before and table.live().has(1) and not table.live().has(2)
    monkeypatch.setattr(batches.BatchTable, "_publish", publish)
    assert table.fold() and everything(table) == before
    table.add(rows(spark, 2), 2)
    for _ in range(4):
        table.skip(9)
        table.add(rows(spark, 9, 0), 9)
        table.fold()
    table.clean()
    named = {f.path.split("/")[1] for v in table._versions() for f in table.folders(live=batches.Live.of(table.files.read(f"_live/{v[2]}")))}
    assert set(table.files.names("data")) == named  # what was never published is gone
    assert len(everything(table)) == len(before) + 3


def test_left_out_batches_come_late(spark):
    table = batches.BatchTable(spark, staging_path(spark, "batches"), SCHEMA)
    table.add(rows(spark, 0), 0)
    table.skip(1)
    table.skip(1)
    table.add(rows(spark, 2), 2)
    assert [table.live().has(b) for b in range(4)] == [True, False, True, False]
    table.add(rows(spark, 1), 1)
    assert [table.live().has(b) for b in range(4)] == [True, True, True, False] and table.live().batch == 2


def test_versions_pins_and_the_low_water_mark(spark):
    table = batches.BatchTable(spark, staging_path(spark, "batches"), SCHEMA, "month", whole=True, keep=3)
    for b in range(3):
        table.add(rows(spark, b), b, replace_keys=True)
    with table.pinned(1) as was:
        for b in range(3, 30):
            table.add(rows(spark, b, months=(1, 2)), b, replace_keys=True)
            table.fold()
        assert sorted(r.batch_id for r in was.collect()) == [1, 1, 1]  # still there for its reader
        assert table.read(live=table.live(28)).agg(F.min("batch_id"), F.max("batch_id")).first()[:] == (28, 28)
    table.clean()
    with pytest.raises(ValueError, match="removed"):
        table.live(1)
    with pytest.raises(ValueError, match="removed"), table.pinned(1):
        pass
    assert {r.batch_id for r in table.read(live=table.live(99)).collect()} == {29}
    assert not [n for n in table.files.names("_live") if n.startswith("pin")]


def test_empty_table(spark):
    table = batches.BatchTable(spark, staging_path(spark, "batches"), SCHEMA, "month")
    table.create()
    assert table.read().count() == 0 and table.newest().count() == 0 and table.of_batch(3).count() == 0
    assert not table.fold()
    assert table.add(rows(spark, 0, 0), 0)["rows"] == 0 and table.live().has(0) and not table.folders()


# --- the feed -----------------------------------------------------------------------

def batch_of(spark, *tracks, month=1, artist=None):
    return parse_messages(spark.createDataFrame([(json.dumps({
        "title": f"t{t}", "rank": str(i + 1), "date": f"2024-{month:02d}-{1 + t % 28:02d}", "artist": artist or f"a{t % 2}",
        "url": f"https://charts.example.com/track/T{t}", "region": "us", "chart": "top200", "trend": "NEW", "streams": "10",
    }),) for i, t in enumerate(tracks)], "value string"))


def totals(df):
    return sorted((r.artist, r.month_start, r.monthly_streams, r.chart_entries) for r in df.collect())


def picky(raw):
    """Fails on the rows of one artist, as a cleaning with a fault would."""
    bad = F.col("artist") == "poison"
    return transform_charts(raw.withColumn("title", F.when(bad, F.raise_error(F.lit("no such artist"))).otherwise(F.col("title"))))


def test_a_batch_that_cannot_be_cleaned_is_left_out_and_comes_back(spark):
    lake = Lake(staging_path(spark, "lake"))
    sink = microbatch.ChartSink(lake, clean=picky)
    sink(batch_of(spark, 1, 2), 0)
    poison = batch_of(spark, 3, 4, 5, artist="poison")
    sink(poison, 1)
    sink(batch_of(spark, 6, month=2), 2)
    assert read_table(spark, lake, "bronze.charts_streaming").count() == 6
    silver = read_table(spark, lake, "silver.charts_streaming")
    assert sorted(r.batch_id for r in silver.collect()) == [0, 0, 2]
    listed = microbatch.failed_batches(spark, lake).collect()
    assert [(r.batch_id, r.step, r.state) for r in listed] == [(1, "cleaning", "failed")] and "no such artist" in listed[0].reason
    assert load_gold(spark, lake, "batch_metrics").agg(F.max("bronze_total_rows")).first()[0] == 6
    sink(poison, 1)  # delivered again: still left out
    assert microbatch.ChartSink(lake, clean=picky).reclean(spark) == []  # the fault is still there
    assert microbatch.failed_batches(spark, lake).count() == 1
    mended = microbatch.ChartSink(lake)
    assert mended.reclean(spark, [0, 1]) == [1] and mended.reclean(spark) == []
    silver = read_table(spark, lake, "silver.charts_streaming")
    assert sorted(r.batch_id for r in silver.collect()) == [0, 0, 1, 1, 1, 2]
    assert totals(load_gold(spark, lake, "top_artists_streaming")) == totals(microbatch.recompute_totals(silver))
    assert load_gold(spark, lake, "recent_submissions").count() == 6
    assert [r.state for r in microbatch.ledger(spark, lake).collect()] == ["recovered"]


def test_an_interrupted_reclean_can_be_repeated(spark, monkeypatch):
    lake = Lake(staging_path(spark, "lake"))
    sink = microbatch.ChartSink(lake, clean=picky)
    sink(batch_of(spark, 3, 4, artist="poison"), 0)
    mended = microbatch.ChartSink(lake)
    monkeypatch.setattr(microbatch.ChartSink, "update_totals", lambda *_: (_ for _ in ()).throw(OSError("storage is away")))
    with pytest.raises(OSError):
        mended.reclean(spark)
    monkeypatch.undo()
    assert microbatch.failed_batches(spark, lake).count() == 1
    assert mended.reclean(spark) == [0]
    silver = read_table(spark, lake, "silver.charts_streaming")
    assert silver.count() == 2 and totals(load_gold(spark, lake, "top_artists_streaming")) == totals(microbatch.recompute_totals(silver))


def test_a_cleaning_that_is_no_plan_is_left_out_too(spark):
    lake = Lake(staging_path(spark, "lake"))
    sink = microbatch.ChartSink(lake, clean=lambda raw: transform_charts(raw.select("no_such_column")))
    sink(batch_of(spark, 1), 0)
    assert "no_such_column" in microbatch.failed_batches(spark, lake).first().reason


def test_errors_of_storage_are_not_taken_for_faults(spark):
    assert microbatch.lasting_reason(OSError("disk")) is None and microbatch.lasting_reason(ValueError("?")) is None
    with pytest.raises(Exception) as missing:
        spark.read.schema("a int").parquet(staging_path(spark, "nothing")).collect()
    assert microbatch.lasting_reason(missing.value) is not None  # a missing path is an error of the plan
    path = staging_path(spark, "lost")
    spark.range(5).write.parquet(path)
    df = spark.read.parquet(path)
    files = batches.Files(spark, path)
    for name in files.names(""):
        files.delete(name)
    with pytest.raises(Exception) as lost:
        df.collect()
    assert microbatch.lasting_reason(lost.value) is None
    with pytest.raises(Exception) as bad:
        spark.range(5).select(F.expr("assert_true(id < 3)")).collect()
    assert microbatch.lasting_reason(bad.value)


def test_marts_travel_by_batch(spark):
    lake = Lake(staging_path(spark, "lake"))
    sink = microbatch.ChartSink(lake)
    for b in range(12):
        sink(batch_of(spark, 2 * b, 2 * b + 1, month=1 + b % 2), b)
    partials = read_table(spark, lake, "gold.top_artists_partials")
    for n in (0, 3, 7, 11):
        assert totals(load_gold(spark, lake, "top_artists_streaming", version=n)) == totals(microbatch.totals_as_of(partials, n))
        assert load_gold(spark, lake, "recent_submissions", version=n).count() == 2 * n + 2
    sink._tables["gold.top_artists_streaming"].keep = 2
    sink._tables["gold.top_artists_streaming"].clean()
    with pytest.raises(ValueError, match="removed"):
        load_gold(spark, lake, "top_artists_streaming", version=3)
    assert "gold_top_artists_streaming" in register_views(spark, lake)


def test_progress_outlives_the_query(spark, tmp_path):
    source, lake = tmp_path / "in", Lake(staging_path(spark, "lake"))
    source.mkdir()
    record = progress.record_progress(spark, lake)
    assert progress.record_progress(spark, lake) is record
    record.block = 10

    def run(first, last):
        for n in range(first, last):
            (source / f"{n:04d}.txt").write_text(f"row {n}\n")
        stream = spark.readStream.schema("value string").option("maxFilesPerTrigger", "1").text(str(source))
        query = (stream.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start())
        query.awaitTermination()
        return query

    def seen(n):
        for _ in range(100):  # the engine reports from a thread of its own
            found = progress.records(spark, progress.progress_path(lake)).where("rows > 0")
            if found.count() >= n:
                break
            time.sleep(0.1)
        return found

    try:
        first = run(0, 70)
        seen(70)
        record._at.clear()  # as in a new process
        second = run(70, 120)
        found = seen(120)
    finally:
        spark.streams.removeListener(record)
        progress._RECORDING.clear()
    assert first.id == second.id and len(second.recentProgress) < 120
    assert sorted(r.batch_id for r in found.collect()) == list(range(120))
    assert found.select("query_id").distinct().count() == 1 and found.agg(F.sum("rows")).first()[0] == 120
    assert len(record.files.names(str(first.id))) <= 12 + 2 * 10

"""Raw files to gold tables on a small lake, compared with plain Python."""

import random
from collections import defaultdict
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from chartloom import medallion, schemas
from chartloom.operators import quality
from chartloom.plans import serving
from chartloom.registry import Lake, available_tables, describe
from chartloom.sinks.staging import staging_path
from chartloom.sources.files import corrupt_counts, load_gold, read_raw, read_table

TRACKS = [f"T{i}" for i in range(30)]
DAYS = [date(2020, 1, 1) + timedelta(d) for d in range(40)]
REGIONS = ["United States", "United Kingdom", "Global"]


@pytest.fixture(scope="module")
def lake(spark):
    rng = random.Random(7)
    lake = Lake(staging_path(spark, "medallion"))
    rows = []
    for day in DAYS:
        for region in REGIONS:
            for chart in ("top200", "viral50"):
                for rank, track in enumerate(rng.sample(TRACKS, 8), 1):
                    text = day.isoformat() if rng.random() < 0.8 else day.strftime("%m/%d/%Y")
                    streams = str(rng.randrange(1000)) if chart == "top200" else None
                    rows.append((f"title {track}", str(rank), text, f"artist {int(track[1:]) % 5}",
                                 f"https://charts.example.com/track/{track}", region, chart, "NEW", streams))
    rows += rows[:50]  # re-scraped
    rows += [("broken", "N/A", "2020-01-01", "x", None, "Global", "top200", "NEW", "")]
    frame = spark.createDataFrame(rows, schemas.CHARTS_RAW_SCHEMA)
    frame.write.option("header", "true").csv(lake.path("raw.charts.csv"))
    features = [
        (t, a, f"title {t}", "album", date(1980 + i, 5, 1), 1, 0, 1, 1, 1, 1, 120.0, 1, 1,
         0.5, (i % 10) / 9, -5.0, 0.1, 0.2, 1.3, 0.3, (i % 7) / 6, 0.5)
        for i, t in enumerate(TRACKS[:28]) for a in (f"artist {i % 5}", "guest")
    ]
    spark.createDataFrame(features, schemas.TRACK_FEATURES_RAW_SCHEMA).write.parquet(lake.path("raw.track_features.parquet"))
    spark.createDataFrame(
        [("us", " United States", "America", 331, 1.0), ("gb", "United Kingdom", " Europe", 67, 1.0)],
        schemas.COUNTRIES_RAW_SCHEMA,
    ).write.option("header", "true").csv(lake.path("raw.countries.csv"))
    expectations = {
        "silver.charts_cleaned": [quality.no_nulls("track_id"), quality.min_rows(1000)],
        "silver.tracks_cleaned": [quality.column_range("instrumentalness", 0.0, 1.0)],
    }
    report = medallion.run(spark, lake, expectations=expectations)
    return lake, rows, report


def test_counts(spark, lake):
    lake, rows, report = lake
    assert report["bronze.charts"]["rows"] == len(rows) and report["bronze.charts"]["corrupt_rows"] == 0
    assert report["silver.charts_cleaned"]["rows"] == len(rows) - 51
    assert report["silver.charts_enriched"]["rows"] == len(rows) - 51
    assert report["silver.tracks_cleaned"] == {**report["silver.tracks_cleaned"], "rows": 28, "track_artist_rows": 56}
    assert corrupt_counts(read_raw(spark, lake, "raw.charts.csv")).first().corrupt_rows == 0
    assert available_tables(spark, lake) == [
        "regional_mood_seasonal", "streak_analysis", "sonic_dna_by_rank_tier", "track_longevity", "global_top_artists"
    ]
    assert describe(spark).where("layer = 'gold'").count() == 9


def test_enriched_rows(spark, lake):
    enriched = read_table(spark, lake[0], "silver.charts_enriched")
    by_region = {r.region: r.continent for r in enriched.select("region", "continent").distinct().collect()}
    assert by_region == {"United States": "America", "United Kingdom": "Europe", "Global": None}
    assert enriched.where("track_id in ('T28', 'T29') and mood_quadrant is not null").count() == 0
    assert {r.artists[0] for r in enriched.where("artists is not null").select("artists").distinct().collect()} == {
        f"artist {i}" for i in range(5)
    }


def test_streaks_against_python(spark, lake):
    enriched = read_table(spark, lake[0], "silver.charts_enriched").where(F.col("rank") == 1)
    held = defaultdict(set)
    for r in enriched.select("track_id", "region", "chart_date").collect():
        held[r.track_id, r.region].add(r.chart_date)
    want = []
    for (track, region), days in held.items():
        start = previous = None
        for day in sorted(days):
            if previous is None or (day - previous).days > 1:
                if start:
                    want.append((track, region, start, previous))
                start = day
            previous = day
        want.append((track, region, start, previous))
    got = [(r.track_id, r.region, r.streak_start, r.streak_end)
           for r in load_gold(spark, lake[0], "streak_analysis").collect()]
    assert sorted(got) == sorted(want)


def test_gold_tables_serve(spark, lake):
    lake = lake[0]
    tiers = load_gold(spark, lake, "sonic_dna_by_rank_tier")
    assert {r.stream_decile: r.track_count for r in tiers.collect()} == {i: 3 for i in range(1, 11)}
    assert [r.stream_decile for r in tiers.collect()] == list(range(1, 11))  # as written
    mood = load_gold(spark, lake, "regional_mood_seasonal")
    shares = mood.groupBy("region", "year", "season").agg(F.sum("mood_share").alias("s")).collect()
    assert all(r.s == pytest.approx(1.0) for r in shares)
    assert serving.season_grid(mood, 2020).count() == 16
    assert serving.season_grid(mood, 1990).agg(F.sum("total_streams")).first()[0] == 0
    assert serving.kpi_year(mood, 2020).first().regions == 3
    assert serving.mood_tiles(mood, 1990).agg(F.sum("share")).first()[0] == 0.0
    board = load_gold(spark, lake, "global_top_artists")
    assert board.where("monthly_rank = 1").count() == 2
    assert serving.top_artist_fingerprint(board, 2020).count() == 1
    life = load_gold(spark, lake, "track_longevity")
    assert serving.decade_cards(life, "energy").count() == 3
    sample = serving.seeded_sample(life, ["track_id", "region"], size=10)
    assert sample.exceptAll(serving.seeded_sample(life.repartition(5), ["track_id", "region"], size=10)).count() == 0
    assert serving.streak_kpis(load_gold(spark, lake, "streak_analysis"), "nowhere").first().longest is None


def test_failed_expectation_stops_the_run(spark, lake):
    with pytest.raises(ValueError, match="min_rows"):
        medallion.run(spark, lake[0], ("bronze",), {"bronze.countries": [quality.min_rows(99)]})


def test_rerun_replaces(spark, lake):
    medallion.run(spark, lake[0], ("gold",))
    assert load_gold(spark, lake[0], "sonic_dna_by_rank_tier").count() == 10


def test_increments(spark, lake):
    lake = lake[0]
    first = medallion.run(spark, lake, ("increment",))["silver.charts_loaded"]["rows"]
    loaded = read_table(spark, lake, "silver.charts_loaded")
    cleaned = read_table(spark, lake, "silver.charts_cleaned")
    key = medallion.cleaning.ENTRY_KEY
    assert first == cleaned.count() and loaded.select(*key).exceptAll(cleaned.select(*key)).count() == 0
    assert medallion.run(spark, lake, ("increment",))["silver.charts_loaded"]["rows"] == 0
    medallion.run(spark, lake, ("bronze", "increment"))  # everything is ingested anew; nothing in it is new
    assert read_table(spark, lake, "silver.charts_loaded").count() == first

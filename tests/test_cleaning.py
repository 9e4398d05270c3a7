"""Cleaning operators, including nulls, ties and malformed values."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from chartloom import schemas
from chartloom.functions import audio, dates, text
from chartloom.operators import cleaning


def one(df, column):
    return df.first()[column]


@pytest.mark.parametrize("url, expected", [
    ("https://charts.example.com/track/6mIabcEjh6Y6lroV2Kg", "6mIabcEjh6Y6lroV2Kg"),
    (None, None),
    ("https://charts.example.com/artist/abc", None),
    ("https://charts.example.com/track/abc?x=1", None),
])
def test_track_id(spark, url, expected):
    df = spark.createDataFrame([(url,)], "url string")
    assert one(cleaning.extract_track_id(df), "track_id") == expected


@pytest.mark.parametrize("value, expected", [
    ("2020-06-15", date(2020, 6, 15)),
    ("06/15/2020", date(2020, 6, 15)),
    ("15-06-2020", date(2020, 6, 15)),
    ("not-a-date", None),
    ("2020-13-01", None),
    ("", None),
    (None, None),
])
def test_date_formats(spark, value, expected):
    df = spark.createDataFrame([(value,)], "date string")
    assert one(cleaning.cast_date_with_fallback(df), "chart_date") == expected


def test_numbers_that_are_not_numbers_become_null(spark):
    df = spark.createDataFrame([("7", "12"), ("N/A", ""), (None, "1e")], "rank string, streams string")
    rows = [tuple(r) for r in cleaning.cast_numeric_columns(df).collect()]
    assert rows == [(7, 12), (None, None), (None, None)]


def entries(spark, rows):
    return spark.createDataFrame(
        rows, "track_id string, chart_date date, rank int, region string, chart string, ingestion_ts timestamp"
    )


def test_corrupt_rows_are_dropped_and_counted(spark):
    d, t = date(2020, 1, 1), datetime(2020, 1, 2)
    df = entries(spark, [
        ("abc", d, 1, "us", "top200", t), (None, d, 2, "us", "top200", t), (None, None, None, "us", "top200", t),
    ])
    assert [r.track_id for r in cleaning.filter_corrupt_rows(df).collect()] == ["abc"]
    stats = cleaning.corrupt_stats(df).first()
    assert (stats.total, stats.null_track_id, stats.null_chart_date, stats.null_rank, stats.dropped) == (3, 2, 1, 1, 2)
    assert stats.dropped_pct == pytest.approx(200 / 3)
    empty = cleaning.corrupt_stats(df.limit(0)).first()
    assert (empty.total, empty.dropped_pct) == (0, None)


def test_dedup_keeps_the_latest(spark):
    d = date(2020, 1, 1)
    df = entries(spark, [
        ("old", d, 1, "us", "top200", datetime(2020, 1, 2)), ("new", d, 1, "us", "top200", datetime(2020, 1, 3)),
        ("other", d, 2, "us", "top200", datetime(2020, 1, 2)),
    ])
    kept = {r.track_id for r in cleaning.deduplicate_chart_entries(df).collect()}
    assert kept == {"new", "other"}


def test_dedup_tie_and_key_choice(spark):
    d, t = date(2020, 1, 1), datetime(2020, 1, 2)
    rows = [("b", d, 1, "us", "viral50", t), ("a", d, 1, "us", "top200", t), ("c", d, 1, "us", "top200", t)]
    for order in (rows, rows[::-1]):
        df = entries(spark, order).repartition(3)
        wide = {r.track_id for r in cleaning.deduplicate_chart_entries(df).collect()}
        narrow = {r.track_id for r in cleaning.deduplicate_chart_entries(df, cleaning.NARROW_ENTRY_KEY).collect()}
        assert wide == {"a", "b"} and narrow == {"a"}


def raw(spark, rows):
    return spark.createDataFrame(rows, schemas.CHARTS_RAW_SCHEMA).withColumn("ingestion_ts", F.lit(datetime(2024, 1, 1)))


def test_chain_types_and_columns(spark):
    url = "https://charts.example.com/track/T1"
    df = raw(spark, [
        ("t", "1", "06/15/2020", "a", url, "us", "top200", "x", "10"),
        ("t", "N/A", "2020-06-15", "a", url, "us", "top200", "x", "10"),
        ("t", "2", "bad", "a", url, "us", "top200", "x", ""),
    ])
    out = cleaning.transform_charts(df, week=True)
    assert out.count() == 1
    row = out.first()
    assert (row["rank"], row.streams, row.year, row.month, row.week, row.track_id) == (1, 10, 2020, 6, 25, "T1")
    assert "date" not in out.columns and schemas.CORRUPT_COLUMN not in out.columns


def test_clamp(spark):
    df = spark.createDataFrame([(-0.1,), (0.4,), (1.2,), (None,), (float("nan"),)], "v double")
    values = [r[0] for r in df.select(audio.clamp("v")).collect()]
    assert values == [0.0, 0.4, 1.0, None, 1.0]
    assert [r[0] for r in df.select(audio.clamp("v", null_as_low=True)).collect()][3] == 0.0


@pytest.mark.parametrize("valence, energy, label, label_null_as_low", [
    (0.6, 0.6, "Happy/Energetic", "Happy/Energetic"),
    (0.6, 0.5, "Calm/Peaceful", "Calm/Peaceful"),
    (0.5, 0.6, "Angry/Tense", "Angry/Tense"),
    (0.5, 0.5, "Sad/Depressing", "Sad/Depressing"),
    (None, 0.9, None, "Sad/Depressing"),
    (0.9, None, None, "Sad/Depressing"),
    (0.2, None, None, "Sad/Depressing"),
])
def test_mood(spark, valence, energy, label, label_null_as_low):
    df = spark.createDataFrame([(valence, energy)], "valence double, energy double")
    assert one(cleaning.assign_mood_quadrant(df), "mood_quadrant") == label
    assert one(cleaning.assign_mood_quadrant(df, null_as_low=True), "mood_quadrant") == label_null_as_low


def test_seasons_and_decades(spark):
    months = spark.range(1, 13).select(F.col("id").cast("int").alias("month"))
    got = [r.season for r in cleaning.derive_season(months).orderBy("month").collect()]
    assert got == ["Winter"] * 2 + ["Spring"] * 3 + ["Summer"] * 3 + ["Autumn"] * 3 + ["Winter"]
    days = spark.createDataFrame([(date(1999, 12, 31),), (date(2000, 1, 1),), (None,)], "d date")
    assert [r[0] for r in days.select(dates.decade_of("d")).collect()] == [1990, 2000, None]


def test_track_view(spark):
    df = spark.createDataFrame(
        [("t1", "zed", 1), ("t1", "amy", 2), ("t1", "amy", 2), ("t2", None, 3), ("t3", None, 4), ("t3", "bob", 5)],
        "track_id string, artist_name string, track_popularity int",
    )
    rows = {r.track_id: (r.track_popularity, r.artists) for r in cleaning.build_track_level_view(df).collect()}
    assert rows == {"t1": (2, ["amy", "zed"]), "t2": (3, []), "t3": (5, ["bob"])}


def test_trim_and_null_codes(spark):
    df = spark.createDataFrame(
        [(" gb ", "United Kingdom", " Europe", 1, 1.0), (None, "x", "y", 1, 1.0)], schemas.COUNTRIES_RAW_SCHEMA.simpleString()
    )
    rows = cleaning.clean_countries(df).collect()
    assert [(r.region_code, r.continent) for r in rows] == [("gb", "Europe")]


def test_manual_entries(spark):
    df = spark.createDataFrame(
        [("Title", 3, "2024-01-01", "Artist", "us", "top200", 100), ("T2", 1, "2024-01-02", "A2", "gb", "viral50", None)],
        "title string, rank int, date string, artist string, region string, chart string, streams int",
    )
    first, second = cleaning.manual_entries(df).collect()
    assert first.url.startswith(text.TRACK_URL_PREFIX) and len(first.url) == len(text.TRACK_URL_PREFIX) + 22
    assert (first["rank"], first.streams, first.trend) == ("3", "100", "SAME_POSITION")
    assert second.streams == ""
    assert cleaning.extract_track_id(cleaning.manual_entries(df)).where("track_id is null").count() == 0


def test_bulk_entries(spark):
    good = '{"artist":"a","title":"t","region":"us","chart":"top200","rank":1,"date":"2024-01-01"}'
    df = spark.createDataFrame([
        (1, f"[{good}, {{\"artist\":\"a\"}}, 5]"), (2, "{}"), (3, "not json"), (4, None), (5, f"[{good}]"),
    ], "id int, payload string")
    out = cleaning.parse_bulk_entries(df)
    errors = {(r.id, r.entry): r.error for r in out.collect()}
    assert errors == {
        (1, 1): None, (1, 2): "missing: chart, date, rank, region, title", (1, 3): "entry is not an object",
        (2, None): "payload is not a JSON array", (3, None): "payload is not a JSON array",
        (4, None): "payload is not a JSON array", (5, 1): None,
    }
    valid, rejected = cleaning.split_valid(out)
    assert valid.count() == 2 and rejected.count() == 5
    assert cleaning.manual_entries(valid).where("rank = '1'").count() == 2


def test_credits(spark):
    df = spark.createDataFrame([("A feat. B, C & D",), ("Solo",), ("Swift ft. X",)], "artist string")
    rows = [(r.artist, r.credited) for r in cleaning.credited_artists(df).collect()]
    assert rows == [
        ("A feat. B, C & D", "A"), ("A feat. B, C & D", "B"), ("A feat. B, C & D", "C"), ("A feat. B, C & D", "D"),
        ("Solo", "Solo"), ("Swift ft. X", "Swift"), ("Swift ft. X", "X"),
    ]


def test_empty_inputs(spark):
    empty = raw(spark, [])
    assert cleaning.transform_charts(empty).count() == 0
    tracks = spark.createDataFrame([], schemas.TRACK_FEATURES_RAW_SCHEMA)
    assert cleaning.build_track_level_view(cleaning.clean_features(tracks)).count() == 0


def test_schema_contracts():
    charts = {f.name: f.dataType.simpleString() for f in schemas.CHARTS_RAW_SCHEMA.fields}
    assert {"title", "rank", "date", "artist", "url", "region", "chart", "streams"} <= set(charts)
    assert charts["rank"] == "string"
    assert schemas.TRACK_FEATURES_RAW_SCHEMA["track_id"].nullable is False
    assert len(schemas.COUNTRIES_RAW_SCHEMA.fields) == 5
    assert {"valence", "energy"} <= set(schemas.BOUNDED_AUDIO_FEATURES)
    before = len(schemas.CHARTS_RAW_SCHEMA.fields)
    assert len(schemas.with_corrupt_column(schemas.CHARTS_RAW_SCHEMA).fields) == before + 1
    assert len(schemas.CHARTS_RAW_SCHEMA.fields) == before


def test_decimal_text_is_cut_to_whole_numbers(spark):
    from chartloom.functions import numbers

    text = ["1.0", "253019.0", " 7.9 ", "-2.5", "+3.", "x", "1.2.3", "1e3", "", None, "99999999999.0"]
    rows = spark.createDataFrame([(t,) for t in text], "t string").select(numbers.whole_number("t", "int").alias("n")).collect()
    assert [r.n for r in rows] == [1, 253019, 7, -2, 3] + [None] * 6

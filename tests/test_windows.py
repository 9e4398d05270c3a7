"""Streaks, lags, rolling frames, tiles, medians and shares against plain Python or Spark's own windows."""

import random
import re
import statistics
from datetime import date, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from chartloom import bindings
from chartloom.operators import enrich, positions, windows
from chartloom.plans import artists, longevity, mood, streaks, tiers
from chartloom.registered.marts import longevity_mart

DAY = date(2020, 1, 1)


def chart(spark, rows):
    """rows: (track, region, day offset, rank, streams)"""
    data = [(t, f"title {t}", f"artist {t}", g, DAY + timedelta(d), r, s, "top200") for t, g, d, r, s in rows]
    return spark.createDataFrame(
        data, "track_id string, title string, artist string, region string, chart_date date, rank int,"
        " streams bigint, chart string",
    )


def lengths(df):
    return sorted(r.streak_days for r in df.collect())


@pytest.mark.parametrize("days, expected", [
    ([0, 1, 2, 3, 4], [5]), ([0, 1, 2, 4, 5, 6], [3, 3]), ([0], [1]), ([], []),
])
def test_streaks(spark, days, expected):
    df = chart(spark, [("t", "us", d, 1, 10) for d in days])
    assert lengths(streaks.build_streak_analysis(df)) == expected
    assert lengths(streaks.streaks_by_gap(df)) == expected


def test_streak_regions_ranks_and_repeated_days(spark):
    rows = [("t", g, d, 1, 5) for g in ("us", "gb") for d in (0, 1)]
    rows += [("t", "us", 2, 2, 5), ("t", "us", 0, 1, 7)]
    df = chart(spark, rows)
    out = {r.region: (r.streak_days, r.streak_total_streams) for r in streaks.build_streak_analysis(df).collect()}
    assert out == {"us": (2, 17), "gb": (2, 10)}


def test_retitled_track_is_one_streak_unless_asked(spark):
    df = chart(spark, [("t", "us", d, 1, 5) for d in range(4)]).withColumn(
        "title", F.when(F.col("chart_date") < DAY + timedelta(2), "old").otherwise("new")
    )
    merged = streaks.build_streak_analysis(df).collect()
    assert [(r.title, r.streak_days) for r in merged] == [("new", 4)]
    split = streaks.build_streak_analysis(df, keys=["track_id", "region", "title", "artist"])
    assert lengths(split) == [2, 2]


@pytest.mark.parametrize("entries, compared", [(6, 0), (7, 0), (8, 1)])
def test_trajectory_needs_seven_earlier_entries(spark, entries, compared):
    df = chart(spark, [("t", "us", 2 * i, 10 - i, 1) for i in range(entries)])
    row = tiers.rank_trajectory(df).first()
    assert row.compared_entries == compared
    assert row.avg_rank_delta_7d == (None if not compared else -7.0)


def test_trajectory_by_exact_days(spark):
    df = chart(spark, [("t", "us", 0, 9, 1), ("t", "us", 7, 4, 1), ("t", "us", 8, 3, 1)])
    row = tiers.rank_trajectory(df, exact_days=True).first()
    assert (row.compared_entries, row.avg_rank_delta_7d) == (1, -5.0)


def test_rolling_90_days(spark):
    df = chart(spark, [("t", "us", 0, 1, 1), ("t", "gb", 0, 1, 10), ("t", "us", 90, 1, 100), ("t", "us", 91, 1, 1000)])
    rows = {r.chart_date: r.rolling_90d_streams for r in artists.rolling_streams(artists.artist_days(df)).collect()}
    # the first day has two entries, day 90 still sees it, day 91 does not
    assert rows == {DAY: 11, DAY + timedelta(90): 111, DAY + timedelta(91): 1100}


def test_months_match_the_row_window(spark):
    rng = random.Random(1)
    rows = [(f"t{rng.randrange(6)}", rng.choice(["us", "gb"]), rng.randrange(200), 1, rng.choice([None, 1, 5, 9]))
            for _ in range(400)]
    df = chart(spark, rows).withColumn("artist", F.concat(F.lit("a"), F.substring("track_id", 2, 1).cast("int") % 2))
    w = Window.partitionBy("artist").orderBy(F.unix_date("chart_date")).rangeBetween(-90, 0)
    plain = (
        df.withColumn("rolling", F.sum("streams").over(w))
        .groupBy("artist", F.trunc("chart_date", "month").alias("month_start"))
        .agg(F.sum("streams").alias("s"), F.count_distinct("track_id").alias("d"), F.count("*").alias("n"),
             F.avg("rolling").alias("r"))
    )
    want = {(r.artist, r.month_start): (r.s, r.d, r.n, round(r.r, 6)) for r in plain.collect()}
    got = {
        (r.artist, r.month_start): (r.monthly_streams, r.distinct_tracks, r.chart_entries,
                                    round(r.avg_rolling_90d_streams, 6))
        for r in artists.artist_months(df).collect()
    }
    assert got == want


def test_leaderboard_ties_share_a_rank(spark):
    df = spark.createDataFrame(
        [("a", DAY, 5), ("b", DAY, 5), ("c", DAY, 3), ("d", DAY, 1)], "artist string, month_start date, monthly_streams bigint"
    )
    ranks = {r.artist: r.monthly_rank for r in artists.monthly_leaderboard(df, 2).collect()}
    assert ranks == {"a": 1, "b": 1, "c": 2}


@pytest.mark.parametrize("n", [0, 7, 10, 1003])
def test_distributed_ntile_equals_the_window(spark, n):
    df = spark.range(n).select("id", (F.col("id") * 7919 % 37).alias("v"))
    order = [F.col("v").desc(), F.col("id")]
    got = positions.with_ntile(df, 10, order, "tile").collect()
    want = df.withColumn("tile", F.ntile(10).over(Window.orderBy(*order))).collect()
    assert sorted((r.id, r.tile) for r in got) == sorted((r.id, r.tile) for r in want)


def test_positions_are_consecutive(spark):
    df = spark.range(500).select("id", (F.col("id") % 3).alias("v")).repartition(7)
    placed = positions.with_positions(df, [F.col("v"), F.col("id")], total="n").orderBy("v", "id").collect()
    assert [r.position for r in placed] == list(range(1, 501)) and {r.n for r in placed} == {500}


def test_running_total_and_medians_with_a_hot_key(spark):
    rng = random.Random(2)
    rows = [("hot" if i % 3 == 0 else f"k{i % 20}", round(rng.random(), 3)) for i in range(900)]
    rows += [("null", None), ("single", 4.0), ("pair", 1.0), ("pair", 2.0)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(5)
    groups = {}
    for k, v in rows:
        if v is not None:
            groups.setdefault(k, []).append(v)
    got = {r.k: r.median for r in positions.group_medians(df, ["k"], "v").collect()}
    assert got == pytest.approx({k: statistics.median(v) for k, v in groups.items()})

    days = spark.range(1, 301).select((F.col("id") % 2).alias("k"), "id", F.lit(2).alias("n"))
    total = positions.with_running_total(days, ["k"], "id", "n", "upto", "all").collect()
    assert all(r.upto == 2 * ((r.id + 1) // 2) and r["all"] == 300 for r in total)


def test_share_of_zero_and_null_totals(spark):
    df = spark.createDataFrame([("a", 0), ("a", 0), ("b", None), ("c", 1), ("c", 3)], "g string, v bigint")
    rows = sorted((r.g, r.v, r.share) for r in windows.share_of_total(df.na.fill({"g": ""}), "v", ["g"], "share").collect()
                  if r.g == "c")
    assert rows == [("c", 1, 0.25), ("c", 3, 0.75)]
    others = windows.share_of_total(df, "v", ["g"], "share").where("g <> 'c'").collect()
    assert all(r.share is None for r in others)


def test_chart_life(spark):
    df = chart(spark, [("t", "us", 0, 3, 1), ("t", "us", 5, 1, 1), ("t", "us", 9, 1, None), ("t", "us", 12, 4, 2)])
    row = longevity.chart_life(df, ["title", "artist"]).first()
    assert (row.first_chart_date, row.last_chart_date) == (DAY, DAY + timedelta(12))
    assert (row.peak_rank, row.peak_date, row.chart_lifespan_days) == (1, DAY + timedelta(5), 12)
    assert (row.total_chart_days, row.total_streams, row.avg_rank) == (4, 4, 2.25)


def test_life_of_rows_reduced_before_their_joins(spark):
    """Reduced first or enriched first, and with dimensions that repeat a key, the mart is the same."""
    day = F.date_add(F.lit(DAY), (F.col("id") * 7 % 90).cast("int"))
    plays = spark.range(600).select(
        F.concat(F.lit("t"), (F.col("id") % 9).cast("string")).alias("track_id"),
        F.when(F.col("id") % 5 > 0, F.concat(F.lit("c"), (F.col("id") % 4).cast("string"))).alias("region"),
        F.lit("top200").alias("chart"), F.when(F.col("id") % 11 > 0, F.col("id") % 50).alias("rank"),
        day.alias("chart_date"), F.when(F.col("id") % 3 > 0, F.col("id")).alias("streams"),
    )
    titles = spark.createDataFrame([(f"t{i}", f"T{i}", f"A{j}") for i in range(8) for j in range(1 + i % 2)], "track_id string, title string, artist string")
    tracks = spark.createDataFrame([(f"t{i}", 1990 if i < 4 else None) for i in (1, 2, 2, 3, 7)], "track_id string, release_decade int")
    countries = spark.createDataFrame([("c1", "x1", "E"), ("c2", "x2", "E"), ("c2", "x3", "A")], "country_name string, region_code string, continent string")
    before = longevity.chart_life(enrich.enrich_charts(plays.join(titles, "track_id"), tracks, countries))
    reduced = longevity.chart_parts(plays, []).join(titles, "track_id")
    after = longevity.settled_life(enrich.enrich_charts(reduced, tracks, countries))
    assert before.count() > 30 and before.columns == after.columns
    assert before.exceptAll(after).count() == after.exceptAll(before).count() == 0


def test_longevity_mart_groups_by_its_key_alone(spark, tmp_path):
    """Attributes join the reduced rows, and these are not grouped again unless a dimension repeats a key."""
    folder = "/root/testdata/sf0.001"
    mart = longevity_mart(spark, folder)
    executed = mart._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in executed
    keys = re.findall(r"HashAggregate\(keys=\[(track_id.*?)\], ", executed)
    assert keys and all(k.count(",") == 1 for k in keys), keys

    for name in ("nation", "region", "customer", "orders", "lineitem"):
        (tmp_path / f"{name}.parquet").symlink_to(f"{folder}/{name}.parquet")
    parts = spark.read.parquet(f"{folder}/part.parquet")
    again = parts.where("p_partkey < 30").withColumn("p_name", F.lit("zz"))
    parts.union(again).write.parquet(str(tmp_path / "part.parquet"))
    got = longevity_mart(spark, str(tmp_path))
    plain = longevity.build_track_longevity(bindings.enriched(spark, str(tmp_path)), bindings.tracks(spark, str(tmp_path)))
    assert got.count() > mart.count()
    assert got.exceptAll(plain).count() == plain.exceptAll(got).count() == 0
    assert mart.exceptAll(longevity.build_track_longevity(bindings.enriched(spark, folder), bindings.tracks(spark, folder))).count() == 0


def test_chart_life_per_title_keeps_the_span(spark):
    df = chart(spark, [("t", "us", 0, 3, 1), ("t", "us", 9, 1, 1)]).withColumn(
        "title", F.when(F.col("chart_date") == DAY, "old").otherwise("new")
    )
    rows = longevity.chart_life(df, ["title", "artist"], per_title=True).collect()
    assert {(r.title, r.total_chart_days, r.chart_lifespan_days, r.peak_rank) for r in rows} == {
        ("old", 1, 9, 1), ("new", 1, 9, 1)
    }


def test_rolling_average_rank(spark):
    df = chart(spark, [("t", "us", 0, 10, 1), ("t", "us", 6, 4, 1), ("t", "us", 7, 1, 1)])
    got = [r.rolling_avg_rank for r in longevity.rolling_avg_rank(df).orderBy("chart_date").collect()]
    assert got == [10.0, 7.0, 2.5]


def test_correlation_needs_two_rows(spark):
    df = spark.createDataFrame([(0.1, 5), (0.2, 10), (0.3, 15)], "energy double, chart_lifespan_days int")
    assert longevity.feature_correlation(df, ["energy"]).first().correlation == pytest.approx(1.0)
    assert longevity.feature_correlation(df.limit(1), ["energy"]).first().correlation is None


def test_mood_mart_of_empty_and_unknown(spark):
    df = spark.createDataFrame(
        [("us", "NA", 2020, 1, None, 5, "t"), ("us", "NA", 2020, 1, "Angry/Tense", None, "u")],
        "region string, continent string, year int, month int, mood_quadrant string, streams bigint, track_id string",
    )
    rows = {r.mood_quadrant: r.mood_share for r in mood.build_regional_mood_seasonal(df).collect()}
    assert rows == {None: 1.0, "Angry/Tense": None}
    assert mood.build_regional_mood_seasonal(df.limit(0)).count() == 0


def test_collaboration(spark):
    df = spark.createDataFrame(
        [("t1", "a"), ("t1", "b"), ("t1", "c"), ("t2", "a"), ("t2", "b"), ("t3", "a"), ("t3", "a")],
        "track_id string, artist_name string",
    )
    rows = {r.artist_name: (r.tracks, r.shared_tracks, r.co_credits) for r in artists.collaboration_profile(df).collect()}
    assert rows == {"a": (3, 2, 3), "b": (2, 2, 3), "c": (1, 1, 2)}
    partners = {r.partner: r.shared_tracks for r in artists.collaborators_of(df, "a").collect()}
    assert partners == {"b": 2, "c": 1}


def test_peak_before_1970(spark):
    rows = [("t", "r", "a", "b", "c", "d", "top200", 3, 10, "1969-12-31"), ("t", "r", "a", "b", "c", "d", "top200", 5, 10, "1970-01-02")]
    df = spark.createDataFrame(rows, "track_id string, region string, title string, artist string, continent string,"
                               " release_decade string, chart string, rank int, streams bigint, chart_date string")
    life = longevity.chart_life(df.withColumn("chart_date", F.to_date("chart_date"))).first()
    assert str(life.peak_date) == "1969-12-31" and life.peak_rank == 3

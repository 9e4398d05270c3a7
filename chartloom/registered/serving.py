"""Serving queries over the marts, and summaries of run records."""

from pyspark.sql import functions as F

from chartloom import bindings
from chartloom.operators.cleaning import transform_charts
from chartloom.plans import runmetrics, serving
from chartloom.registered.catalog import query
from chartloom.registered.expected import expect
from chartloom.registered.marts import artist_mart, longevity_mart, mood_mart, streak_mart, tier_mart
from chartloom.schemas import BOUNDED_AUDIO_FEATURES

YEAR, SEASON = 1998, "Summer"
REGION_OF_DAYS, NATION = "click", "NATION_7"
MOODS = "('Happy/Energetic', 'Calm/Peaceful', 'Angry/Tense', 'Sad/Depressing')"
MOOD_GRID = "(VALUES ('Happy/Energetic'), ('Calm/Peaceful'), ('Angry/Tense'), ('Sad/Depressing')) m(mood_quadrant)"


@query("kpi_year", expect("mood_mart", (
    f"SELECT (SELECT CAST(sum(total_streams) AS BIGINT) FROM mood_mart WHERE year = {YEAR}) AS total_streams,"
    f" (SELECT region FROM mood_mart WHERE year = {YEAR} GROUP BY region ORDER BY sum(total_streams) DESC NULLS LAST, region"
    f" LIMIT 1) AS top_region, (SELECT mood_quadrant FROM mood_mart WHERE year = {YEAR} AND mood_quadrant IS NOT NULL"
    " GROUP BY mood_quadrant ORDER BY sum(total_streams) DESC NULLS LAST, mood_quadrant LIMIT 1) AS top_mood,"
    f" (SELECT count(DISTINCT region) FROM mood_mart WHERE year = {YEAR}) AS regions"
)))
def kpi_year(spark, folder):
    return serving.kpi_year(mood_mart(spark, folder), YEAR)


@query("dominant_mood", expect("mood_mart", (
    "SELECT region, mood_quadrant, round(mood_share, 6) AS mood_share, total_streams FROM mood_mart"
    f" WHERE year = {YEAR} AND season = '{SEASON}' AND mood_quadrant IN {MOODS}"
    " QUALIFY row_number() OVER (PARTITION BY region ORDER BY mood_share DESC NULLS LAST, mood_quadrant) = 1"
)))
def dominant_mood(spark, folder):
    return serving.dominant_mood(mood_mart(spark, folder), YEAR, SEASON)


@query("season_top_moods", expect("mood_mart", (
    "SELECT region, mood_quadrant, round(mood_share, 6) AS mood_share, total_streams FROM mood_mart"
    f" WHERE year = {YEAR} AND season = '{SEASON}'"
    " ORDER BY mood_share DESC NULLS LAST, region, mood_quadrant NULLS FIRST LIMIT 10"
)))
def season_top_moods(spark, folder):
    return serving.top_moods_of_season(mood_mart(spark, folder), YEAR, SEASON)


@query("mood_totals", expect("mood_mart", (
    "SELECT mood_quadrant, CAST(sum(total_streams) AS BIGINT) AS total_streams FROM mood_mart"
    f" WHERE year = {YEAR} AND mood_quadrant IS NOT NULL GROUP BY mood_quadrant"
)))
def mood_totals(spark, folder):
    return serving.mood_totals(mood_mart(spark, folder), YEAR)


@query("season_grid", expect("mood_mart", (
    "SELECT s.season, m.mood_quadrant, CAST(coalesce(sum(total_streams), 0) AS BIGINT) AS total_streams FROM"
    f" (VALUES ('Winter'), ('Spring'), ('Summer'), ('Autumn')) s(season) CROSS JOIN {MOOD_GRID}"
    f" LEFT JOIN (SELECT * FROM mood_mart WHERE year = {YEAR}) x ON x.season = s.season"
    " AND x.mood_quadrant = m.mood_quadrant GROUP BY s.season, m.mood_quadrant"
)))
def season_grid(spark, folder):
    return serving.season_grid(mood_mart(spark, folder), YEAR)


@query("mood_tiles", expect("mood_mart", (
    "SELECT m.mood_quadrant, round(CAST(coalesce(sum(x.total_streams), 0) AS DOUBLE) /"
    f" (SELECT sum(total_streams) FROM mood_mart WHERE year = {YEAR}), 6) AS share, count(DISTINCT x.region) AS regions"
    f" FROM {MOOD_GRID} LEFT JOIN (SELECT * FROM mood_mart WHERE year = {YEAR}) x"
    " ON x.mood_quadrant = m.mood_quadrant GROUP BY m.mood_quadrant"
)))
def mood_tiles(spark, folder):
    return serving.mood_tiles(mood_mart(spark, folder), YEAR)


_LONGEST = "ORDER BY streak_days DESC, streak_start, track_id, region"


def _streak_kpis(where: str) -> str:
    return expect("streak_mart", (
        f"SELECT max(streak_days) AS longest, (SELECT substr(title, 1, 28) FROM streak_mart {where} {_LONGEST} LIMIT 1)"
        f" AS longest_title, count(*) AS streaks, round(avg(streak_days), 6) AS mean_days FROM streak_mart {where}"
    ))


@query("streak_kpis", _streak_kpis(""))
def streak_kpis(spark, folder):
    return serving.streak_kpis(streak_mart(spark, folder))


@query("streak_kpis_region", _streak_kpis(f"WHERE region = '{REGION_OF_DAYS}'"))
def streak_kpis_region(spark, folder):
    return serving.streak_kpis(streak_mart(spark, folder), REGION_OF_DAYS)


@query("region_list", expect("streak_mart", "SELECT DISTINCT region FROM streak_mart WHERE region IS NOT NULL"))
def region_list(spark, folder):
    return serving.region_list(streak_mart(spark, folder))


def _top_streaks(where: str) -> str:
    return expect("streak_mart", (
        "SELECT substr(title, 1, 32) || ' · ' || substr(artist, 1, 18) AS label, title, artist, region,"
        " CAST(streak_start AS VARCHAR) AS streak_start, CAST(streak_end AS VARCHAR) AS streak_end, streak_days FROM"
        f" (SELECT * FROM streak_mart {where} {_LONGEST} LIMIT 20)"
    ))


@query("top_streaks", _top_streaks(""))
def top_streaks(spark, folder):
    return serving.top_streaks(streak_mart(spark, folder))


@query("top_streaks_region", _top_streaks(f"WHERE region = '{REGION_OF_DAYS}'"))
def top_streaks_region(spark, folder):
    return serving.top_streaks(streak_mart(spark, folder), REGION_OF_DAYS)


@query("longest_runs", expect("longevity_mart", (
    "SELECT track_id, title, artist, CAST(chart_lifespan_days AS BIGINT) AS chart_lifespan_days,"
    " CAST(peak_rank AS BIGINT) AS peak_rank, round(valence, 6) AS valence, round(energy, 6) AS energy"
    f" FROM longevity_mart WHERE region = '{NATION}' ORDER BY chart_lifespan_days DESC, track_id LIMIT 10"
)))
def longest_runs(spark, folder):
    return serving.longest_runs(longevity_mart(spark, folder), NATION)


@query("decile_kpis", expect("tier_mart", (
    "SELECT round(max(avg_chart_days) FILTER (stream_decile = 1), 6) AS hit_chart_days,"
    " round(max(avg_chart_days) FILTER (stream_decile = 10), 6) AS tail_chart_days,"
    " round(max(avg_rank_delta_7d) FILTER (stream_decile = 3), 6) AS rank_delta_7d FROM tier_mart"
)))
def decile_kpis(spark, folder):
    return serving.decile_kpis(tier_mart(spark, folder), 3)


@query("decile_compare", expect("tier_mart", " UNION ALL ".join(
    f"SELECT 'Decile ' || stream_decile AS tier, '{f}' AS feature, round(mean_{f}, 6) AS value"
    " FROM tier_mart WHERE stream_decile IN (1, 10)"
    for f in BOUNDED_AUDIO_FEATURES
)))
def decile_compare(spark, folder):
    return serving.decile_compare(tier_mart(spark, folder), 1, 10)


@query("decile_gradient", expect("tier_mart", (
    "SELECT CAST(stream_decile AS BIGINT) AS stream_decile, round(mean_valence, 6) AS mean, round(std_valence, 6) AS std"
    " FROM tier_mart"
)))
def decile_gradient(spark, folder):
    return serving.decile_gradient(tier_mart(spark, folder), "valence")


_KNOWN = "WHERE energy IS NOT NULL AND chart_lifespan_days IS NOT NULL AND release_decade IS NOT NULL"


@query("decade_means", expect("longevity_mart", (
    "SELECT CAST(release_decade AS BIGINT) AS release_decade, round(avg(energy), 6) AS mean_val"
    f" FROM longevity_mart {_KNOWN} GROUP BY release_decade"
)))
def decade_means(spark, folder):
    return serving.decade_means(longevity_mart(spark, folder), "energy")


@query("decade_median_life", expect("longevity_mart", (
    "SELECT CAST(release_decade AS BIGINT) AS release_decade, median(chart_lifespan_days) AS median_life"
    f" FROM longevity_mart {_KNOWN} GROUP BY release_decade"
)))
def decade_median_life(spark, folder):
    return serving.decade_median_life(longevity_mart(spark, folder), "energy")


@query("decade_approx_life", expect("longevity_mart", (
    "SELECT CAST(release_decade AS BIGINT) AS release_decade,"
    " CAST(quantile_disc(chart_lifespan_days, 0.5) AS BIGINT) AS median_life FROM longevity_mart"
    " WHERE release_decade IS NOT NULL GROUP BY release_decade"
)))
def decade_approx_life(spark, folder):
    return serving.decade_approx_life(longevity_mart(spark, folder))


@query("seeded_sample", expect("longevity_mart", (
    "SELECT track_id, region, CAST(release_decade AS BIGINT) AS release_decade, round(energy, 6) AS energy,"
    " CAST(chart_lifespan_days AS BIGINT) AS chart_lifespan_days FROM longevity_mart"
    " WHERE energy IS NOT NULL AND chart_lifespan_days IS NOT NULL"
    " ORDER BY md5('42|' || track_id || '|' || region), track_id, region LIMIT 4000"
)))
def seeded_sample(spark, folder):
    rows = serving.known_life(longevity_mart(spark, folder), "energy")
    return serving.seeded_sample(rows, ["track_id", "region"]).select(
        "track_id", "region", "release_decade", "energy", "chart_lifespan_days"
    )


@query("decade_cards", expect("longevity_mart", (
    "SELECT CAST(release_decade AS BIGINT) AS release_decade, round(avg(energy), 6) AS mean_val,"
    " median(chart_lifespan_days) AS median_life, count(DISTINCT track_id) AS tracks,"
    " string_agg(CAST(CAST(round(energy * 100) AS BIGINT) AS VARCHAR), '|' ORDER BY pos) FILTER (pos <= 30) AS series FROM"
    " (SELECT *, row_number() OVER (PARTITION BY release_decade ORDER BY chart_lifespan_days, track_id, region) AS pos"
    f" FROM longevity_mart {_KNOWN}) GROUP BY release_decade"
)))
def decade_cards(spark, folder):
    cards = serving.decade_cards(longevity_mart(spark, folder), "energy")
    percent = F.transform("series", lambda v: F.round(v * 100).cast("bigint").cast("string"))
    return cards.withColumn("series", F.array_join(percent, "|"))


_YEAR_ROWS = f"FROM artist_mart WHERE month_start >= DATE '{YEAR}-01-01' AND month_start < DATE '{YEAR + 1}-01-01'"
_LEADERS = (
    f"SELECT artist, CAST(sum(monthly_streams) AS BIGINT) AS streams {_YEAR_ROWS} {{extra}} GROUP BY artist"
    " ORDER BY streams DESC NULLS LAST, artist LIMIT {k}"
)


@query("artist_options", expect("artist_mart", f"SELECT artist FROM ({_LEADERS.format(extra='', k=60)})"))
def artist_options(spark, folder):
    return serving.artist_options(artist_mart(spark, folder), YEAR)


@query("top_artists_year", expect("artist_mart", _LEADERS.format(extra="", k=20)))
def top_artists_year(spark, folder):
    return serving.top_artists_year(artist_mart(spark, folder), YEAR)


@query("top_artists_year_leaders", expect("artist_mart", _LEADERS.format(extra="AND monthly_rank <= 10", k=10)))
def top_artists_year_leaders(spark, folder):
    return serving.top_artists_year(artist_mart(spark, folder), YEAR, 10, max_rank=10)


@query("top_artist_fingerprint", expect("artist_mart", (
    "SELECT artist, CAST(sum(monthly_streams) AS BIGINT) AS streams, "
    + ", ".join(f"round(coalesce(avg(avg_{d}), 0.0), 6) AS {d}" for d in serving.FINGERPRINT)
    + f" {_YEAR_ROWS} AND artist IN (SELECT artist FROM ({_LEADERS.format(extra='', k=1)})) GROUP BY artist"
)))
def top_artist_fingerprint(spark, folder):
    return serving.top_artist_fingerprint(artist_mart(spark, folder), YEAR)


@query("artist_series", expect("artist_mart", (
    "SELECT artist, CAST(month_start AS VARCHAR) AS month_start,"
    " round(avg_rolling_90d_streams, 6) AS avg_rolling_90d_streams FROM artist_mart"
    " WHERE artist IN ('Brand#1', 'Brand#17')"
)))
def artist_series(spark, folder):
    return serving.artist_series(artist_mart(spark, folder), ["Brand#1", "Brand#17"])


@query("recent_rows", expect("cleaned", (
    "SELECT strftime(ingestion_ts, '%Y-%m-%d %H:%M:%S') AS ingestion_ts, artist, title, region, chart,"
    " '#' || \"rank\" AS \"rank\", coalesce(format('{:,}', streams), '—') AS streams,"
    " CAST(chart_date AS VARCHAR) AS chart_date FROM cleaned"
    ' ORDER BY cleaned.ingestion_ts DESC NULLS LAST, chart_date, region, chart, cleaned."rank", artist, title LIMIT 20'
)))
def recent_rows(spark, folder):
    return serving.recent_rows(transform_charts(bindings.feed(spark, folder).drop("event_id")))


@query("track_mood_counts", expect("tracks", (
    "SELECT mood_quadrant, count(*) AS tracks FROM tracks GROUP BY mood_quadrant"
)))
def track_mood_counts(spark, folder):
    return serving.track_mood_counts(bindings.tracks(spark, folder))


@query("batch_summary", expect("batches", (
    "SELECT count(*) AS batches, CAST(sum(rows) AS BIGINT) AS total_rows, round(avg(rows), 1) AS mean_rows,"
    " round(avg(processing_ms), 1) AS mean_ms, round(max(processing_ms), 1) AS max_ms,"
    " round(avg(throughput_rows_per_sec), 1) AS mean_throughput,"
    " round(max(throughput_rows_per_sec), 1) AS peak_throughput FROM batches"
)))
def batch_summary(spark, folder):
    return runmetrics.batch_summary(bindings.batch_records(spark, folder))


@query("cumulative_rows", expect("batches", (
    "SELECT batch_id, rows, CAST(sum(rows) OVER (ORDER BY batch_id) AS BIGINT) AS cumulative_rows FROM batches"
)))
def cumulative_rows(spark, folder):
    return runmetrics.cumulative_rows(bindings.batch_records(spark, folder))


@query("stage_pivot", expect("stages", (
    "SELECT label, round(avg(wall_sec) FILTER (aqe), 6) AS aqe_on, round(avg(wall_sec) FILTER (NOT aqe), 6) AS aqe_off"
    " FROM stages GROUP BY label"
)))
def stage_pivot(spark, folder):
    return runmetrics.stage_pivot(bindings.stage_records(spark, folder))


@query("stage_summary", expect("stages", (
    "SELECT label, aqe, round(avg(wall_sec), 1) AS mean, round(min(wall_sec), 1) AS min,"
    " round(max(wall_sec), 1) AS max, count(*) AS runs FROM stages GROUP BY label, aqe"
)))
def stage_summary(spark, folder):
    return runmetrics.stage_summary(bindings.stage_records(spark, folder))


@query("setting_gain", expect("stages", (
    "SELECT label, round(on_sec, 6) AS aqe_on, round(off_sec, 6) AS aqe_off,"
    " round((off_sec - on_sec) * 100 / off_sec, 6) AS gain_pct FROM (SELECT label,"
    " avg(wall_sec) FILTER (aqe) AS on_sec, avg(wall_sec) FILTER (NOT aqe) AS off_sec FROM stages GROUP BY label)"
)))
def setting_gain(spark, folder):
    return runmetrics.setting_gain(bindings.stage_records(spark, folder))


@query("setting_total", expect("stages", (
    "SELECT aqe, round(CAST(sum(CAST(wall_sec AS DECIMAL(18, 2))) AS DOUBLE), 6) AS total_sec FROM stages GROUP BY aqe"
)))
def setting_total(spark, folder):
    return runmetrics.setting_total(bindings.stage_records(spark, folder))

"""Building blocks of the expected-result SQL: the derived tables and marts as CTEs."""

from chartloom.bindings import COUNTRY_COLUMNS, FEATURE_COLUMNS, FEED_COLUMNS
from chartloom.schemas import BOUNDED_AUDIO_FEATURES, PROFILE_FEATURES


def _columns(columns: dict[str, str]) -> str:
    return ", ".join(f'{expression} AS "{name}"' for name, expression in columns.items())


_CLAMPED = ", ".join(
    f"CASE WHEN {f} IS NOT NULL THEN least(greatest({f}, 0.0), 1.0) END AS {f}" for f in BOUNDED_AUDIO_FEATURES
)
_MOOD = (
    "CASE WHEN valence IS NULL OR energy IS NULL THEN NULL"
    " WHEN valence > 0.5 AND energy > 0.5 THEN 'Happy/Energetic'"
    " WHEN valence > 0.5 THEN 'Calm/Peaceful'"
    " WHEN energy > 0.5 THEN 'Angry/Tense'"
    " ELSE 'Sad/Depressing' END"
)
SEASON = (
    "CASE WHEN month IN (12, 1, 2) THEN 'Winter' WHEN month IN (3, 4, 5) THEN 'Spring'"
    " WHEN month IN (6, 7, 8) THEN 'Summer' ELSE 'Autumn' END"
)
PARSED_DATE = (
    "CAST(coalesce(try_strptime(date, '%Y-%m-%d'), try_strptime(date, '%m/%d/%Y'),"
    " try_strptime(date, '%d-%m-%Y')) AS DATE)"
)
TRACK_ID = "nullif(regexp_extract(url, 'track/([A-Za-z0-9]+)$', 1), '')"


def dedup_order(*columns: str) -> str:
    return ", ".join(f'"{c}" ASC NULLS LAST' for c in columns)


# name -> (tables it builds on, body)
_CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "keyed": ((), (
        "SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k,"
        " CAST(CAST(ts AS DATE) AS STRING) AS iso FROM events"
    )),
    "feed": (("keyed",), (
        f"SELECT event_id, ts AS ingestion_ts, {_columns(FEED_COLUMNS)} FROM keyed"
    )),
    "typed": (("feed",), (
        f"SELECT event_id, ingestion_ts, title, artist, url, region, chart, trend, {TRACK_ID} AS track_id,"
        f" {PARSED_DATE} AS chart_date,"
        ' TRY_CAST("rank" AS INTEGER) AS "rank", TRY_CAST(streams AS BIGINT) AS streams FROM feed'
    )),
    "kept": (("typed",), (
        'SELECT * FROM typed WHERE track_id IS NOT NULL AND chart_date IS NOT NULL AND "rank" IS NOT NULL'
    )),
    "cleaned": (("kept",), (
        "SELECT * EXCLUDE (event_id), year(chart_date) AS year, month(chart_date) AS month FROM kept"
        ' QUALIFY row_number() OVER (PARTITION BY chart_date, region, chart, "rank"'
        " ORDER BY ingestion_ts DESC NULLS LAST,"
        f' {dedup_order("artist", "streams", "title", "track_id", "trend", "url")}) = 1'
    )),
    # the feed comes in three batches of consecutive days; the last day of one is the first of the next
    "feed_batches": ((), (
        "SELECT CAST(b AS BIGINT) AS batch_id, first_day + CAST(b * n_days // 3 AS INTEGER) AS first_of,"
        " first_day + CAST((b + 1) * n_days // 3 AS INTEGER) AS last_of FROM (SELECT min(CAST(ts AS DATE)) AS first_day,"
        " date_diff('day', min(CAST(ts AS DATE)), max(CAST(ts AS DATE))) + 1 AS n_days FROM events), range(3) t(b)"
    )),
    # a day's rows arrive together, with one arrival time in each batch; messages cut in the middle are lost
    "batch_cleaned": (("kept",), (
        "SELECT * EXCLUDE (ingestion_ts, event_id), year(chart_date) AS year, month(chart_date) AS month,"
        " CAST(date_trunc('month', chart_date) AS DATE) AS month_start FROM kept WHERE event_id % 37 <> 9"
        ' QUALIFY row_number() OVER (PARTITION BY chart_date, region, chart, "rank"'
        f' ORDER BY {dedup_order("artist", "streams", "title", "track_id", "trend", "url")}) = 1'
    )),
    "stream_silver": (("batch_cleaned",), (
        "SELECT * FROM batch_cleaned QUALIFY row_number() OVER (PARTITION BY track_id, chart_date, region ORDER BY "
        + dedup_order("artist", "chart", "month", "month_start", "rank", "streams", "title", "trend", "url", "year")
        + ") = 1"
    )),
    "stream_entries": (("stream_silver", "feed_batches"), (
        "SELECT s.*, (SELECT min(batch_id) FROM feed_batches WHERE s.chart_date BETWEEN first_of AND last_of) AS batch_id FROM stream_silver s"
    )),
    "stream_recent": (("stream_entries",), (
        "SELECT * FROM stream_entries ORDER BY batch_id DESC, " + dedup_order("chart_date", "region", "chart", "rank", "artist", "title", "streams")
        + " LIMIT 100"
    )),
    "chart_daily": (("keyed",), (
        "SELECT CAST(user_id AS VARCHAR) AS track_id, 'Title ' || user_id AS title,"
        " 'Artist ' || (user_id % 40) AS artist, event_type AS region, CAST(ts AS DATE) AS chart_date,"
        ' CAST(min(k) + 1 AS INTEGER) AS "rank", CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS streams,'
        " 'top200' AS chart FROM keyed GROUP BY user_id, event_type, CAST(ts AS DATE)"
    )),
    "charts": ((), (
        "SELECT CAST(l_partkey AS VARCHAR) AS track_id, p_name AS title, p_brand AS artist, n_name AS region,"
        " CASE WHEN l_linestatus = 'F' THEN 'top200' ELSE 'viral50' END AS chart,"
        ' l_linenumber AS "rank", CAST(o_orderdate AS DATE) AS chart_date,'
        " CASE WHEN l_linestatus = 'F' THEN CAST(l_quantity AS BIGINT) END AS streams,"
        " year(o_orderdate) AS year, month(o_orderdate) AS month"
        " FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey"
        " LEFT JOIN nation ON c_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey"
    )),
    "raw_tracks": ((), (
        f"SELECT CAST(p_partkey AS VARCHAR) AS track_id, p_name AS track_name, {_columns(FEATURE_COLUMNS)} FROM part"
    )),
    "clamped": (("raw_tracks",), (
        f"SELECT track_id, track_name, {_CLAMPED}, tempo, loudness, album_release_date FROM raw_tracks"
    )),
    "tracks": (("clamped",), (
        f"SELECT *, {_MOOD} AS mood_quadrant, CAST(year(album_release_date) // 10 * 10 AS INTEGER) AS release_decade"
        " FROM clamped"
    )),
    "track_artists": ((), (
        "SELECT DISTINCT CAST(l_partkey AS VARCHAR) AS track_id, s_name AS artist_name,"
        " l_suppkey % 100 AS track_popularity FROM lineitem JOIN supplier ON l_suppkey = s_suppkey"
    )),
    "raw_countries": ((), (
        f"SELECT {_columns(COUNTRY_COLUMNS)} FROM nation JOIN region ON n_regionkey = r_regionkey"
        " LEFT JOIN (SELECT c_nationkey, count(*) AS customers FROM customer GROUP BY c_nationkey)"
        " ON n_nationkey = c_nationkey"
    )),
    "countries": (("raw_countries",), (
        "SELECT trim(region_code) AS region_code, trim(country_name) AS country_name,"
        " trim(continent) AS continent, population_2020, gdp_per_capita_usd"
        " FROM raw_countries WHERE region_code IS NOT NULL"
    )),
    "enriched": (("charts", "tracks", "countries"), (
        f"SELECT charts.*, {', '.join(PROFILE_FEATURES)}, mood_quadrant, release_decade,"
        " region_code, continent, population_2020 FROM charts LEFT JOIN tracks USING (track_id)"
        " LEFT JOIN countries ON region = country_name"
    )),
    "hits": (("enriched",), "SELECT * FROM enriched WHERE chart = 'top200'"),
    "mood_mart": (("enriched",), (
        "SELECT *, CASE WHEN sum(total_streams) OVER w > 0 THEN"
        " CAST(total_streams AS DOUBLE) / CAST(sum(total_streams) OVER w AS DOUBLE) END AS mood_share"
        " FROM (SELECT region, continent, year, season, mood_quadrant,"
        " CAST(sum(streams) AS BIGINT) AS total_streams, count(DISTINCT track_id) AS distinct_tracks,"
        f" count(*) AS chart_entries FROM (SELECT *, {SEASON} AS season FROM enriched)"
        " GROUP BY region, continent, year, season, mood_quadrant)"
        " WINDOW w AS (PARTITION BY region, year, season)"
    )),
    "streak_days_50": (("chart_daily",), (
        "SELECT *, chart_date - CAST(row_number() OVER (PARTITION BY track_id, region ORDER BY chart_date) AS INTEGER)"
        ' AS streak_group FROM chart_daily WHERE "rank" <= 50'
    )),
    "streak_mart": (("streak_days_50",), (
        "SELECT track_id, region, streak_group, title, artist, min(chart_date) AS streak_start,"
        " max(chart_date) AS streak_end, count(*) AS streak_days, CAST(sum(streams) AS BIGINT) AS streak_total_streams"
        " FROM streak_days_50 GROUP BY track_id, region, streak_group, title, artist"
    )),
    "totals": (("hits",), (
        'SELECT track_id, max(title) AS title, max(artist) AS artist, min("rank") AS peak_rank,'
        " count(*) AS total_chart_days, CAST(sum(streams) AS BIGINT) AS total_streams FROM hits GROUP BY track_id"
    )),
    "deciles": (("totals",), (
        "SELECT *, ntile(10) OVER (ORDER BY total_streams DESC NULLS LAST, track_id) AS stream_decile FROM totals"
    )),
    "region_days": (("hits",), (
        'SELECT track_id, region, chart_date, min("rank") AS "rank" FROM hits GROUP BY track_id, region, chart_date'
    )),
    "trajectory": (("region_days",), (
        'SELECT track_id, avg("rank" - prev) AS avg_rank_delta_7d FROM (SELECT *, lag("rank", 7) OVER'
        " (PARTITION BY track_id, region ORDER BY chart_date) AS prev FROM region_days) GROUP BY track_id"
    )),
    "tier_mart": (("deciles", "tracks", "trajectory"), (
        "SELECT stream_decile, count(*) AS track_count, avg(peak_rank) AS avg_peak_rank,"
        " avg(total_chart_days) AS avg_chart_days, avg(avg_rank_delta_7d) AS avg_rank_delta_7d, "
        + ", ".join(f"avg({f}) AS mean_{f}, stddev_samp({f}) AS std_{f}" for f in PROFILE_FEATURES)
        + " FROM deciles LEFT JOIN tracks USING (track_id) LEFT JOIN trajectory USING (track_id)"
        " GROUP BY stream_decile"
    )),
    "life": (("hits",), (
        "SELECT track_id, region, title, artist, continent, release_decade, min(chart_date) AS first_chart_date,"
        ' max(chart_date) AS last_chart_date, min("rank") AS peak_rank,'
        ' arg_min(chart_date, "rank" * 100000 + (chart_date - DATE \'1970-01-01\')) AS peak_date,'
        " count(*) AS total_chart_days, CAST(sum(streams) AS BIGINT) AS total_streams, avg(\"rank\") AS avg_rank,"
        " max(chart_date) - min(chart_date) AS chart_lifespan_days FROM hits"
        " GROUP BY track_id, region, title, artist, continent, release_decade"
    )),
    "longevity_mart": (("life", "tracks"), (
        f"SELECT life.*, {', '.join(BOUNDED_AUDIO_FEATURES)}, tempo, mood_quadrant"
        " FROM life LEFT JOIN tracks USING (track_id)"
    )),
    "artist_days": (("hits",), (
        "SELECT artist, chart_date, CAST(sum(streams) AS BIGINT) AS streams, count(*) AS entries"
        " FROM hits GROUP BY artist, chart_date"
    )),
    "artist_rolling": (("hits",), (
        "SELECT *, sum(streams) OVER (PARTITION BY artist ORDER BY chart_date"
        " RANGE BETWEEN INTERVAL 90 DAYS PRECEDING AND CURRENT ROW) AS rolling FROM hits"
    )),
    "artist_months": (("artist_rolling",), (
        "SELECT artist, CAST(date_trunc('month', chart_date) AS DATE) AS month_start,"
        " CAST(sum(streams) AS BIGINT) AS monthly_streams, count(DISTINCT track_id) AS distinct_tracks,"
        " count(*) AS chart_entries, avg(rolling) AS avg_rolling_90d_streams FROM artist_rolling GROUP BY ALL"
    )),
    "artist_profiles": (("hits", "tracks"), (
        "SELECT artist, "
        + ", ".join(f"avg(t.{f}) AS avg_{f}" for f in [*BOUNDED_AUDIO_FEATURES, "tempo"])
        + " FROM (SELECT DISTINCT artist, track_id FROM hits) LEFT JOIN tracks t USING (track_id) GROUP BY artist"
    )),
    "artist_mart": (("artist_months", "artist_profiles"), (
        "SELECT m.*, p.* EXCLUDE (artist) FROM (SELECT *, dense_rank() OVER (PARTITION BY month_start"
        " ORDER BY monthly_streams DESC NULLS LAST) AS monthly_rank FROM artist_months) m"
        " LEFT JOIN artist_profiles p USING (artist) WHERE monthly_rank <= 100"
    )),
    "stream_totals": (("stream_silver",), (
        "SELECT artist, month_start, CAST(sum(streams) AS BIGINT) AS monthly_streams, count(*) AS chart_entries"
        " FROM stream_silver WHERE streams IS NOT NULL GROUP BY artist, month_start"
    )),
    "batches": ((), (
        "SELECT *, cents / 10.0 AS processing_ms,"
        " round(rows * 1000.0 / (cents / 10.0), 1) AS throughput_rows_per_sec FROM"
        " (SELECT CAST(floor(epoch(date_trunc('hour', ts)) / 3600) AS BIGINT) AS batch_id, count(*) AS rows,"
        " CAST(sum(CAST(round(value * 100) AS BIGINT)) AS DOUBLE) AS cents FROM events GROUP BY 1)"
    )),
    "stages": ((), (
        "SELECT 'stage.' || event_type AS label, user_id % 2 = 0 AS aqe, value AS wall_sec FROM events"
    )),
}


def expect(tables: str, query: str) -> str:
    """`query` preceded by the CTEs named in `tables` (space-separated) and all they build on."""
    ordered: list[str] = []

    def add(name: str) -> None:
        if name not in ordered:
            for needed in _CTES[name][0]:
                add(needed)
            ordered.append(name)

    for name in tables.split():
        add(name)
    if not ordered:
        return query
    return "WITH " + ", ".join(f"{n} AS ({_CTES[n][1]})" for n in ordered) + " " + query

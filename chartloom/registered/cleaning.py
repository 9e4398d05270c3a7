"""Scans, cleaning operators and data quality."""

from pyspark.sql import functions as F

from chartloom import bindings, schemas
from chartloom.functions import text
from chartloom.operators import cleaning, quality
from chartloom.registered.catalog import query
from chartloom.registered.expected import PARSED_DATE, SEASON, TRACK_ID, expect
from chartloom.schemas import BOUNDED_AUDIO_FEATURES
from chartloom.sinks.staging import staging_path
from chartloom.sources.feed import parse_messages
from chartloom.sources.files import corrupt_counts, read_csv

PAGE_ID = "/([0-9]+)$"


@query("extract_id", "SELECT page_id, nullif(regexp_extract(url, '/([0-9]+)$', 1), '') AS track_id FROM pages")
def extract_id(spark, folder):
    pages = bindings.table(spark, folder, "pages")
    return cleaning.extract_track_id(pages, pattern=PAGE_ID).select("page_id", "track_id")


@query("extract_track_id", expect("feed", f"SELECT event_id, {TRACK_ID} AS track_id FROM feed"))
def extract_track_id(spark, folder):
    return cleaning.extract_track_id(bindings.feed(spark, folder)).select("event_id", "track_id")


@query("multi_format_date", expect("feed", (
    f"SELECT event_id, date, CAST({PARSED_DATE} AS VARCHAR) AS chart_date, year({PARSED_DATE}) AS year FROM feed"
)))
def multi_format_date(spark, folder):
    dated = cleaning.cast_date_with_fallback(bindings.feed(spark, folder))
    return dated.select("event_id", "date", "chart_date", F.year("chart_date").alias("year"))


@query("safe_numeric_cast", expect("feed", (
    'SELECT event_id, CAST(TRY_CAST("rank" AS INTEGER) AS BIGINT) AS "rank",'
    " TRY_CAST(streams AS BIGINT) AS streams FROM feed"
)))
def safe_numeric_cast(spark, folder):
    return cleaning.cast_numeric_columns(bindings.feed(spark, folder)).select("event_id", "rank", "streams")


def _typed(spark, folder):
    return (
        bindings.bronze_feed(spark, folder)
        .transform(cleaning.extract_track_id)
        .transform(cleaning.cast_date_with_fallback)
        .transform(cleaning.cast_numeric_columns)
    )


@query("corrupt_filter", expect("kept", (
    'SELECT event_id, track_id, CAST(chart_date AS VARCHAR) AS chart_date, CAST("rank" AS BIGINT) AS "rank" FROM kept'
)))
def corrupt_filter(spark, folder):
    kept = cleaning.filter_corrupt_rows(_typed(spark, folder))
    return kept.select("event_id", "track_id", "chart_date", "rank")


@query("corrupt_stats", expect("typed", (
    "SELECT count(*) AS total, count(*) FILTER (WHERE track_id IS NULL) AS null_track_id,"
    ' count(*) FILTER (WHERE chart_date IS NULL) AS null_chart_date, count(*) FILTER (WHERE "rank" IS NULL) AS null_rank,'
    ' count(*) FILTER (WHERE track_id IS NULL OR chart_date IS NULL OR "rank" IS NULL) AS dropped,'
    ' round(count(*) FILTER (WHERE track_id IS NULL OR chart_date IS NULL OR "rank" IS NULL) * 100.0 / count(*), 6) AS dropped_pct'
    " FROM typed"
)))
def corrupt_stats(spark, folder):
    return cleaning.corrupt_stats(_typed(spark, folder))


@query("dedup_latest", expect("kept", (
    'SELECT event_id, CAST(chart_date AS VARCHAR) AS chart_date, region, chart, CAST("rank" AS BIGINT) AS "rank", track_id'
    ' FROM kept QUALIFY row_number() OVER (PARTITION BY chart_date, region, chart, "rank"'
    " ORDER BY ingestion_ts DESC NULLS LAST, artist NULLS LAST, event_id NULLS LAST) = 1"
)))
def dedup_latest(spark, folder):
    kept = cleaning.filter_corrupt_rows(_typed(spark, folder))
    return cleaning.deduplicate_chart_entries(kept).select(
        "event_id", "chart_date", "region", "chart", "rank", "track_id"
    )


@query("dedup_narrow_key", expect("kept", (
    'SELECT event_id, CAST(chart_date AS VARCHAR) AS chart_date, region, chart, CAST("rank" AS BIGINT) AS "rank", track_id'
    ' FROM kept QUALIFY row_number() OVER (PARTITION BY chart_date, region, "rank"'
    " ORDER BY ingestion_ts DESC NULLS LAST, artist NULLS LAST, chart NULLS LAST, event_id NULLS LAST) = 1"
)))
def dedup_narrow_key(spark, folder):
    kept = cleaning.filter_corrupt_rows(_typed(spark, folder))
    return cleaning.deduplicate_chart_entries(kept, cleaning.NARROW_ENTRY_KEY).select(
        "event_id", "chart_date", "region", "chart", "rank", "track_id"
    )


@query("clean_chain", expect("cleaned", (
    'SELECT title, CAST("rank" AS BIGINT) AS "rank", artist, url, region, chart, trend, streams, track_id,'
    " CAST(chart_date AS VARCHAR) AS chart_date, year, month FROM cleaned"
)))
def clean_chain(spark, folder):
    return cleaning.transform_charts(bindings.bronze_feed(spark, folder).drop("event_id")).drop("ingestion_ts")


@query("week_column", (
    "SELECT o_orderkey, CAST(year(o_orderdate) AS BIGINT) AS year, CAST(month(o_orderdate) AS BIGINT) AS month,"
    " CAST(week(o_orderdate) AS BIGINT) AS week FROM orders"
))
def week_column(spark, folder):
    orders = bindings.table(spark, folder, "orders")
    return cleaning.add_time_columns(orders, "o_orderdate", week=True).select("o_orderkey", "year", "month", "week")


@query("trim_strings", expect("raw_countries", (
    "SELECT trim(region_code) AS region_code, trim(country_name) AS country_name, trim(continent) AS continent,"
    " population_2020, round(gdp_per_capita_usd, 6) AS gdp_per_capita_usd FROM raw_countries"
)))
def trim_strings(spark, folder):
    return cleaning.trim_string_columns(bindings.raw_countries(spark, folder))


@query("null_key_filter", expect("countries", (
    "SELECT region_code, country_name, continent, population_2020,"
    " round(gdp_per_capita_usd, 6) AS gdp_per_capita_usd FROM countries"
)))
def null_key_filter(spark, folder):
    return bindings.countries(spark, folder)


@query("clamp_features", expect("clamped", (
    "SELECT track_id, " + ", ".join(f"round({f}, 6) AS {f}" for f in BOUNDED_AUDIO_FEATURES) + " FROM clamped"
)))
def clamp_features(spark, folder):
    raw = bindings.raw_tracks(spark, folder)
    return cleaning.clamp_audio_features(raw).select("track_id", *BOUNDED_AUDIO_FEATURES)


@query("clamp_features_null_as_low", expect("raw_tracks", (
    "SELECT track_id, "
    + ", ".join(f"round(coalesce(least(greatest({f}, 0.0), 1.0), 0.0), 6) AS {f}" for f in BOUNDED_AUDIO_FEATURES)
    + " FROM raw_tracks"
)))
def clamp_features_null_as_low(spark, folder):
    raw = bindings.raw_tracks(spark, folder)
    return cleaning.clamp_audio_features(raw, null_as_low=True).select("track_id", *BOUNDED_AUDIO_FEATURES)


@query("mood_quadrant", expect("tracks", "SELECT track_id, mood_quadrant FROM tracks"))
def mood_quadrant(spark, folder):
    clamped = cleaning.clamp_audio_features(bindings.raw_tracks(spark, folder))
    return cleaning.assign_mood_quadrant(clamped).select("track_id", "mood_quadrant")


@query("mood_quadrant_null_as_low", expect("clamped", (
    "SELECT track_id, CASE WHEN valence > 0.5 AND energy > 0.5 THEN 'Happy/Energetic'"
    " WHEN valence > 0.5 AND energy <= 0.5 THEN 'Calm/Peaceful'"
    " WHEN valence <= 0.5 AND energy > 0.5 THEN 'Angry/Tense' ELSE 'Sad/Depressing' END AS mood_quadrant FROM clamped"
)))
def mood_quadrant_null_as_low(spark, folder):
    clamped = cleaning.clamp_audio_features(bindings.raw_tracks(spark, folder))
    return cleaning.assign_mood_quadrant(clamped, null_as_low=True).select("track_id", "mood_quadrant")


@query("release_decade", expect("tracks", (
    "SELECT track_id, CAST(album_release_date AS VARCHAR) AS album_release_date,"
    " CAST(release_decade AS BIGINT) AS release_decade FROM tracks"
)))
def release_decade(spark, folder):
    return cleaning.add_release_decade(bindings.raw_tracks(spark, folder)).select(
        "track_id", "album_release_date", "release_decade"
    )


@query("season", (
    f"SELECT o_orderkey, {SEASON} AS season FROM (SELECT o_orderkey, month(o_orderdate) AS month FROM orders)"
))
def season(spark, folder):
    orders = bindings.table(spark, folder, "orders").withColumn("month", F.month("o_orderdate"))
    return cleaning.derive_season(orders).select("o_orderkey", "season")


@query("track_view", expect("track_artists", (
    "SELECT track_id, arg_min(track_popularity, artist_name) AS track_popularity,"
    " string_agg(DISTINCT artist_name, '|' ORDER BY artist_name) AS artists FROM track_artists GROUP BY track_id"
)))
def track_view(spark, folder):
    view = cleaning.build_track_level_view(bindings.track_artists(spark, folder))
    return view.withColumn("artists", F.array_join("artists", "|"))


@query("artist_sets", expect("track_artists", (
    "SELECT track_id, count(DISTINCT artist_name) AS artist_count,"
    " string_agg(DISTINCT artist_name, '|' ORDER BY artist_name) AS artists FROM track_artists GROUP BY track_id"
)))
def artist_sets(spark, folder):
    sets = cleaning.artist_sets(bindings.track_artists(spark, folder))
    return sets.select("track_id", F.size("artists").alias("artist_count"), F.array_join("artists", "|").alias("artists"))


@query("surrogate_id", "SELECT p_partkey, substr(md5(p_brand || ':' || p_name), 1, 22) AS track_id FROM part")
def surrogate_id(spark, folder):
    parts = bindings.table(spark, folder, "part")
    return parts.select("p_partkey", text.surrogate_track_id(F.col("p_brand"), F.col("p_name")).alias("track_id"))


@query("manual_entry_rows", (
    "SELECT p_partkey, p_name AS title, CAST(p_size AS VARCHAR) AS \"rank\", '2024-01-01' AS date, p_brand AS artist,"
    " 'https://open.spotify.com/track/' || substr(md5(p_brand || ':' || p_name), 1, 22) AS url,"
    " p_type AS region, 'top200' AS chart, 'SAME_POSITION' AS trend,"
    " CASE WHEN p_partkey % 10 = 0 THEN '' ELSE CAST(p_partkey % 10 AS VARCHAR) END AS streams FROM part"
))
def manual_entry_rows(spark, folder):
    typed_in = bindings.table(spark, folder, "part").select(
        F.col("p_name").alias("title"), F.col("p_size").alias("rank"), F.lit("2024-01-01").alias("date"),
        F.col("p_brand").alias("artist"), F.col("p_type").alias("region"), F.lit("top200").alias("chart"),
        (F.col("p_partkey") % 10).alias("streams"), "p_partkey",
    )
    return cleaning.manual_entries(typed_in, keep=["p_partkey"])


@query("json_payload", expect("feed", (
    'SELECT event_id, title, "rank", date, artist, url, region, chart, trend, streams FROM feed WHERE event_id % 37 <> 9'
)))
def json_payload(spark, folder):
    messages = bindings.feed_messages(bindings.table(spark, folder, "events"))
    return parse_messages(messages)


@query("bulk_json_validate", expect("feed", (
    "SELECT event_id // 20 AS payload_id,"
    " row_number() OVER (PARTITION BY event_id // 20 ORDER BY event_id) AS entry, artist, title, \"rank\","
    " CASE WHEN event_id % 7 = 1 THEN NULL ELSE chart END AS chart,"
    " CASE WHEN event_id % 11 = 2 THEN NULL ELSE region END AS region,"
    " CASE WHEN event_id % 7 = 1 AND event_id % 11 = 2 THEN 'missing: chart, region'"
    " WHEN event_id % 7 = 1 THEN 'missing: chart' WHEN event_id % 11 = 2 THEN 'missing: region' END AS error"
    " FROM feed"
)))
def bulk_json_validate(spark, folder):
    """Twenty events with neighbouring ids form one submitted array; some entries lack a field."""
    entry = F.struct(
        "artist", "title",
        F.when(F.col("event_id") % 11 != 2, F.col("region")).alias("region"),
        F.when(F.col("event_id") % 7 != 1, F.col("chart")).alias("chart"),
        "rank", "date", "streams",
    )
    payload_id = F.floor(F.col("event_id") / 20).alias("payload_id")
    payloads = bindings.feed(spark, folder).groupBy(payload_id).agg(
        F.array_sort(F.collect_list(F.struct("event_id", entry.alias("entry")))).alias("_rows")
    ).select("payload_id", F.to_json(F.col("_rows.entry")).alias("payload"))
    return cleaning.parse_bulk_entries(payloads).drop("date", "streams")


_SHORT, _LONG = "event_id % 41 = 6", "event_id % 43 = 8"


def _csv_file(spark, folder):
    """The feed written as CSV, where some lines lose fields and some gain one."""
    rows = bindings.feed(spark, folder)
    columns = list(bindings.FEED_COLUMNS)
    line = F.to_csv(F.struct(*columns))
    damaged = (
        F.when(F.expr(_SHORT), F.concat_ws(",", "title", "rank", "date"))
        .when(F.expr(_LONG), F.concat(line, F.lit(",extra")))
        .otherwise(line)
    )
    path = staging_path(spark, "charts-csv")
    # lines are final text: a separator that never occurs keeps the writer from quoting them
    rows.select(damaged.alias(",".join(columns))).write.option("header", "true").option("sep", "\u0001").option(
        "quote", ""
    ).csv(path)
    return read_csv(spark, path, schemas.CHARTS_RAW_SCHEMA)


@query("csv_permissive", (
    f"SELECT count(*) AS total_rows, count(*) AS filled_rows, count(*) FILTER (WHERE {_SHORT} OR {_LONG}) AS corrupt_rows,"
    f" round(CAST(count(*) FILTER (WHERE {_SHORT} OR {_LONG}) AS DOUBLE) / count(*), 6) AS corrupt_ratio FROM events"
))
def csv_permissive(spark, folder):
    return corrupt_counts(_csv_file(spark, folder))


@query("csv_rows", expect("feed", (
    "SELECT title, \"rank\", date, artist, url, region, chart, trend, nullif(streams, '') AS streams"
    f" FROM feed WHERE NOT ({_SHORT} OR {_LONG})"
)))
def csv_rows(spark, folder):
    rows = _csv_file(spark, folder)
    return rows.where(F.col(schemas.CORRUPT_COLUMN).isNull()).drop(schemas.CORRUPT_COLUMN)


@query("csv_bom_multi_line", expect("feed", (
    "SELECT title || chr(10) || '\"live\", ' || region AS title, \"rank\", date, artist, url, region, chart, trend, nullif(streams, '') AS streams FROM feed"
)))
def csv_bom_multi_line(spark, folder):
    """Files that begin with a byte order mark, with titles of two lines, quotes and separators."""
    title = F.concat("title", F.lit("\n\"live\", "), "region")
    rows = bindings.feed(spark, folder).withColumn("title", title).select(*schemas.CHARTS_RAW_SCHEMA.fieldNames())
    path = staging_path(spark, "bom")
    # the header of every file starts with the mark
    rows.withColumnRenamed("title", "\ufefftitle").write.option("header", "true").option("quoteAll", "true").csv(path)
    return read_csv(spark, path, schemas.CHARTS_RAW_SCHEMA, multi_line=True, corrupt_column=None)


def _check(name: str, observed: str, passed: str, layer: str, source: str) -> str:
    return (
        f"SELECT '{layer}' AS layer, '{name}' AS \"check\", CAST({observed} AS BIGINT) AS observed,"
        f" {passed.format(x=observed)} AS passed FROM {source}"
    )


@query("quality_report", expect("typed", " UNION ALL ".join([
    _check("no_nulls(track_id)", "count(*) FILTER (WHERE track_id IS NULL)", "{x} = 0", "feed", "typed"),
    _check("no_nulls(region)", "count(*) FILTER (WHERE region IS NULL)", "{x} = 0", "feed", "typed"),
    _check("min_rows(1000)", "count(*)", "{x} >= 1000", "feed", "typed"),
    _check("column_range(rank, 1, 50)", 'count(*) FILTER (WHERE "rank" < 1 OR "rank" > 50)', "{x} = 0", "feed", "typed"),
    _check("no_nulls(l_partkey)", "count(*) FILTER (WHERE l_partkey IS NULL)", "{x} = 0", "lines", "lineitem"),
    _check("column_range(l_discount, 0.0, 0.1)", "count(*) FILTER (WHERE l_discount < 0.0 OR l_discount > 0.1)", "{x} = 0",
           "lines", "lineitem"),
    _check("min_rows(1)", "count(*)", "{x} >= 1", "lines", "lineitem"),
])))
def quality_report(spark, folder):
    feed_checks = [
        quality.no_nulls("track_id"), quality.no_nulls("region"), quality.min_rows(1000),
        quality.column_range("rank", 1, 50),
    ]
    line_checks = [
        quality.no_nulls("l_partkey"), quality.column_range("l_discount", 0.0, 0.1), quality.min_rows(1),
    ]
    lines = bindings.table(spark, folder, "lineitem")
    return quality.quality_report(_typed(spark, folder), "feed", feed_checks).unionByName(
        quality.quality_report(lines, "lines", line_checks)
    )


@query("layer_summary", (
    "SELECT 'bronze' AS layer, 'events' AS \"table\", count(*) AS rows, CAST(6 AS BIGINT) AS columns FROM events"
))
def layer_summary(spark, folder):
    return quality.layer_summary(bindings.table(spark, folder, "events"), "bronze", "events")


@query("artist_split", expect("feed", (
    "SELECT event_id, trim(credited) AS credited FROM (SELECT event_id,"
    " unnest(regexp_split_to_array(artist, '(?i)\\s*(?:,|&|;|\\bfeat\\.|\\bft\\.|\\bfeaturing\\b)\\s*')) AS credited"
    " FROM feed) WHERE trim(credited) <> ''"
)))
def artist_split(spark, folder):
    return cleaning.credited_artists(bindings.feed(spark, folder)).select("event_id", "credited")

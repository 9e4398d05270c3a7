"""Enrichment joins, upserts and table round trips."""

from pyspark.sql import functions as F

from chartloom import bindings, medallion
from chartloom.operators import enrich, joins
from chartloom.plans import mood
from chartloom.registered.catalog import query
from chartloom.registered.expected import expect
from chartloom.registry import Lake, available_tables, register_views
from chartloom.sinks.staging import staging_path
from chartloom.sinks.tables import new_rows, stamp_ingestion, write_table
from chartloom.sources.files import as_of, read_parquet


@query("enriched_join", expect("enriched", (
    'SELECT track_id, title, artist, region, chart, CAST("rank" AS BIGINT) AS "rank",'
    " CAST(chart_date AS VARCHAR) AS chart_date, streams, mood_quadrant, CAST(release_decade AS BIGINT) AS release_decade,"
    " round(tempo, 6) AS tempo, round(valence, 6) AS valence, region_code, continent FROM enriched"
)))
def enriched_join(spark, folder):
    return bindings.enriched(spark, folder).select(
        "track_id", "title", "artist", "region", "chart", "rank", "chart_date", "streams", "mood_quadrant",
        "release_decade", "tempo", "valence", "region_code", "continent",
    )


@query("country_match", expect("countries", (
    "SELECT c_custkey, c.region, coalesce(n.region_code, k.region_code) AS region_code,"
    " coalesce(n.continent, k.continent) AS continent FROM"
    " (SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'NATION_' || c_nationkey WHEN 1 THEN 'N' || c_nationkey"
    " ELSE 'global' END AS region FROM customer) c"
    " LEFT JOIN countries n ON c.region = n.country_name LEFT JOIN countries k ON lower(c.region) = k.region_code"
)))
def country_match(spark, folder):
    """A third of the rows name their country, a third carry its code, a third are "global"."""
    region = (
        F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string")))
        .when(F.col("c_custkey") % 3 == 1, F.concat(F.lit("N"), F.col("c_nationkey").cast("string")))
        .otherwise("global")
    )
    rows = bindings.table(spark, folder, "customer").select("c_custkey", region.alias("region"))
    dim = bindings.countries(spark, folder).select("region_code", "country_name", "continent")
    return enrich.join_countries(rows, dim)


@query("dim_broadcast_join", (
    "SELECT s_suppkey, s_name, n_name FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey"
))
def dim_broadcast_join(spark, folder):
    nations = bindings.table(spark, folder, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    suppliers = bindings.table(spark, folder, "supplier")
    return joins.lookup(suppliers, nations, "s_nationkey").select("s_suppkey", "s_name", "n_name")


_LINE_TRACKS = expect("tracks", (
    "SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, CAST(l_suppkey AS BIGINT) AS l_suppkey,"
    " CAST(l_partkey AS VARCHAR) AS track_id, mood_quadrant, round(tempo, 6) AS tempo"
    " FROM lineitem LEFT JOIN tracks ON CAST(l_partkey AS VARCHAR) = track_id"
))


def _lines(spark, folder):
    return bindings.table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", F.col("l_partkey").cast("string").alias("track_id")
    )


def _track_attributes(spark, folder):
    return bindings.tracks(spark, folder).select("track_id", "mood_quadrant", "tempo")


@query("salted_join", _LINE_TRACKS)
def salted_join(spark, folder):
    return joins.salted_join(_lines(spark, folder), _track_attributes(spark, folder), "track_id")


@query("hot_key_join", _LINE_TRACKS)
def hot_key_join(spark, folder):
    return enrich.join_tracks(_lines(spark, folder), _track_attributes(spark, folder), split_hot=True)


_SPLIT = "2024-01-15"
_OVERLAP = "2024-01-10"


def _daily_parts(spark, folder):
    """Entries up to one date, and entries from an earlier date on: they overlap by a few days."""
    daily = bindings.chart_daily(spark, folder)
    return daily.where(F.col("chart_date") <= _SPLIT), daily.where(F.col("chart_date") >= _OVERLAP)


@query("upsert_insert_only", expect("chart_daily", (
    'SELECT track_id, region, CAST(chart_date AS VARCHAR) AS chart_date, CAST("rank" AS BIGINT) AS "rank", streams'
    f" FROM chart_daily WHERE chart_date > DATE '{_SPLIT}'"
)))
def upsert_insert_only(spark, folder):
    """The rows an insert-only merge of the overlapping second part adds to the first."""
    target, incoming = _daily_parts(spark, folder)
    keys = ["track_id", "chart_date", "region"]
    return new_rows(incoming, target, keys, [F.col("rank"), F.col("streams")]).select(
        "track_id", "region", "chart_date", "rank", "streams"
    )


def _loaded(spark, folder):
    """A table into which both parts were loaded as increments, the second one twice."""
    path = staging_path(spark, "increments")
    first, second = _daily_parts(spark, folder)
    keys = ["track_id", "chart_date", "region"]
    for batch_id, rows in ((0, first), (1, second), (1, second)):
        medallion.load_increment(spark, path, rows, keys, batch_id, day="chart_date")
    return read_parquet(spark, path)


@query("incremental_load", expect("chart_daily", (
    'SELECT track_id, region, CAST(chart_date AS VARCHAR) AS chart_date, CAST("rank" AS BIGINT) AS "rank", streams,'
    f" CAST(CASE WHEN chart_date <= DATE '{_SPLIT}' THEN 0 ELSE 1 END AS BIGINT) AS batch_id FROM chart_daily"
)))
def incremental_load(spark, folder):
    return _loaded(spark, folder).select("track_id", "region", "chart_date", "rank", "streams", "batch_id")


@query("as_of_batch", expect("chart_daily", (
    'SELECT track_id, region, CAST(chart_date AS VARCHAR) AS chart_date, CAST("rank" AS BIGINT) AS "rank", streams'
    f" FROM chart_daily WHERE chart_date <= DATE '{_SPLIT}'"
)))
def as_of_batch(spark, folder):
    return as_of(_loaded(spark, folder), 0).select("track_id", "region", "chart_date", "rank", "streams")


_CHART_ROWS = expect("charts", (
    'SELECT track_id, title, artist, region, chart, CAST("rank" AS BIGINT) AS "rank",'
    " CAST(chart_date AS VARCHAR) AS chart_date, streams, year, month FROM charts"
))


@query("partitioned_roundtrip", _CHART_ROWS)
def partitioned_roundtrip(spark, folder):
    """Written by region and year and read back under the declared schema."""
    rows = bindings.charts(spark, folder)
    path = staging_path(spark, "by-region-year")
    write_table(rows, path, partition_by=("region", "year"))
    return read_parquet(spark, path, rows.schema).select(*rows.columns)


@query("gold_by_year", expect("mood_mart", (
    "SELECT region, season, mood_quadrant, total_streams, distinct_tracks, chart_entries FROM mood_mart WHERE year = 1998"
)))
def gold_by_year(spark, folder):
    """A mart written by year; the filter on the partition column reads one folder."""
    path = staging_path(spark, "mood-by-year")
    write_table(mood.build_regional_mood_seasonal(bindings.enriched(spark, folder)), path, partition_by=("year",))
    written = read_parquet(spark, path).where(F.col("year") == 1998)
    return written.select("region", "season", "mood_quadrant", "total_streams", "distinct_tracks", "chart_entries")


@query("write_counters", expect("feed", (
    "SELECT count(*) AS rows, count(*) FILTER (WHERE url IS NULL) AS no_url, count(*) FILTER (WHERE streams = '') AS no_streams FROM feed"
)))
def write_counters(spark, folder):
    """Row counts taken by the write itself, next to the ingestion stamp."""
    rows = stamp_ingestion(bindings.feed(spark, folder))
    counts = write_table(rows, staging_path(spark, "counted"), counters={
        "no_url": F.count_if(F.col("url").isNull()), "no_streams": F.count_if(F.col("streams") == ""),
    })
    return spark.createDataFrame([counts], "rows bigint, no_url bigint, no_streams bigint")


@query("table_discovery", expect("chart_daily countries", (
    "SELECT 'silver_charts_cleaned' AS view, count(*) AS rows FROM chart_daily"
    " UNION ALL SELECT 'silver_countries', count(*) FROM countries"
    " UNION ALL SELECT 'available silver', 2"
)))
def table_discovery(spark, folder):
    """Tables found in a lake, registered as views and counted through SQL."""
    lake = Lake(staging_path(spark, "lake"))
    write_table(bindings.chart_daily(spark, folder), lake.path("silver.charts_cleaned"))
    write_table(bindings.countries(spark, folder), lake.path("silver.countries"))
    views = register_views(spark, lake)
    counts = " UNION ALL ".join(f"SELECT '{v}' AS view, count(*) AS rows FROM {v}" for v in views)
    found = len(available_tables(spark, lake, "silver"))
    return spark.sql(f"{counts} UNION ALL SELECT 'available silver', CAST({found} AS BIGINT)")

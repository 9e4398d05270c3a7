"""Declared schemas of the three sources, the feed messages and the run records.

Raw chart numbers and dates stay strings: they are cast during cleaning, where a
bad value becomes null instead of failing the read.
"""

from pyspark.sql import types as T

CORRUPT_COLUMN = "_corrupt_record"


_TYPES = {
    "string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(),
    "double": T.DoubleType(), "date": T.DateType(), "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
}


def _struct(columns: str, required: tuple[str, ...] = ()) -> T.StructType:
    """A schema from `name type, ...`; unlike the built-in parser it needs no session."""
    pairs = [c.split() for c in columns.split(",")]
    return T.StructType([T.StructField(n, _TYPES[t], n not in required) for n, t in pairs])


# Column names and types of the sources, in file order.
CHARTS_RAW_SCHEMA = _struct(
    "title string, rank string, date string, artist string, url string, "
    "region string, chart string, trend string, streams string"
)
TRACK_FEATURES_RAW_SCHEMA = _struct(
    "track_id string, artist_name string, track_name string, album_name string, "
    "album_release_date date, duration_ms int, explicit int, track_popularity int, "
    "album_popularity int, artist_popularity int, artist_followers bigint, tempo double, "
    "key int, mode int, danceability double, energy double, loudness double, "
    "speechiness double, acousticness double, instrumentalness double, liveness double, "
    "valence double, energy_danceability_score double",
    required=("track_id",),
)
COUNTRIES_RAW_SCHEMA = _struct(
    "region_code string, country_name string, continent string, "
    "population_2020 bigint, gdp_per_capita_usd double",
    required=("region_code",),
)

# Features that are defined on [0, 1], and the full profile list.
BOUNDED_AUDIO_FEATURES = [
    "danceability", "energy", "speechiness", "acousticness",
    "instrumentalness", "liveness", "valence",
]
PROFILE_FEATURES = BOUNDED_AUDIO_FEATURES + ["tempo", "loudness"]

BATCH_METRICS_SCHEMA = _struct(
    "batch_id bigint, rows bigint, processing_ms double, "
    "throughput_rows_per_sec double, bronze_total_rows bigint, ts string"
)
BATCH_LEDGER_SCHEMA = _struct("batch_id bigint, step string, reason string, state string, entry bigint, ts timestamp")
PROGRESS_SCHEMA = _struct(
    "query_id string, batch_id bigint, rows bigint, processing_ms double, throughput_rows_per_sec double, ts string, "
    "run_id string, name string"
)
STAGE_METRICS_SCHEMA = _struct(
    "label string, aqe boolean, wall_sec double, shuffle_partitions string"
)

# Tables the feed writes; partition columns come last.
FEED_BRONZE_SCHEMA = T.StructType(
    [*CHARTS_RAW_SCHEMA.fields, *_struct("ingestion_ts timestamp, batch_id bigint").fields]
)
FEED_SILVER_SCHEMA = _struct(
    "title string, rank int, artist string, url string, region string, chart string, trend string, "
    "streams bigint, ingestion_ts timestamp, track_id string, chart_date date, year int, month int, "
    "month_start date, batch_id bigint"
)
ARTIST_PARTIALS_SCHEMA = _struct(
    "artist string, monthly_streams bigint, chart_entries bigint, month_start date, batch_id bigint"
)
ARTIST_TOTALS_SCHEMA = _struct(
    "artist string, monthly_streams bigint, chart_entries bigint, month_start date"
)
RECENT_SCHEMA = _struct(
    "ingestion_ts timestamp, artist string, title string, region string, chart string, rank int, "
    "streams bigint, chart_date date, batch_id bigint"
)


def with_corrupt_column(schema: T.StructType, name: str = CORRUPT_COLUMN) -> T.StructType:
    """A copy of `schema` that also captures malformed lines (`StructType.add` would mutate it)."""
    return T.StructType([*schema.fields, T.StructField(name, T.StringType(), True)])

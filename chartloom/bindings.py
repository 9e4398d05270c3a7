"""The test tables seen as chart data.

The library's operators work on chart entries, track features and countries. These views
derive such tables from the order and event tables, row by row and join by join, so every
query grows with its input. Column expressions are kept as SQL text because the expected
results are stated over the same derived columns.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartloom import schemas
from chartloom.operators import cleaning, enrich
from chartloom.sinks.staging import stage

# --- derived columns, as SQL text --------------------------------------------

# Over events, with `k` the number inside props and `iso` the day as yyyy-MM-dd text.
# Dates come in three formats and some are unreadable; ranks, addresses and streams have gaps.
FEED_COLUMNS = {
    "title": "concat('Title ', CAST(user_id AS STRING))",
    "rank": "CASE WHEN event_id % 17 = 3 THEN 'N/A' ELSE CAST(k + 1 AS STRING) END",
    "date": (
        "CASE WHEN event_id % 31 = 7 THEN 'unknown'"
        " WHEN event_id % 4 = 1 THEN concat(substr(iso, 6, 2), '/', substr(iso, 9, 2), '/', substr(iso, 1, 4))"
        " WHEN event_id % 4 = 2 THEN concat(substr(iso, 9, 2), '-', substr(iso, 6, 2), '-', substr(iso, 1, 4))"
        " ELSE iso END"
    ),
    "artist": (
        "CASE WHEN event_id % 5 = 0 THEN concat('Artist ', CAST(user_id % 40 AS STRING),"
        " ' feat. Artist ', CAST(user_id % 7 AS STRING), ', Artist ', CAST(user_id % 11 AS STRING))"
        " ELSE concat('Artist ', CAST(user_id % 40 AS STRING)) END"
    ),
    "url": (
        "CASE WHEN event_id % 29 = 5 THEN NULL"
        " WHEN event_id % 23 = 4 THEN 'https://charts.example.com/artist/abc'"
        " ELSE concat('https://charts.example.com/track/T', CAST(user_id AS STRING), 'x') END"
    ),
    "region": "event_type",
    "chart": "CASE WHEN event_id % 5 = 2 THEN 'viral50' ELSE 'top200' END",
    "trend": "CASE WHEN event_id % 3 = 0 THEN 'MOVE_UP' ELSE 'MOVE_DOWN' END",
    "streams": (
        "CASE WHEN event_id % 5 = 2 THEN '' ELSE CAST(CAST(round(value * 100) AS BIGINT) AS STRING) END"
    ),
}

# Over part. Some values lie outside [0, 1] and some are missing.
FEATURE_COLUMNS = {
    "danceability": "CAST(p_size - 5 AS DOUBLE) / 41",
    "energy": "CASE WHEN p_partkey % 40 = 3 THEN NULL ELSE CAST((p_partkey * 7) % 101 AS DOUBLE) / 101 END",
    "speechiness": "CAST((p_partkey * 11) % 97 AS DOUBLE) / 97",
    "acousticness": "CAST((p_partkey * 13) % 89 AS DOUBLE) / 89",
    "instrumentalness": "CAST((p_size * 17) % 53 AS DOUBLE) / 47",
    "liveness": "CASE WHEN p_partkey % 50 = 7 THEN NULL ELSE CAST(p_partkey % 10 AS DOUBLE) / 9 END",
    "valence": "CAST((p_partkey * 29) % 103 AS DOUBLE) / 101",
    "tempo": "CAST(60 + (p_partkey * 3) % 120 AS DOUBLE)",
    "loudness": "CAST(-p_size AS DOUBLE) / 2",
    "album_release_date": "make_date(1960 + p_size, 1 + CAST(p_partkey % 12 AS INT), 1)",
}

# Over nation (n), region (r) and the customers per nation, with stray blanks.
COUNTRY_COLUMNS = {
    "region_code": "CASE WHEN n_nationkey = 24 THEN NULL ELSE concat('n', CAST(n_nationkey AS STRING)) END",
    "country_name": "concat('  ', n_name)",
    "continent": "concat(' ', r_name, ' ')",
    "population_2020": "customers",
    "gdp_per_capita_usd": "CAST(n_nationkey AS DOUBLE) * 1000.5",
}


def _select(df: DataFrame, columns: dict[str, str], *keep: str) -> DataFrame:
    return df.select(*keep, *[F.expr(e).alias(name) for name, e in columns.items()])


# --- views -------------------------------------------------------------------

# Declared, so that opening a table starts no job to infer its schema.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
        " o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
        " l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,"
        " l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    ),
    "pages": "page_id bigint, url string, html string",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{folder}/{name}.parquet")


def keyed_events(events: DataFrame) -> DataFrame:
    return events.withColumns({
        "k": F.expr("CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT)"),
        "iso": F.col("ts").cast("date").cast("string"),
    })


def feed(spark: SparkSession, folder: str) -> DataFrame:
    """Raw chart rows, one per event; `event_id` identifies the row and `ingestion_ts` its arrival."""
    events = keyed_events(table(spark, folder, "events"))
    return _select(events, FEED_COLUMNS, "event_id", F.col("ts").cast("timestamp").alias("ingestion_ts"))


def bronze_feed(spark: SparkSession, folder: str) -> DataFrame:
    """The raw rows as a stored table, which is what the cleaning operators read."""
    return stage(feed(spark, folder), "bronze-feed")


def feed_messages(events: DataFrame) -> DataFrame:
    """The same rows as JSON messages; every 37th is cut off in the middle."""
    rows = _select(keyed_events(events), FEED_COLUMNS, "event_id")
    message = F.to_json(F.struct(*FEED_COLUMNS))
    broken = F.expr("substr(message, 1, 20)")
    return rows.select("event_id", message.alias("message")).select(
        "event_id", F.when(F.col("event_id") % 37 == 9, broken).otherwise(F.col("message")).alias("value")
    )


FEED_BATCHES = 3


def feed_batch(spark: SparkSession, folder: str, n: int) -> DataFrame:
    """The messages of the days that batch `n` of the feed brings; its last day is the first one of the next batch."""
    events = table(spark, folder, "events")
    day = F.col("ts").cast("date")
    span = events.agg(F.min(day).alias("first"), (F.datediff(F.max(day), F.min(day)) + 1).alias("days")).first()
    if span["first"] is None:
        return feed_messages(events).select("value")
    since = F.datediff(day, F.lit(span["first"]))
    own = events.where(since.between(n * span["days"] // FEED_BATCHES, (n + 1) * span["days"] // FEED_BATCHES))
    return feed_messages(own).select("value")


def chart_daily(spark: SparkSession, folder: str) -> DataFrame:
    """One entry per day, event type and user: best position and streams of the day."""
    events = keyed_events(table(spark, folder, "events"))
    daily = events.groupBy(
        F.col("ts").cast("date").alias("chart_date"), F.col("event_type").alias("region"), "user_id"
    ).agg(
        (F.min("k") + 1).cast("int").alias("rank"),
        F.sum(F.round(F.col("value") * 100).cast("bigint")).alias("streams"),
    )
    return daily.select(
        F.col("user_id").cast("string").alias("track_id"),
        F.concat(F.lit("Title "), F.col("user_id").cast("string")).alias("title"),
        F.concat(F.lit("Artist "), (F.col("user_id") % 40).cast("string")).alias("artist"),
        "region", "chart_date", "rank", "streams", F.lit("top200").alias("chart"),
    )


def plays(spark: SparkSession, folder: str) -> DataFrame:
    """Chart entries before their titles, from order lines: part number as track, customer nation as region."""
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_linestatus"
    )
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    customers = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    nations = table(spark, folder, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    placed = orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).join(nations, "c_nationkey", "left")
    old = F.col("l_linestatus") == "F"
    return lines.join(placed, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_partkey").alias("track_id"),
        F.col("n_name").alias("region"),
        F.when(old, "top200").otherwise("viral50").alias("chart"),
        F.col("l_linenumber").alias("rank"),
        F.col("o_orderdate").cast("date").alias("chart_date"),
        F.when(old, F.col("l_quantity").cast("bigint")).alias("streams"),
    )


def titled(spark: SparkSession, folder: str, rows: DataFrame) -> DataFrame:
    """Rows of `plays`, or rows reduced from them, with part name as title and brand as artist."""
    parts = table(spark, folder, "part").select("p_partkey", "p_name", "p_brand")
    return rows.join(parts, F.col("track_id") == F.col("p_partkey")).select(
        F.col("track_id").cast("string").alias("track_id"),
        F.col("p_name").alias("title"),
        F.col("p_brand").alias("artist"),
        *[c for c in rows.columns if c != "track_id"],
    )


def charts(spark: SparkSession, folder: str) -> DataFrame:
    """Typed chart entries from order lines: part as track, brand as artist, customer nation as region."""
    return titled(spark, folder, plays(spark, folder)).transform(cleaning.add_time_columns)


def raw_tracks(spark: SparkSession, folder: str) -> DataFrame:
    """One row per part with unclamped features."""
    parts = table(spark, folder, "part")
    return _select(
        parts, FEATURE_COLUMNS, F.col("p_partkey").cast("string").alias("track_id"), "p_name"
    ).withColumnRenamed("p_name", "track_name")


def tracks(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.clean_features(raw_tracks(spark, folder))


def track_artists(spark: SparkSession, folder: str) -> DataFrame:
    """One row per part and supplier that ships it."""
    pairs = table(spark, folder, "lineitem").select("l_partkey", "l_suppkey").distinct()
    suppliers = table(spark, folder, "supplier").select("s_suppkey", "s_name")
    return pairs.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey")).select(
        F.col("l_partkey").cast("string").alias("track_id"),
        F.col("s_name").alias("artist_name"),
        (F.col("l_suppkey") % 100).alias("track_popularity"),
    )


def raw_countries(spark: SparkSession, folder: str, population: bool = True) -> DataFrame:
    """Nations with padded names; the population is the number of customers."""
    nations = table(spark, folder, "nation")
    regions = table(spark, folder, "region")
    joined = nations.join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
    columns = dict(COUNTRY_COLUMNS)
    if population:
        customers = table(spark, folder, "customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("customers"))
        joined = joined.join(customers, F.col("n_nationkey") == F.col("c_nationkey"), "left")
    else:
        del columns["population_2020"]
    return _select(joined, columns)


def countries(spark: SparkSession, folder: str, population: bool = True) -> DataFrame:
    return cleaning.clean_countries(raw_countries(spark, folder, population))


def enriched(spark: SparkSession, folder: str, population: bool = False) -> DataFrame:
    """Entries with track features and country; a counted population makes the dimension a stored table."""
    features = [*schemas.PROFILE_FEATURES, "mood_quadrant", "release_decade"]
    dim = countries(spark, folder, population).drop("gdp_per_capita_usd")
    return enrich.enrich_charts(
        charts(spark, folder),
        tracks(spark, folder).select("track_id", *features),
        stage(dim, "countries") if population else dim,
    )


def batch_records(spark: SparkSession, folder: str) -> DataFrame:
    """Micro-batch records: each hour of events stands for a batch."""
    # counted from the wall clock of the column, so the session's time zone plays no part
    hour_number = F.unix_date(F.col("ts").cast("date")).cast("bigint") * 24 + F.hour("ts")
    hours = table(spark, folder, "events").groupBy(hour_number.alias("batch_id")).agg(F.count(F.lit(1)).alias("rows"), F.sum(F.round(F.col("value") * 100).cast("bigint")).alias("cents"))
    milliseconds = F.col("cents").cast("double") / 10
    return hours.select(
        "batch_id",
        "rows",
        milliseconds.alias("processing_ms"),
        F.round(F.try_divide(F.col("rows") * 1000.0, milliseconds), 1).alias("throughput_rows_per_sec"),
    )


def stage_records(spark: SparkSession, folder: str) -> DataFrame:
    """Stage records: each event stands for one timed run of a stage."""
    return table(spark, folder, "events").select(
        F.concat(F.lit("stage."), "event_type").alias("label"),
        (F.col("user_id") % 2 == 0).alias("aqe"),
        F.col("value").alias("wall_sec"),
    )

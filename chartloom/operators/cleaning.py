"""Cleaning operators for the three sources. Pure transforms: no action, no I/O.

The same chain serves the batch tables and the micro-batches.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartloom import schemas
from chartloom.functions import audio, dates, numbers, text
from chartloom.operators.shaping import keep_latest

# A chart entry is one rank of one chart on one day. The narrower key leaves `chart` out,
# which lets entries of different charts displace each other.
ENTRY_KEY = ["chart_date", "region", "chart", "rank"]
NARROW_ENTRY_KEY = ["chart_date", "region", "rank"]
REQUIRED_ENTRY_COLUMNS = ("track_id", "chart_date", "rank")


def extract_track_id(df: DataFrame, url: str = "url", pattern: str = text.TRACK_ID_PATTERN) -> DataFrame:
    return df.withColumn("track_id", text.id_from_url(url, pattern))


def cast_date_with_fallback(df: DataFrame, source: str = "date", name: str = "chart_date") -> DataFrame:
    return df.withColumn(name, dates.parse_date(source))


def cast_numeric_columns(df: DataFrame) -> DataFrame:
    """rank to int and streams to bigint; text that is not a number becomes null."""
    return df.withColumns({
        "rank": numbers.whole_number("rank", "int"),
        "streams": numbers.whole_number("streams", "bigint"),
    })


def corrupt_conditions(required: Sequence[str] = REQUIRED_ENTRY_COLUMNS) -> dict[str, Column]:
    """Per-cause counters, to be observed on a pass that runs anyway or aggregated."""
    missing = [F.col(c).isNull() for c in required]
    counters = {f"null_{c}": F.count_if(m) for c, m in zip(required, missing)}
    any_missing = missing[0]
    for m in missing[1:]:
        any_missing = any_missing | m
    return {**counters, "dropped": F.count_if(any_missing)}


def corrupt_stats(df: DataFrame, required: Sequence[str] = REQUIRED_ENTRY_COLUMNS) -> DataFrame:
    """Rows, nulls per required column, rows to drop and their percentage, in one pass."""
    counted = df.agg(
        F.count(F.lit(1)).alias("total"),
        *[c.alias(name) for name, c in corrupt_conditions(required).items()],
    )
    share = F.try_divide(F.col("dropped") * F.lit(100.0), F.col("total"))
    return counted.withColumn("dropped_pct", share)


def filter_corrupt_rows(df: DataFrame, required: Sequence[str] = REQUIRED_ENTRY_COLUMNS) -> DataFrame:
    # one predicate per column, so the cheap ones can stop the evaluation of the others
    for column in reversed(required):
        df = df.where(F.col(column).isNotNull())
    return df


def deduplicate_chart_entries(
    df: DataFrame, keys: Sequence[str] = ENTRY_KEY, latest: str = "ingestion_ts"
) -> DataFrame:
    """The most recently ingested row per entry.

    One batch stamps all its rows with the same time, so the remaining columns settle
    ties in a fixed order and the survivor does not depend on partitioning.
    """
    rest = [c for c in sorted(df.columns) if c not in keys and c != latest]
    order = [F.col(latest).desc_nulls_last()] + [F.col(c).asc_nulls_last() for c in rest]
    return keep_latest(df, [k for k in keys if k in df.columns], order)


def add_time_columns(df: DataFrame, day: str = "chart_date", week: bool = False) -> DataFrame:
    parts = {"year": F.year(day), "month": F.month(day)}
    if week:
        parts["week"] = F.weekofyear(day)
    return df.withColumns(parts)


def transform_charts(
    df: DataFrame, keys: Sequence[str] = ENTRY_KEY, week: bool = False, url_pattern: str = text.TRACK_ID_PATTERN
) -> DataFrame:
    """Raw chart rows to typed, deduplicated entries."""
    return (
        df.transform(extract_track_id, pattern=url_pattern)
        .transform(cast_date_with_fallback)
        .transform(cast_numeric_columns)
        .transform(filter_corrupt_rows)
        .drop("date", schemas.CORRUPT_COLUMN)
        .transform(deduplicate_chart_entries, keys)
        .transform(add_time_columns, week=week)
    )


def trim_string_columns(df: DataFrame) -> DataFrame:
    return df.select([
        F.trim(f.name).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
        for f in df.schema.fields
    ])


def clean_countries(df: DataFrame) -> DataFrame:
    """Trimmed dimension rows that have a code."""
    return trim_string_columns(df).dropna(subset=["region_code"]).drop("ingestion_ts", schemas.CORRUPT_COLUMN)


def clamp_audio_features(
    df: DataFrame, features: Sequence[str] = schemas.BOUNDED_AUDIO_FEATURES, null_as_low: bool = False
) -> DataFrame:
    return df.withColumns({f: audio.clamp(f, null_as_low=null_as_low) for f in features})


def assign_mood_quadrant(df: DataFrame, null_as_low: bool = False) -> DataFrame:
    return df.withColumn("mood_quadrant", audio.mood_quadrant("valence", "energy", null_as_low))


def add_release_decade(df: DataFrame, day: str = "album_release_date") -> DataFrame:
    return df.withColumn("release_decade", dates.decade_of(day))


def derive_season(df: DataFrame, month: str = "month") -> DataFrame:
    return df.withColumn("season", dates.season_of(month))


def clean_features(df: DataFrame, null_as_low: bool = False) -> DataFrame:
    """Track × artist rows with clamped features, mood and decade."""
    return (
        df.dropna(subset=["track_id"])
        .transform(clamp_audio_features, null_as_low=null_as_low)
        .transform(assign_mood_quadrant, null_as_low)
        .transform(add_release_decade)
    )


def artist_sets(df: DataFrame, key: str = "track_id", artist: str = "artist_name") -> DataFrame:
    """Sorted distinct artists per track. Repeats are removed on the map side."""
    return df.groupBy(key).agg(F.array_sort(F.collect_set(artist)).alias("artists"))


def build_track_level_view(df: DataFrame, key: str = "track_id", artist: str = "artist_name") -> DataFrame:
    """One row per track: the attributes of its alphabetically first artist row, plus all artists.

    A single aggregation replaces the window-plus-self-join form, so the table is shuffled
    once and each task sends one row per track. Rows of the same artist are told apart by a
    content hash, which keeps the sort key narrow and the choice repeatable.
    """
    attributes = [c for c in df.columns if c not in (key, artist)]
    order = F.struct(F.col(artist).isNull(), artist, F.xxhash64(*attributes))
    return (
        df.groupBy(key)
        .agg(
            F.min_by(F.struct(*attributes), order).alias("row"),
            F.array_sort(F.collect_set(artist)).alias("artists"),
        )
        .select(key, "row.*", "artists")
    )


def manual_entries(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Typed-in rows (artist, title, region, chart, rank, date, optional streams) as raw chart rows."""
    artist, title = F.col("artist").cast("string"), F.col("title").cast("string")
    url = F.concat(F.lit(text.TRACK_URL_PREFIX), text.surrogate_track_id(artist, title))
    streams = numbers.whole_number(F.col("streams").cast("string"), "bigint")
    return df.select(
        *keep,
        title.alias("title"),
        numbers.whole_number(F.col("rank").cast("string"), "int").cast("string").alias("rank"),
        F.col("date").cast("string").alias("date"),
        artist.alias("artist"),
        url.alias("url"),
        F.col("region").cast("string").alias("region"),
        F.col("chart").cast("string").alias("chart"),
        F.lit(text.MANUAL_TREND).alias("trend"),
        # zero counts as "not given", like an empty field
        F.coalesce(F.nullif(streams, F.lit(0)).cast("string"), F.lit("")).alias("streams"),
    )


# Fields every typed-in entry must carry.
REQUIRED_ENTRY_FIELDS = ("artist", "chart", "date", "rank", "region", "title")
OPTIONAL_ENTRY_FIELDS = ("streams",)


def parse_bulk_entries(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Explode a JSON array of entries and name the fields each one lacks.

    Adds `entry` (1-based position), the entry's fields and `error`, which is null for a
    valid entry. A payload that is not a JSON array of objects yields one error row.
    """
    fields = REQUIRED_ENTRY_FIELDS + OPTIONAL_ENTRY_FIELDS
    # elements are kept as text first, so one malformed entry cannot blank out its neighbours
    elements = F.from_json(payload, "array<string>")
    is_array = F.trim(F.col(payload)).startswith("[") & elements.isNotNull()
    exploded = df.withColumn("_ok", F.coalesce(is_array, F.lit(False))).select(
        *[c for c in df.columns if c != payload],
        "_ok",
        F.posexplode_outer(F.when(F.col("_ok"), elements)).alias("_at", "_text"),
    )
    parsed = exploded.withColumn("_row", F.from_json("_text", ", ".join(f"{f} string" for f in fields)))
    is_object = F.trim("_text").startswith("{")
    # a field counts as present when its key is there, whatever its value
    keys = F.coalesce(F.json_object_keys("_text"), F.array().cast("array<string>"))
    missing = F.array_except(F.array(*[F.lit(f) for f in REQUIRED_ENTRY_FIELDS]), keys)
    error = (
        F.when(~F.col("_ok"), "payload is not a JSON array")
        .when(F.col("_at").isNull(), "payload has no entries")
        .when(F.coalesce(~is_object, F.lit(True)), "entry is not an object")
        .when(F.size(missing) > 0, F.concat(F.lit("missing: "), F.array_join(missing, ", ")))
    )
    return parsed.select(
        *[c for c in df.columns if c != payload],
        (F.col("_at") + 1).alias("entry"),
        *[F.col(f"_row.{f}").alias(f) for f in fields],
        error.alias("error"),
    )


def split_valid(df: DataFrame, error: str = "error") -> tuple[DataFrame, DataFrame]:
    """Accepted rows and quarantined rows."""
    return df.where(F.col(error).isNull()).drop(error), df.where(F.col(error).isNotNull())


def credited_artists(df: DataFrame, artist: str = "artist", name: str = "credited") -> DataFrame:
    """One row per artist named in a multi-artist field."""
    return df.withColumn(name, F.explode(text.split_credits(artist)))

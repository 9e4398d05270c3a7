"""The batch tables, layer by layer: bronze from the raw sources, silver, gold.

Run with `python -m chartloom.medallion <root>`; RUN_BRONZE, RUN_SILVER and RUN_GOLD switch layers off, RUN_INCREMENT=true
the increment on.
"""

import os
import sys
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartloom import schemas
from chartloom.functions import dates
from chartloom.operators import cleaning, enrich
from chartloom.operators.quality import Expectation, enforce
from chartloom.plans import artists, longevity, mood, streaks, tiers
from chartloom.registry import DATASETS, Lake
from chartloom.session import get_spark
from chartloom.sinks.batches import batch_table
from chartloom.sinks.staging import stage
from chartloom.sinks.tables import ensure_table, new_rows, replace_partitions, stamp_ingestion, write_table
from chartloom.sources.files import read_raw, read_stored, read_table


def _write(df: DataFrame, lake: Lake, key: str, **kwargs) -> dict[str, int]:
    return write_table(df, lake.path(key), lake.fmt, DATASETS[key].partition_by, **kwargs)


# --- bronze ------------------------------------------------------------------
# Rows go from the scan straight to the writer: the input splits already size the files, and
# daily files arrive in date order, so a split holds one or two years.

def ingest_charts(spark: SparkSession, lake: Lake, multi_line: bool = False) -> dict[str, int]:
    """One scan of the CSV: rows and malformed lines are counted by the write itself."""
    raw = read_raw(spark, lake, "raw.charts.csv", multi_line=multi_line)
    bronze = stamp_ingestion(raw).withColumn("year", F.year(dates.parse_date("date")))
    corrupt = F.count_if(F.col(schemas.CORRUPT_COLUMN).isNotNull())
    return _write(bronze, lake, "bronze.charts", counters={"corrupt_rows": corrupt}, sized=False)


def ingest_features(spark: SparkSession, lake: Lake) -> dict[str, int]:
    raw = read_raw(spark, lake, "raw.track_features.parquet")
    return _write(stamp_ingestion(raw), lake, "bronze.track_features", sized=False)


def ingest_countries(spark: SparkSession, lake: Lake) -> dict[str, int]:
    raw = read_raw(spark, lake, "raw.countries.csv", corrupt_column=None)
    return _write(stamp_ingestion(raw), lake, "bronze.countries")


# --- silver ------------------------------------------------------------------

def build_silver_charts(spark: SparkSession, lake: Lake, keys: list[str] = cleaning.ENTRY_KEY) -> dict[str, int]:
    bronze = read_table(spark, lake, "bronze.charts").drop("year")
    return _write(cleaning.transform_charts(bronze, keys), lake, "silver.charts_cleaned")


def build_silver_features(spark: SparkSession, lake: Lake, null_as_low: bool = False) -> dict[str, int]:
    """Track × artist rows first; the track view is then built from the written table."""
    bronze = read_table(spark, lake, "bronze.track_features")
    per_artist = _write(
        cleaning.clean_features(bronze, null_as_low), lake, "silver.tracks_cleaned_track_artist", sized=False
    )
    written = read_table(spark, lake, "silver.tracks_cleaned_track_artist")
    # already partitioned on the track, which adaptive execution has sized
    per_track = _write(
        cleaning.build_track_level_view(written), lake, "silver.tracks_cleaned", sized=False
    )
    return {"rows": per_track["rows"], "track_artist_rows": per_artist["rows"]}


def build_silver_countries(spark: SparkSession, lake: Lake) -> dict[str, int]:
    return _write(
        cleaning.clean_countries(read_table(spark, lake, "bronze.countries")), lake, "silver.countries"
    )


def build_tracks_charted(spark: SparkSession, lake: Lake) -> dict[str, int]:
    charts = read_table(spark, lake, "silver.charts_cleaned")
    tracks = read_table(spark, lake, "silver.tracks_cleaned")
    return _write(enrich.charted_tracks(charts, tracks), lake, "silver.tracks_charted")


def build_charts_enriched(spark: SparkSession, lake: Lake, split_hot: bool = False) -> dict[str, int]:
    enriched = enrich.enrich_charts(
        read_table(spark, lake, "silver.charts_cleaned"),
        read_table(spark, lake, "silver.tracks_charted"),
        read_table(spark, lake, "silver.countries"),
        split_hot,
    )
    return _write(enriched, lake, "silver.charts_enriched")


def load_increment(
    spark: SparkSession, path: str, rows: DataFrame, keys: list[str], batch_id: int, fmt: str = "parquet", day: str | None = None
) -> int:
    """Insert the rows whose key the table lacks, as load `batch_id`; repeating a load changes nothing.

    For tables that are loaded in increments instead of overwritten. With a `day` among the
    keys the table is partitioned by its month as well, and only the months the increment's
    own days fall in are read for the match; they are a short list, bounded by the calendar.
    """
    fresh = fresh_rows(spark, path, rows, keys, batch_id, fmt, day)
    return replace_partitions(fresh, path, (*["month_start"] * bool(day), "batch_id"), fmt)["rows"]


def fresh_rows(
    spark: SparkSession, path: str, rows: DataFrame, keys: list[str], batch_id: int, fmt: str = "parquet", day: str | None = None
) -> DataFrame:
    """What `load_increment` would insert."""
    rest = [F.col(c).asc_nulls_last() for c in sorted(rows.columns) if c not in keys]
    target_of = F.col("batch_id") != batch_id
    if day:
        rows = rows.withColumn("month_start", dates.month_start(day))
        months = [r[0] for r in rows.select("month_start").distinct().collect()]
        target_of = F.col("month_start").isin([m for m in months if m is not None]) & target_of
        if None in months:
            target_of = target_of | (F.col("month_start").isNull() & (F.col("batch_id") != batch_id))
    schema = T.StructType([*rows.schema.fields, T.StructField("batch_id", T.LongType())])
    ensure_table(spark, path, schema, (*["month_start"] * bool(day), "batch_id"), fmt)
    target = read_stored(spark, path, schema, fmt).where(target_of)
    return new_rows(rows, target, keys, rest).withColumn("batch_id", F.lit(batch_id).cast("bigint"))


def load_charts(spark: SparkSession, lake: Lake) -> dict[str, int]:
    """The chart rows ingested since the last load, cleaned and inserted where their key is new.

    The table's own list remembers up to which ingestion time it has everything, so a repeated
    run finds nothing to do. Months the increment does not touch are not read.
    """
    table = batch_table(spark, lake, "silver.charts_loaded")
    table.create()
    live = table.live()
    raw, since = read_table(spark, lake, "bronze.charts"), live.note.get("until")
    if since is not None:
        raw = raw.where(F.col("ingestion_ts") > F.lit(since).cast("timestamp"))
    until = raw.agg(F.max("ingestion_ts").cast("string").alias("until")).first()["until"]
    if until is None:
        return {"rows": 0}
    cleaned = stage(cleaning.transform_charts(raw.drop("year")).withColumn("month_start", dates.month_start("chart_date")), "increment")
    months = [str(r[0]) for r in cleaned.select("month_start").distinct().collect()]
    columns = [f.name for f in table.schema.fields]
    rest = [F.col(c).asc_nulls_last() for c in sorted(cleaned.columns) if c not in cleaning.ENTRY_KEY]
    fresh = new_rows(cleaned, table.read(months), cleaning.ENTRY_KEY, rest)
    seen = table.add(fresh.withColumn("batch_id", F.lit(live.batch + 1).cast("bigint")).select(*columns), live.batch + 1, sized=True, note={"until": until})
    table.fold()
    return {"rows": seen["rows"]}


# --- gold --------------------------------------------------------------------

def _gold(plan, needs_tracks: bool = True, order: str | None = None):
    """A mart; with an `order`, for marts of a few rows, it is stored as one file in that order."""
    def build(spark: SparkSession, lake: Lake, key: str) -> dict[str, int]:
        inputs = [read_table(spark, lake, "silver.charts_enriched")]
        if needs_tracks:
            inputs.append(read_table(spark, lake, "silver.tracks_charted"))
        mart = plan(*inputs)
        if order:
            return _write(mart.repartition(1).sortWithinPartitions(order), lake, key, sized=False)
        return _write(mart, lake, key)
    return build


# --- layers ------------------------------------------------------------------

BRONZE = {
    "bronze.charts": ingest_charts,
    "bronze.track_features": ingest_features,
    "bronze.countries": ingest_countries,
}
SILVER = {
    "silver.charts_cleaned": build_silver_charts,
    "silver.tracks_cleaned": build_silver_features,
    "silver.countries": build_silver_countries,
    "silver.tracks_charted": build_tracks_charted,
    "silver.charts_enriched": build_charts_enriched,
}

GOLD = {
    "gold.regional_mood_seasonal": _gold(mood.build_regional_mood_seasonal, needs_tracks=False),
    "gold.streak_analysis": _gold(streaks.build_streak_analysis, needs_tracks=False),
    "gold.sonic_dna_by_rank_tier": _gold(tiers.build_sonic_dna, order="stream_decile"),
    "gold.track_longevity": _gold(longevity.build_track_longevity),
    "gold.global_top_artists": _gold(artists.build_top_artists),
}


def run(
    spark: SparkSession, lake: Lake,
    layers: tuple[str, ...] = ("bronze", "silver", "gold"),
    expectations: dict[str, list[Expectation]] | None = None,
) -> dict[str, dict]:
    """Build the layers in order; returns the counts and seconds of every table.

    The layer `increment`, which is not among the default ones, brings the chart rows ingested
    since its last run into a table that only grows.

    `expectations` are checked on a table right after it is written, before anything reads it.
    """
    report: dict[str, dict] = {}

    def timed(key: str, build) -> None:
        started = time.perf_counter()
        counts = build()
        report[key] = {**counts, "seconds": round(time.perf_counter() - started, 2)}
        if expectations and key in expectations:
            enforce(read_table(spark, lake, key), key, expectations[key])

    for layer, builders in (("bronze", BRONZE), ("silver", SILVER)):
        if layer in layers:
            for key, builder in builders.items():
                timed(key, lambda: builder(spark, lake))
    if "increment" in layers:
        timed("silver.charts_loaded", lambda: load_charts(spark, lake))
    if "gold" in layers:
        for key, builder in GOLD.items():
            timed(key, lambda: builder(spark, lake, key))
    return report


def main() -> None:
    wanted = tuple(
        layer for layer in ("bronze", "silver", "increment", "gold")
        if os.getenv(f"RUN_{layer.upper()}", "false" if layer == "increment" else "true").lower() == "true"
    )
    root = sys.argv[1] if len(sys.argv) > 1 else os.environ["DATA_ROOT"]
    spark = get_spark()
    try:
        for key, counts in run(spark, Lake(root, os.getenv("LAKE_FORMAT", "parquet")), wanted).items():
            print(key, counts)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()

"""Names, layout and schemas of every table, and where they live.

`Lake` is the single place that knows paths and the storage format. Parquet is the
default; with `Lake(root, fmt="delta")` the tables of the batch layers go through the Delta
connector where it is installed, those of the feed stay Parquet.
"""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from chartloom import schemas


@dataclass(frozen=True)
class Dataset:
    layer: str
    name: str
    partition_by: tuple[str, ...] = ()
    schema: T.StructType | None = None
    source_format: str | None = None  # raw files only; tables use the lake's format
    about: str = ""
    snapshots: bool = False  # every batch writes the whole content anew, under its batch id
    by_batch: bool = False  # written by micro-batches, see `sinks/batches.py`; always Parquet
    folded_by: str | None = None  # of such a table, the column whose values are kept apart


# Table names, layers and partition columns of the published data model.
DATASETS = {
    f"{d.layer}.{d.name}": d
    for d in [
        Dataset("raw", "charts.csv", schema=schemas.CHARTS_RAW_SCHEMA, source_format="csv",
                about="daily chart entries as scraped, all strings"),
        Dataset("raw", "track_features.parquet", schema=schemas.TRACK_FEATURES_RAW_SCHEMA,
                source_format="parquet", about="one row per track and credited artist"),
        Dataset("raw", "countries.csv", schema=schemas.COUNTRIES_RAW_SCHEMA, source_format="csv",
                about="country dimension"),
        Dataset("bronze", "charts", ("year",), about="raw chart rows, ingestion time, malformed lines"),
        Dataset("bronze", "track_features", about="raw features and ingestion time"),
        Dataset("bronze", "countries", about="raw countries and ingestion time"),
        Dataset("bronze", "charts_streaming", (), schemas.FEED_BRONZE_SCHEMA,
                about="feed messages by micro-batch", by_batch=True),
        Dataset("silver", "charts_cleaned", ("region", "year"), about="typed, deduplicated entries"),
        Dataset("silver", "charts_loaded", ("month_start",), schemas.FEED_SILVER_SCHEMA,
                about="cleaned entries loaded in increments", by_batch=True, folded_by="month_start"),
        Dataset("silver", "tracks_cleaned", about="one row per track with its artists"),
        Dataset("silver", "tracks_cleaned_track_artist", about="one row per track and artist"),
        Dataset("silver", "tracks_charted", about="the tracks that occur in the charts; joins read these"),
        Dataset("silver", "countries", about="trimmed country dimension"),
        Dataset("silver", "charts_enriched", ("region", "year"), about="entries with features and country"),
        Dataset("silver", "charts_streaming", ("month_start",), schemas.FEED_SILVER_SCHEMA,
                about="upserted feed entries", by_batch=True, folded_by="month_start"),
        Dataset("silver", "batch_ledger", (), schemas.BATCH_LEDGER_SCHEMA,
                about="micro-batches whose cleaning failed, and what became of them", by_batch=True),
        Dataset("gold", "regional_mood_seasonal", about="mood shares by region and season"),
        Dataset("gold", "streak_analysis", about="consecutive days at the top"),
        Dataset("gold", "sonic_dna_by_rank_tier", about="feature profile per stream decile"),
        Dataset("gold", "track_longevity", about="chart life per track and region"),
        Dataset("gold", "global_top_artists", about="monthly artist leaderboard"),
        Dataset("gold", "top_artists_partials", ("month_start",), schemas.ARTIST_PARTIALS_SCHEMA,
                about="per-batch artist totals the streaming leaderboard is summed from", by_batch=True, folded_by="month_start"),
        Dataset("gold", "top_artists_streaming", ("month_start",), schemas.ARTIST_TOTALS_SCHEMA,
                about="artist totals of the feed", by_batch=True, folded_by="month_start"),
        Dataset("gold", "recent_submissions", (), schemas.RECENT_SCHEMA,
                about="newest 100 feed entries after each batch", snapshots=True, by_batch=True),
        Dataset("gold", "batch_metrics", (), schemas.BATCH_METRICS_SCHEMA,
                about="one record per micro-batch", by_batch=True),
    ]
}


@dataclass(frozen=True)
class Lake:
    root: str
    fmt: str = "parquet"

    def path(self, key: str) -> str:
        dataset = DATASETS[key]
        return f"{self.root.rstrip('/')}/{dataset.layer}/{dataset.name}"

    def checkpoint(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/checkpoints/{name}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Ask the path's own file system; nothing is listed or read."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def table_exists(spark: SparkSession, lake: Lake, key: str) -> bool:
    return path_exists(spark, lake.path(key))


def available_tables(spark: SparkSession, lake: Lake, layer: str = "gold") -> list[str]:
    """Names of the tables of `layer` that have been written."""
    return [
        d.name for key, d in DATASETS.items()
        if d.layer == layer and table_exists(spark, lake, key)
    ]


def register_views(spark: SparkSession, lake: Lake) -> list[str]:
    """Expose every written table as a temp view named `<layer>_<table>`."""
    from chartloom.sources.files import read_table  # which itself needs this module

    names = []
    for key, d in DATASETS.items():
        if d.layer != "raw" and table_exists(spark, lake, key):
            view = f"{d.layer}_{d.name}"
            read_table(spark, lake, key).createOrReplaceTempView(view)
            names.append(view)
    return names


def describe(spark: SparkSession) -> DataFrame:
    """The registry itself as a table."""
    rows = [
        (d.layer, d.name, ",".join(d.partition_by), d.source_format or "table", d.about)
        for d in DATASETS.values()
    ]
    return spark.createDataFrame(
        rows, "layer string, name string, partition_by string, format string, about string"
    )

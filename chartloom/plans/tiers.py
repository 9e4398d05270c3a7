"""Audio profile of tracks by decile of total streams."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartloom import schemas
from chartloom.operators.positions import with_ntile
from chartloom.operators.windows import lagged, lagged_days, per_day

GOLD_TABLE = "sonic_dna_by_rank_tier"
CHART = "top200"


def track_totals(charts: DataFrame, per_title: bool = False) -> DataFrame:
    """Peak rank, chart days and streams per track.

    Rows are first combined per (track, title, artist) with fixed-width buffers, which
    hash-aggregates; the title kept for a track is picked on that much smaller frame.
    `per_title` stops there and lists a retitled track once per spelling.
    """
    by_title = charts.groupBy("track_id", "title", "artist").agg(
        F.min("rank").alias("peak_rank"),
        F.count(F.lit(1)).alias("total_chart_days"),
        F.sum("streams").alias("total_streams"),
        F.max("chart_date").alias("_last"),
    )
    if per_title:
        return by_title.drop("_last")
    newest = F.struct("_last", "title", "artist")
    return by_title.groupBy("track_id").agg(
        F.max_by(F.struct("title", "artist"), newest).alias("_name"),
        F.min("peak_rank").alias("peak_rank"),
        F.sum("total_chart_days").alias("total_chart_days"),
        F.sum("total_streams").alias("total_streams"),
    ).select(
        "track_id", "_name.title", "_name.artist", "peak_rank", "total_chart_days", "total_streams"
    )


def stream_deciles(totals: DataFrame, tiles: int = 10) -> DataFrame:
    """Tracks with their decile by total streams, 1 being the most streamed."""
    order = [F.col("total_streams").desc_nulls_last(), F.col("track_id").asc()]
    return with_ntile(totals, tiles, order, "stream_decile")


def rank_trajectory(charts: DataFrame, back: int = 7, exact_days: bool = False) -> DataFrame:
    """Mean rank change per track against `back` entries (or exactly `back` days) earlier.

    A track's entry of a day in a region is its best rank of that day.
    """
    days = per_day(charts, ["track_id", "region"], "chart_date", [F.min("rank").alias("rank")])
    step = lagged_days if exact_days else lagged
    moved = step(days, ["track_id", "region"], "rank", back)
    return moved.groupBy("track_id").agg(
        F.avg(F.col("rank") - F.col("prev_rank")).alias("avg_rank_delta_7d"),
        F.count("prev_rank").alias("compared_entries"),
    )


def tier_profile(
    tiers: DataFrame, tracks: DataFrame, trajectory: DataFrame,
    features: Sequence[str] = schemas.PROFILE_FEATURES,
) -> DataFrame:
    """Mean and sample deviation of every feature per decile.

    All three inputs have one row per track, so the joins share one shuffle key and no
    key repeats.
    """
    joined = (
        tiers.join(tracks.select("track_id", *features), "track_id", "left")
        .join(trajectory.select("track_id", "avg_rank_delta_7d"), "track_id", "left")
    )
    moments = [
        m for f in features
        for m in (F.avg(f).alias(f"mean_{f}"), F.stddev_samp(f).alias(f"std_{f}"))
    ]
    return joined.groupBy("stream_decile").agg(
        F.count(F.lit(1)).alias("track_count"),
        F.avg("peak_rank").alias("avg_peak_rank"),
        F.avg("total_chart_days").alias("avg_chart_days"),
        F.avg("avg_rank_delta_7d").alias("avg_rank_delta_7d"),
        *moments,
    )


def build_sonic_dna(
    enriched: DataFrame, tracks: DataFrame, tiles: int = 10,
    features: Sequence[str] = schemas.PROFILE_FEATURES,
) -> DataFrame:
    charts = enriched.where(F.col("chart") == CHART)
    return tier_profile(
        stream_deciles(track_totals(charts), tiles), tracks, rank_trajectory(charts), features
    )

"""Seasonal mood shares by region."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartloom.functions import audio, dates
from chartloom.operators.enrich import per_capita
from chartloom.operators.windows import share_of_total

GOLD_TABLE = "regional_mood_seasonal"
GRAIN = ["region", "continent", "year", "season", "mood_quadrant"]


def build_regional_mood_seasonal(enriched: DataFrame) -> DataFrame:
    """Streams, tracks and entries per region, season and mood, with the mood's share.

    The distinct count is expanded by the optimiser into a (grain, track) aggregation with
    map-side combine, so a region with a third of the entries is spread over its tracks.
    """
    grouped = (
        enriched.withColumn("season", dates.season_of("month"))
        .groupBy(*GRAIN)
        .agg(
            F.sum("streams").alias("total_streams"),
            F.count_distinct("track_id").alias("distinct_tracks"),
            F.count(F.lit(1)).alias("chart_entries"),
        )
    )
    return share_of_total(grouped, "total_streams", ["region", "year", "season"], "mood_share")


def mood_pivot(mart: DataFrame) -> DataFrame:
    """One row per region, year and season; one share column per mood."""
    return (
        mart.groupBy("region", "year", "season")
        .pivot("mood_quadrant", audio.MOODS)
        .agg(F.sum("mood_share"))
    )


def continent_rollup(mart: DataFrame) -> DataFrame:
    """Totals per region, per continent and overall; `level` counts the columns rolled up."""
    return (
        mart.rollup("continent", "region")
        .agg(
            F.sum("total_streams").alias("total_streams"),
            F.sum("chart_entries").alias("chart_entries"),
            F.grouping_id().alias("level"),
        )
    )


def streams_per_capita(enriched: DataFrame, per: float = 1.0) -> DataFrame:
    """Streams per inhabitant by region and year."""
    totals = enriched.groupBy("region", "year").agg(
        F.sum("streams").alias("total_streams"),
        F.max("population_2020").alias("population_2020"),
    )
    return per_capita(totals, "total_streams", "population_2020", "streams_per_capita", per)

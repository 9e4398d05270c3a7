"""Runs of consecutive days at the top of a chart."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartloom.operators.windows import islands, islands_by_gap, per_day

GOLD_TABLE = "streak_analysis"
KEYS = ["track_id", "region"]


def _top_days(charts: DataFrame, max_rank: int, keys: list[str]) -> DataFrame:
    """One row per key and day on which the key ranked within `max_rank`.

    Two rows on one day (two charts, two ranks) count as one day.
    """
    attributes = [c for c in ("title", "artist") if c in charts.columns and c not in keys]
    return per_day(
        charts.where(F.col("rank") <= max_rank).select(
            *keys, *attributes, "chart_date", "streams"
        ),
        keys + attributes, "chart_date",
        [F.sum("streams").alias("streams"), F.count(F.lit(1)).alias("entries")],
    )


def _one_row_per_day(days: DataFrame, keys: list[str]) -> DataFrame:
    """Merge rows of a day that differ only in attributes (a retitled track).

    Partitioned on the keys alone, which the island window and the roll-up then reuse.
    """
    attributes = [c for c in ("title", "artist") if c in days.columns and c not in keys]
    if not attributes:
        return days
    return days.repartition(*keys).groupBy(*keys, "chart_date").agg(
        F.sum("streams").alias("streams"),
        *[F.max(c).alias(c) for c in attributes],
    )


def _roll_up(labelled: DataFrame, keys: list[str], island: str) -> DataFrame:
    attributes = [c for c in ("title", "artist") if c in labelled.columns and c not in keys]
    return labelled.groupBy(*keys, island).agg(
        *[F.max_by(c, "chart_date").alias(c) for c in attributes],
        F.min("chart_date").alias("streak_start"),
        F.max("chart_date").alias("streak_end"),
        F.count(F.lit(1)).alias("streak_days"),
        F.sum("streams").alias("streak_total_streams"),
    )


def build_streak_analysis(charts: DataFrame, max_rank: int = 1, keys: list[str] = KEYS) -> DataFrame:
    """One row per streak: its key, start, end, length in days and streams.

    A retitled track is one streak under its newest title; put `title` and `artist` into
    `keys` to report every spelling as a streak of its own.
    """
    days = _one_row_per_day(_top_days(charts, max_rank, keys), keys)
    return _roll_up(islands(days, keys), keys, "streak_group")


def streaks_by_gap(charts: DataFrame, max_rank: int = 1, keys: list[str] = KEYS) -> DataFrame:
    """The same streaks, numbered within their key by counting date gaps."""
    days = _one_row_per_day(_top_days(charts, max_rank, keys), keys)
    return _roll_up(islands_by_gap(days, keys), keys, "island")

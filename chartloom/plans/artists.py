"""Artist leaderboards, rolling popularity and mean sound."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartloom import schemas
from chartloom.functions import dates
from chartloom.operators.positions import group_medians
from chartloom.operators.shaping import top_per_group
from chartloom.operators.windows import per_day, rolling, running
from chartloom.sinks.staging import stage

GOLD_TABLE = "global_top_artists"
CHART = "top200"
PROFILE = [*schemas.BOUNDED_AUDIO_FEATURES, "tempo"]


def artist_days(charts: DataFrame) -> DataFrame:
    """Streams and entries per artist and day."""
    return per_day(charts, ["artist"], "chart_date", [
        F.sum("streams").alias("streams"), F.count(F.lit(1)).alias("entries"),
    ])


def rolling_streams(days: DataFrame, days_back: int = 90) -> DataFrame:
    """Adds the artist's streams of the day and the `days_back` days before it."""
    return days.withColumn(
        f"rolling_{days_back}d_streams", F.sum("streams").over(rolling(["artist"], days_back))
    )


def cumulative_streams(days: DataFrame) -> DataFrame:
    """Adds the artist's streams since its first day."""
    return days.withColumn("cumulative_streams", F.sum("streams").over(running(["artist"], "chart_date")))


def artist_track_days(charts: DataFrame) -> DataFrame:
    """Streams and entries per artist, track and day: the finest grain the leaderboard needs, one row for all regions."""
    return charts.groupBy("artist", "chart_date", "track_id").agg(
        F.sum("streams").alias("streams"), F.count(F.lit(1)).alias("entries"))


def artist_months(charts: DataFrame, days_back: int = 90, per_entry: bool = True) -> DataFrame:
    """Monthly streams, tracks, entries and mean rolling streams per artist; see `months_of`."""
    return months_of(artist_days(charts), charts, days_back, per_entry)


def months_of(days: DataFrame, tracked: DataFrame, days_back: int = 90, per_entry: bool = True) -> DataFrame:
    """The same from artist days and from any rows that name artist, day and track.

    The mean of the rolling sum weighs a day by its entries (`per_entry`), as if it were
    taken over chart rows, or counts each day once. The rolling frame runs over artist
    days, never over raw rows. Distinct tracks come from a second, map-side-combined
    aggregation, so no artist's tracks meet in one task.
    """
    rolled = f"rolling_{days_back}d_streams"
    weight = F.col("entries") if per_entry else F.lit(1)
    known = F.when(F.col(rolled).isNotNull(), weight)
    monthly = (
        rolling_streams(days, days_back)
        .groupBy("artist", dates.month_start("chart_date").alias("month_start"))
        .agg(
            F.sum("streams").alias("monthly_streams"),
            F.sum("entries").alias("chart_entries"),
            F.try_divide(F.sum(F.col(rolled) * weight).cast("double"), F.sum(known)).alias(
                f"avg_{rolled}"
            ),
        )
    )
    tracks = (
        tracked.groupBy("artist", dates.month_start("chart_date").alias("month_start"))
        .agg(F.count_distinct("track_id").alias("distinct_tracks"))
    )
    monthly, tracks = monthly.alias("m"), tracks.alias("t")
    same = F.col("m.artist").eqNullSafe(F.col("t.artist")) & (F.col("m.month_start") == F.col("t.month_start"))
    return monthly.join(tracks, same, "inner").select("m.*", "distinct_tracks")


def monthly_leaderboard(months: DataFrame, top: int = 100) -> DataFrame:
    """The artists ranked within the first `top` of each month; equal totals share a rank."""
    return top_per_group(
        months, ["month_start"], top, [F.col("monthly_streams").desc_nulls_last()],
        dense=True, name="monthly_rank",
    )


def artist_profiles(charts: DataFrame, tracks: DataFrame, features: Sequence[str] = PROFILE) -> DataFrame:
    """Mean features over each artist's distinct tracks."""
    pairs = charts.select("artist", "track_id").distinct()
    return (
        pairs.join(tracks.select("track_id", *features), "track_id", "left")
        .groupBy("artist").agg(*[F.avg(f).alias(f"avg_{f}") for f in features])
    )


def artist_median_profiles(charts: DataFrame, tracks: DataFrame, features: Sequence[str] = PROFILE) -> DataFrame:
    """Exact median features over each artist's distinct tracks, in long form."""
    pairs = charts.select("artist", "track_id").distinct()
    long = (
        pairs.join(tracks.select("track_id", *features), "track_id", "left")
        .unpivot("artist", list(features), "feature", "value")
    )
    return group_medians(long, ["artist", "feature"], "value")


def build_top_artists(enriched: DataFrame, tracks: DataFrame, top: int = 100) -> DataFrame:
    """One scan of the charts: days, months and artist-track pairs are taken from the stored finest grain.

    Profiles are made of the board's own artists only.
    """
    grain = stage(artist_track_days(enriched.where(F.col("chart") == CHART)), "artist-track-days")
    days = grain.groupBy("artist", "chart_date").agg(F.sum("streams").alias("streams"), F.sum("entries").alias("entries"))
    board = stage(monthly_leaderboard(months_of(days, grain), top), "leaderboard")
    theirs = grain.join(board.select("artist").distinct(), "artist", "left_semi")
    return board.join(artist_profiles(theirs, tracks), "artist", "left")


def collaboration_profile(track_artists: DataFrame, track: str = "track_id", artist: str = "artist_name") -> DataFrame:
    """Per artist: tracks, tracks shared with others, and co-credits over them.

    Works from the number of artists per track, so no artist pairs are formed.
    """
    credits = track_artists.select(track, artist).distinct()
    sizes = credits.groupBy(track).agg(F.count(F.lit(1)).alias("_artists"))
    others = F.col("_artists") - 1
    return credits.join(sizes, track, "inner").groupBy(artist).agg(
        F.count(F.lit(1)).alias("tracks"),
        F.count_if(others > 0).alias("shared_tracks"),
        F.sum(others).alias("co_credits"),
        F.max(others).alias("most_partners_on_a_track"),
    )


def collaborators_of(track_artists: DataFrame, name: str, track: str = "track_id", artist: str = "artist_name") -> DataFrame:
    """Everyone credited on a track with artist `name`, and on how many tracks.

    Linear in the credits: the artist's tracks select the other credits through a semi join.
    """
    credits = track_artists.select(track, artist).distinct()
    theirs = credits.where(F.col(artist) == name).select(track)
    return (
        credits.where(F.col(artist) != name).join(theirs, track, "left_semi")
        .groupBy(F.col(artist).alias("partner")).agg(F.count(F.lit(1)).alias("shared_tracks"))
    )

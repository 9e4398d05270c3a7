"""Serving queries: small answers computed from the marts.

Each takes a mart and returns the few rows a report shows. Filters and projections come
first so they reach the scan of the stored mart; every limited list has a total order.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartloom import schemas
from chartloom.functions import audio, dates, text
from chartloom.operators.shaping import keep_latest, top_k, top_per_group

GLOBAL = "Global"
# The features of an artist's fingerprint, in display order.
FINGERPRINT = ["energy", "danceability", "valence", "acousticness", "speechiness"]
ERA_FEATURES = ["energy", "valence", "danceability", "acousticness"]


# --- mood mart ---------------------------------------------------------------

def kpi_year(mart: DataFrame, year: int) -> DataFrame:
    """Total streams, leading region, leading mood and number of regions of a year.

    One pass totals the year by region and by mood; the leaders are picked from those few rows,
    alphabetically among equals.
    """
    totals = (
        mart.where(F.col("year") == year)
        .groupingSets([["region"], ["mood_quadrant"]], "region", "mood_quadrant")
        .agg(F.sum("total_streams").alias("streams"), F.grouping("region").alias("by_mood"))
    )
    by_region = F.col("by_mood") == 0

    def leader(name: str, among: Column) -> Column:
        order = F.struct(-F.coalesce("streams", F.lit(-1)), name)
        return F.min_by(name, F.when(among & F.col(name).isNotNull(), order))

    return totals.agg(
        F.sum(F.when(by_region, F.col("streams"))).alias("total_streams"),
        leader("region", by_region).alias("top_region"),
        F.count_if(by_region & F.col("region").isNotNull()).alias("regions"),
        leader("mood_quadrant", ~by_region).alias("top_mood"),
    )


def dominant_mood(mart: DataFrame, year: int, season: str) -> DataFrame:
    """The mood with the largest share per region, among the named moods."""
    rows = mart.where(
        (F.col("year") == year) & (F.col("season") == season) & F.col("mood_quadrant").isin(audio.MOODS)
    )
    order = [F.col("mood_share").desc_nulls_last(), F.col("mood_quadrant"), F.col("continent")]
    return keep_latest(rows, ["region"], order).select(
        "region", "mood_quadrant", "mood_share", "total_streams"
    )


def top_moods_of_season(mart: DataFrame, year: int, season: str, k: int = 10) -> DataFrame:
    """The `k` largest shares of a season over all regions."""
    rows = mart.where((F.col("year") == year) & (F.col("season") == season))
    order = [F.col("mood_share").desc_nulls_last(), F.col("region"), F.col("mood_quadrant"), F.col("continent")]
    return top_k(rows, k, order).select("region", "mood_quadrant", "mood_share", "total_streams")


def mood_totals(mart: DataFrame, year: int) -> DataFrame:
    """Streams per known mood."""
    return (
        mart.where((F.col("year") == year) & F.col("mood_quadrant").isNotNull())
        .groupBy("mood_quadrant").agg(F.sum("total_streams").alias("total_streams"))
    )


def season_grid(mart: DataFrame, year: int) -> DataFrame:
    """Streams per season and mood with a zero where nothing was charted."""
    cells = [(season, mood) for season in dates.SEASONS for mood in audio.MOODS]

    def total(season: str, mood: str) -> Column:
        here = (F.col("season") == season) & (F.col("mood_quadrant") == mood)
        return F.coalesce(F.sum(F.when(here, F.col("total_streams"))), F.lit(0))

    wide = mart.where(F.col("year") == year).agg(*[total(*cell).alias(f"c{i}") for i, cell in enumerate(cells)])
    rows = [
        F.struct(F.lit(s).alias("season"), F.lit(m).alias("mood_quadrant"), F.col(f"c{i}").alias("total_streams"))
        for i, (s, m) in enumerate(cells)
    ]
    return wide.select(F.inline(F.array(*rows)))


def mood_tiles(mart: DataFrame, year: int) -> DataFrame:
    """Share of the year's streams and number of regions per named mood."""
    wide = mart.where(F.col("year") == year).groupBy("region").agg(
        F.sum("total_streams").alias("whole"),
        *[
            F.sum(F.when(F.col("mood_quadrant") == m, F.col("total_streams"))).alias(f"s{i}")
            for i, m in enumerate(audio.MOODS)
        ],
        *[F.count_if(F.col("mood_quadrant") == m).alias(f"n{i}") for i, m in enumerate(audio.MOODS)],
    ).agg(
        F.sum("whole").alias("whole"),
        *[F.coalesce(F.sum(f"s{i}"), F.lit(0)).alias(f"s{i}") for i in range(len(audio.MOODS))],
        *[
            F.count_if((F.col(f"n{i}") > 0) & F.col("region").isNotNull()).alias(f"n{i}")
            for i in range(len(audio.MOODS))
        ],
    )
    tiles = [
        F.struct(
            F.lit(m).alias("mood_quadrant"),
            F.coalesce(F.try_divide(F.col(f"s{i}").cast("double"), F.col("whole").cast("double")), F.lit(0.0)).alias("share"),
            F.col(f"n{i}").alias("regions"),
        )
        for i, m in enumerate(audio.MOODS)
    ]
    return wide.select(F.inline(F.array(*tiles)))


# --- streak mart -------------------------------------------------------------

def in_region(mart: DataFrame, region: str) -> DataFrame:
    """The rows of one region, or all of them for "Global"."""
    return mart if region == GLOBAL else mart.where(F.col("region") == region)


def streak_order() -> list[Column]:
    return [
        F.col("streak_days").desc(), F.col("streak_start"), F.col("track_id"), F.col("region"),
    ]


def streak_kpis(mart: DataFrame, region: str = GLOBAL) -> DataFrame:
    """Longest streak with its title, number of streaks, mean length."""
    longest = F.struct(-F.col("streak_days"), "streak_start", "track_id", "region")
    return in_region(mart, region).agg(
        F.max("streak_days").alias("longest"),
        F.substring(F.min_by("title", longest), 1, 28).alias("longest_title"),
        F.count(F.lit(1)).alias("streaks"),
        F.avg("streak_days").alias("mean_days"),
    )


def region_list(mart: DataFrame) -> DataFrame:
    return mart.select("region").dropna().distinct().orderBy("region")


def top_streaks(mart: DataFrame, region: str = GLOBAL, k: int = 20) -> DataFrame:
    """The `k` longest streaks with a short label."""
    return top_k(in_region(mart, region), k, streak_order()).select(
        text.streak_label("title", "artist").alias("label"),
        "title", "artist", "region", "streak_start", "streak_end", "streak_days",
    )


def longest_runs(mart: DataFrame, region: str, k: int = 10) -> DataFrame:
    """The tracks of a region with the longest chart life."""
    order = [F.col("chart_lifespan_days").desc(), F.col("track_id")]
    return top_k(mart.where(F.col("region") == region), k, order).select(
        "track_id", "title", "artist", "chart_lifespan_days", "peak_rank", "valence", "energy"
    )


# --- decile mart -------------------------------------------------------------

def decile_kpis(mart: DataFrame, tier: int, best: int = 1, worst: int = 10) -> DataFrame:
    """Chart days of the best and the worst decile and the momentum of the selected one."""
    def of(decile: int, column: str) -> Column:
        return F.max(F.when(F.col("stream_decile") == decile, F.col(column)))

    return mart.where(F.col("stream_decile").isin(best, worst, tier)).agg(
        of(best, "avg_chart_days").alias("hit_chart_days"),
        of(worst, "avg_chart_days").alias("tail_chart_days"),
        of(tier, "avg_rank_delta_7d").alias("rank_delta_7d"),
    )


def decile_compare(mart: DataFrame, a: int, b: int,
                   features: Sequence[str] = schemas.BOUNDED_AUDIO_FEATURES) -> DataFrame:
    """Mean features of two deciles in long form: tier, feature, value."""
    means = mart.where(F.col("stream_decile").isin(a, b)).select(
        F.concat(F.lit("Decile "), F.col("stream_decile").cast("string")).alias("tier"),
        *[F.col(f"mean_{f}").alias(f) for f in features],
    )
    return means.unpivot("tier", list(features), "feature", "value")


def decile_gradient(mart: DataFrame, feature: str) -> DataFrame:
    """Mean and deviation of one feature along the deciles."""
    return mart.select(
        "stream_decile", F.col(f"mean_{feature}").alias("mean"), F.col(f"std_{feature}").alias("std")
    ).orderBy("stream_decile")


# --- longevity mart ----------------------------------------------------------

def known_life(mart: DataFrame, feature: str) -> DataFrame:
    return mart.where(F.col(feature).isNotNull() & F.col("chart_lifespan_days").isNotNull())


def decade_means(mart: DataFrame, feature: str) -> DataFrame:
    return (
        known_life(mart, feature).where(F.col("release_decade").isNotNull())
        .groupBy("release_decade").agg(F.avg(feature).alias("mean_val"))
    )


def decade_median_life(mart: DataFrame, feature: str) -> DataFrame:
    """Exact median chart life per decade.

    The aggregate's state is a count per distinct number of days, so it is bounded by the
    calendar and merges on the map side.
    """
    return (
        known_life(mart, feature).where(F.col("release_decade").isNotNull())
        .groupBy("release_decade").agg(F.median("chart_lifespan_days").alias("median_life"))
    )


def decade_approx_life(mart: DataFrame, accuracy: int = 10_000) -> DataFrame:
    """Approximate median chart life per decade, an actual value of the group."""
    return (
        mart.where(F.col("release_decade").isNotNull())
        .groupBy("release_decade")
        .agg(F.percentile_approx("chart_lifespan_days", 0.5, accuracy).alias("median_life"))
    )


def seeded_sample(mart: DataFrame, keys: Sequence[str], size: int = 4000, seed: int = 42) -> DataFrame:
    """A repeatable sample: the `size` rows whose seeded key digest sorts first.

    Each task keeps its own `size` candidates, so nothing is sorted as a whole.
    """
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))
    return top_k(mart, size, [digest, *[F.col(k) for k in keys]])


def decade_cards(mart: DataFrame, feature: str, points: int = 30) -> DataFrame:
    """Per decade: mean feature, median life, tracks and a short series by chart life."""
    rows = known_life(mart, feature).where(F.col("release_decade").isNotNull())
    cards = rows.groupBy("release_decade").agg(
        F.avg(feature).alias("mean_val"),
        F.median("chart_lifespan_days").alias("median_life"),
        F.count_distinct("track_id").alias("tracks"),
    )
    first = top_per_group(
        rows, ["release_decade"], points,
        [F.col("chart_lifespan_days"), F.col("track_id"), F.col("region")], name="at",
    )
    # at most `points` rows per decade are left here
    series = first.groupBy("release_decade").agg(
        F.array_sort(F.collect_list(F.struct("at", F.col(feature).alias("value")))).alias("_series")
    )
    return cards.join(series, "release_decade", "left").select(
        *cards.columns, F.col("_series.value").alias("series")
    )


# --- artist mart -------------------------------------------------------------

def _of_year(mart: DataFrame, year: int) -> DataFrame:
    # a plain date range can be pushed to the scan, year(month_start) cannot
    first, after = F.make_date(F.lit(year), F.lit(1), F.lit(1)), F.make_date(F.lit(year + 1), F.lit(1), F.lit(1))
    return mart.where((F.col("month_start") >= first) & (F.col("month_start") < after))


def _leaders(rows: DataFrame, k: int) -> DataFrame:
    totals = rows.groupBy("artist").agg(F.sum("monthly_streams").alias("streams"))
    return top_k(totals, k, [F.col("streams").desc_nulls_last(), F.col("artist")])


def artist_options(mart: DataFrame, year: int, k: int = 60) -> DataFrame:
    """The artists offered for a year: its `k` most streamed."""
    return _leaders(_of_year(mart, year), k).select("artist")


def top_artists_year(mart: DataFrame, year: int, k: int = 20, max_rank: int | None = None) -> DataFrame:
    """The `k` most streamed artists of a year, optionally over top-`max_rank` months only."""
    rows = _of_year(mart, year)
    if max_rank is not None:
        rows = rows.where(F.col("monthly_rank") <= max_rank)
    return _leaders(rows, k)


def top_artist_fingerprint(mart: DataFrame, year: int, dims: Sequence[str] = FINGERPRINT) -> DataFrame:
    """The year's first artist with its streams and mean features (0 where unknown)."""
    sound = [F.coalesce(F.avg(f"avg_{d}"), F.lit(0.0)).alias(d) for d in dims]
    totals = _of_year(mart, year).groupBy("artist").agg(F.sum("monthly_streams").alias("streams"), *sound)
    return top_k(totals, 1, [F.col("streams").desc_nulls_last(), F.col("artist")])


def artist_series(mart: DataFrame, artists: Sequence[str]) -> DataFrame:
    """Mean rolling streams by month of the selected artists."""
    return (
        mart.where(F.col("artist").isin(*artists))
        .select("artist", "month_start", "avg_rolling_90d_streams")
        .orderBy("artist", "month_start")
    )


def live_top10(streaming_totals: DataFrame, k: int = 10) -> DataFrame:
    """The most streamed artists of the live feed."""
    return _leaders(streaming_totals, k)


def recent_rows(recent: DataFrame, k: int = 20) -> DataFrame:
    """The newest feed rows, formatted for display."""
    order = [F.col("ingestion_ts").desc_nulls_last()] + [
        F.col(c) for c in ("chart_date", "region", "chart", "rank", "artist", "title")
    ]
    newest = top_k(recent, k, order)
    return newest.select(
        F.date_format("ingestion_ts", "yyyy-MM-dd HH:mm:ss").alias("ingestion_ts"),
        "artist", "title", "region", "chart",
        text.or_dash(F.concat(F.lit("#"), F.col("rank").cast("string"))).alias("rank"),
        text.or_dash(F.format_number("streams", 0)).alias("streams"),
        F.date_format("chart_date", "yyyy-MM-dd").alias("chart_date"),
    )


def track_mood_counts(tracks: DataFrame) -> DataFrame:
    return tracks.groupBy("mood_quadrant").agg(F.count(F.lit(1)).alias("tracks"))

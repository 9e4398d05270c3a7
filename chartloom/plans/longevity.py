"""How long tracks stay in the charts, and what goes with it."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chartloom import schemas
from chartloom.operators.windows import per_day, rolling

GOLD_TABLE = "track_longevity"
CHART = "top200"
KEYS = ["track_id", "region"]
ATTRIBUTES = ["title", "artist", "continent", "release_decade"]
_DAY_RANGE = 10_000_000  # more days than any date needs, so rank and day pack into one number
_DAY_SHIFT = _DAY_RANGE // 2  # days before 1970 are negative


def chart_parts(charts: DataFrame, attributes: Sequence[str] = ATTRIBUTES) -> DataFrame:
    """Entries reduced per key and attributes: what `settled_life` needs, in fixed-width buffers.

    Without attributes the groups are as narrow as their keys, and the attributes can be joined
    to the reduced rows: a join that repeats entries repeats their reduced row as often, so sums
    and counts come out the same.
    """
    rank_then_day = F.col("rank").cast("bigint") * _DAY_RANGE + F.unix_date("chart_date") + _DAY_SHIFT
    return charts.groupBy(*KEYS, *attributes).agg(
        F.min("chart_date").alias("first_chart_date"),
        F.max("chart_date").alias("last_chart_date"),
        F.min("rank").alias("peak_rank"),
        F.min(rank_then_day).alias("_peak"),
        F.count(F.lit(1)).alias("total_chart_days"),
        F.sum("streams").alias("total_streams"),
        F.sum(F.col("rank").cast("bigint")).alias("_rank_sum"),
        F.count("rank").alias("_ranked"),
    )


def settled_life(
    parts: DataFrame, attributes: Sequence[str] = ATTRIBUTES, per_title: bool = False, single: bool = False
) -> DataFrame:
    """Chart life per track and region from the rows of `chart_parts`; see `chart_life`.

    `single` says that no key has several rows, so nothing is left to group.
    """
    span = {
        "first_chart_date": F.min("first_chart_date"), "last_chart_date": F.max("last_chart_date"),
        "peak_rank": F.min("peak_rank"), "_peak": F.min("_peak"),
    }
    if per_title or single:
        # `parts` holds one row per spelling, so a key's window is its number of spellings
        w = Window.partitionBy(*KEYS)
        spanned = parts if single else parts.withColumns({name: c.over(w) for name, c in span.items()})
        life = spanned.withColumns({
            "_named": F.struct(*attributes),
            "avg_rank": F.try_divide(F.col("_rank_sum").cast("double"), "_ranked"),
        })
    else:
        newest = F.struct("last_chart_date", *attributes)
        life = parts.groupBy(*KEYS).agg(
            F.max_by(F.struct(*attributes), newest).alias("_named"),
            *[c.alias(name) for name, c in span.items()],
            F.sum("total_chart_days").alias("total_chart_days"),
            F.sum("total_streams").alias("total_streams"),
            F.try_divide(F.sum("_rank_sum").cast("double"), F.sum("_ranked")).alias("avg_rank"),
        )
    return life.select(
        *KEYS, "_named.*", "first_chart_date", "last_chart_date", "peak_rank",
        F.date_from_unix_date((F.col("_peak") % _DAY_RANGE - _DAY_SHIFT).cast("int")).alias("peak_date"),
        "total_chart_days", "total_streams", "avg_rank",
        F.date_diff("last_chart_date", "first_chart_date").alias("chart_lifespan_days"),
    )


def chart_life(
    charts: DataFrame, attributes: Sequence[str] = ATTRIBUTES, per_title: bool = False
) -> DataFrame:
    """First and last day, peak rank and its day, days, streams and mean rank per track and region.

    The span is the minimum and maximum of the same grouping, so no window is needed. Raw
    rows are combined per (key, attributes) with fixed-width buffers; the attributes of a
    retitled track are settled on the reduced frame, where its latest spelling wins.
    With `per_title` every spelling keeps its own row under the span and peak of the key.
    """
    return settled_life(chart_parts(charts, attributes), attributes, per_title)


def with_features(life: DataFrame, tracks: DataFrame) -> DataFrame:
    features = [*schemas.BOUNDED_AUDIO_FEATURES, "tempo", "mood_quadrant"]
    return life.join(tracks.select("track_id", *features), "track_id", "left")


def build_track_longevity(enriched: DataFrame, tracks: DataFrame) -> DataFrame:
    """Chart life per track and region with the track's features."""
    return with_features(chart_life(enriched.where(F.col("chart") == CHART)), tracks)


def rolling_avg_rank(charts: DataFrame, days: int = 7) -> DataFrame:
    """Mean rank over the last `days` calendar days, per track, region and day.

    Days are combined first; the mean over entries is the ratio of two rolling sums.
    """
    daily = per_day(charts, KEYS, "chart_date", [
        F.sum(F.col("rank").cast("bigint")).alias("_sum"), F.count("rank").alias("_n"),
    ])
    frame = rolling(KEYS, days - 1)
    mean = F.try_divide(F.sum("_sum").over(frame).cast("double"), F.sum("_n").over(frame))
    return daily.select(*KEYS, "chart_date", mean.alias("rolling_avg_rank"))


def feature_correlation(mart: DataFrame, features: Sequence[str] = schemas.BOUNDED_AUDIO_FEATURES) -> DataFrame:
    """Pearson correlation of each feature with the chart life, and how many rows have both.

    Null with fewer than two rows or no variation.
    """
    life = F.col("chart_lifespan_days").cast("double")
    wide = mart.agg(
        *[F.corr(f, life).alias(f"r_{f}") for f in features],
        *[F.count_if(F.col(f).isNotNull() & life.isNotNull()).alias(f"n_{f}") for f in features],
    )
    rows = [
        F.struct(
            F.lit(f).alias("feature"),
            F.when((F.col(f"n_{f}") > 1) & ~F.isnan(f"r_{f}"), F.col(f"r_{f}")).alias("correlation"),
            F.col(f"n_{f}").alias("n"),
        )
        for f in features
    ]
    return wide.select(F.inline(F.array(*rows)))

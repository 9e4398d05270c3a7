"""Ordered-by-date operators: islands, lags, rolling frames, shares of a total.

All of them first reduce their input to one row per (key, day) with a map-side-combined
aggregation. A key's window then holds at most one row per calendar day, even for a key
that holds a third of the input.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def per_day(df: DataFrame, keys: list[str], day: str, aggregates: list[Column]) -> DataFrame:
    return df.groupBy(*keys, day).agg(*aggregates)


def islands(days: DataFrame, keys: list[str], day: str = "chart_date", name: str = "streak_group") -> DataFrame:
    """Label runs of consecutive days; input has one row per (keys, day).

    Within a run the date and the row number grow together, so their difference is constant.
    """
    w = Window.partitionBy(*keys).orderBy(day)
    return days.withColumn(name, F.date_sub(day, F.row_number().over(w)))


def islands_by_gap(days: DataFrame, keys: list[str], day: str = "chart_date", name: str = "island") -> DataFrame:
    """The same runs numbered 1, 2, ... by counting the gaps seen so far."""
    w = Window.partitionBy(*keys).orderBy(day)
    gap = F.date_diff(day, F.lag(day).over(w))
    opens = F.when(gap.isNull() | (gap > 1), 1).otherwise(0)
    running = w.rowsBetween(Window.unboundedPreceding, 0)
    return days.withColumn("_opens", opens).withColumn(name, F.sum("_opens").over(running)).drop("_opens")


def lagged(days: DataFrame, keys: list[str], value: str, rows: int, day: str = "chart_date",
           name: str = "prev_rank") -> DataFrame:
    """The value `rows` entries earlier (entries, not days)."""
    w = Window.partitionBy(*keys).orderBy(day)
    return days.withColumn(name, F.lag(value, rows).over(w))


def lagged_days(days: DataFrame, keys: list[str], value: str, back: int, day: str = "chart_date",
                name: str = "prev_rank") -> DataFrame:
    """The value exactly `back` days earlier, null when that day has no entry."""
    earlier = days.select(*keys, F.date_add(day, back).alias(day), F.col(value).alias(name))
    return days.join(earlier, [*keys, day], "left")


def rolling(keys: list[str], days_back: int, day: str = "chart_date"):
    """The frame of the current day and the `days_back` days before it."""
    return (
        Window.partitionBy(*keys).orderBy(F.unix_date(day)).rangeBetween(-days_back, Window.currentRow)
    )


def running(keys: list[str], day: str):
    """The frame from the first row of the key to the current day."""
    return (
        Window.partitionBy(*keys).orderBy(day)
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )


def share_of_total(df: DataFrame, value: str, within: list[str], name: str) -> DataFrame:
    """`value` as a fraction of its sum over `within`; null where that sum is zero or null.

    Meant for aggregated frames, where a group is a handful of rows.
    """
    total = F.sum(value).over(Window.partitionBy(*within))
    return df.withColumn(name, F.try_divide(F.col(value).cast("double"), total.cast("double")))

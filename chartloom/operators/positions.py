"""Exact global positions without a single-task sort.

A window without a partition key moves all rows to one task, and a window over a key that
holds a third of the rows moves that third to one task. Here rows are range-partitioned on
a total order, each partition counts its own rows, and the (few) partition counts turn
local positions into global ones. Any key is split over as many tasks as it needs.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chartloom.sinks.staging import stage

_LOCAL_BITS = 33  # monotonically_increasing_id keeps the row index in its low 33 bits


def with_positions(df: DataFrame, order: list[Column], name: str = "position", total: str | None = None) -> DataFrame:
    """Add the 1-based position of each row in `order`, which must be a total order.

    The sorted rows are staged once, so partition numbers are the same for the counting
    pass and for the result. `total` also adds the row count of the whole frame.
    """
    marked = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_id", F.monotonically_increasing_id())
        .select(
            "*",
            F.shiftright("_id", _LOCAL_BITS).alias("_part"),
            F.col("_id").bitwiseAND((1 << _LOCAL_BITS) - 1).alias("_local"),
        )
        .drop("_id")
    )
    staged = stage(marked, "positions")
    # one row per partition, so these windows and the broadcast are bounded by the partition count
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = (
        staged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
        .select(
            "_part",
            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"),
            F.sum("_n").over(everything).alias("_total"),
        )
    )
    placed = (
        staged.join(F.broadcast(offsets), "_part", "left")
        .withColumn(name, F.col("_offset") + F.col("_local") + 1)
        .drop("_part", "_local", "_offset")
    )
    return placed.withColumnRenamed("_total", total) if total else placed.drop("_total")


def tile_of(position: Column, total: Column, tiles: int) -> Column:
    """SQL `ntile`: the first `total mod tiles` tiles hold one row more than the others."""
    small = F.floor(total / F.lit(tiles))
    big_tiles = total % tiles
    in_big = big_tiles * (small + 1)
    late = F.floor(F.try_divide(position - 1 - in_big, small))
    return F.when(
        position <= in_big, F.floor((position - 1) / (small + 1)) + 1
    ).otherwise(late + big_tiles + 1).cast("int")


def with_ntile(df: DataFrame, tiles: int, order: list[Column], name: str) -> DataFrame:
    """`ntile(tiles)` over the whole frame, exact and fully distributed."""
    placed = with_positions(df, order, "_position", "_total")
    tile = tile_of(F.col("_position"), F.col("_total"), tiles)
    return placed.withColumn(name, tile).drop("_position", "_total")


def with_running_total(
    df: DataFrame, keys: list[str], by: str, amount: str, name: str, total: str | None = None
) -> DataFrame:
    """Running sum of `amount` within `keys` in `by` order; (`keys`, `by`) must be unique.

    Rows are range-partitioned on (keys, by), so a large key spans many partitions. Each
    partition sums its own stretch of a key, and stretches are offset by the sums of the
    earlier partitions of that key (at most one row per key and partition). `total` also
    adds the key's whole sum.
    """
    order = [F.col(k) for k in keys] + [F.col(by)]
    parted = df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    staged = stage(parted, "running")
    within = Window.partitionBy("_part", *keys).orderBy(by).rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    local = staged.withColumn("_run", F.sum(amount).over(within)).alias("local")
    stretches = (
        staged.groupBy(*keys, "_part").agg(F.sum(amount).alias("_sum"))
        .withColumn("_before", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)))
        .withColumn("_total", F.sum("_sum").over(Window.partitionBy(*keys)))
        .alias("stretch")
    )
    same = F.lit(True)
    for k in [*keys, "_part"]:
        same = same & F.col(f"local.{k}").eqNullSafe(F.col(f"stretch.{k}"))
    out = [F.col(f"local.{c}") for c in df.columns] + [(F.col("_run") + F.col("_before")).alias(name)]
    if total:
        out.append(F.col("_total").alias(total))
    return local.join(stretches, same, "inner").select(*out)


def group_medians(df: DataFrame, keys: list[str], value: str, name: str = "median") -> DataFrame:
    """Exact median of `value` per key, whatever share of the rows one key holds.

    Equal values are merged before the shuffle. The remaining (key, value, count) rows get
    running counts; the values whose count interval covers the middle of the key decide.
    """
    counted = (
        df.where(F.col(value).isNotNull())
        .groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    )
    placed = with_running_total(counted, keys, value, "_n", "_upto", "_all")
    low, high = F.floor((F.col("_all") + 1) / 2), F.floor((F.col("_all") + 2) / 2)
    start = F.col("_upto") - F.col("_n")
    covers_low = (start < low) & (low <= F.col("_upto"))
    covers_high = (start < high) & (high <= F.col("_upto"))
    return (
        placed.where(covers_low | covers_high)
        .groupBy(*keys)
        .agg(
            F.max(F.when(covers_low, F.col(value))).alias("_low"),
            F.max(F.when(covers_high, F.col(value))).alias("_high"),
        )
        .select(*keys, ((F.col("_low") + F.col("_high")) / 2).alias(name))
    )

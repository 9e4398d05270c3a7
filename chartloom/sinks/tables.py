"""Table writers. Each write is one pass over its input; row counts ride along with it."""

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartloom.operators.joins import not_in_target
from chartloom.operators.shaping import keep_latest
from chartloom.registry import path_exists


def stamp_ingestion(df: DataFrame, name: str = "ingestion_ts") -> DataFrame:
    return df.withColumn(name, F.current_timestamp())


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    partition_by: tuple[str, ...] = (),
    counters: dict[str, Column] | None = None,
    sized: bool = True,
) -> dict[str, int]:
    """Overwrite `path`, returning `rows` plus any named `counters` measured during the write.

    `sized` lets adaptive execution choose the output files: rows are rebalanced on the
    partition columns, small partitions merged and a partition column value that holds
    much of the data split over several files and tasks. That is a shuffle; leave it out
    where rows flow from a scan to the writer unchanged in number.
    """
    seen = Observation()
    out = df.observe(
        seen,
        F.count(F.lit(1)).alias("rows"),
        *[c.cast("bigint").alias(name) for name, c in (counters or {}).items()],
    )
    if sized:
        out = out.hint("rebalance", *partition_by)
    writer = out.write.format(fmt).mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return seen.get


def ensure_table(
    spark: SparkSession, path: str, schema: T.StructType, partition_by: tuple[str, ...] = (), fmt: str = "parquet"
) -> None:
    """Create an empty table unless something is stored at `path` already."""
    if path_exists(spark, path):
        return
    empty = spark.createDataFrame([], schema).write.format(fmt).mode("ignore")
    (empty.partitionBy(*partition_by) if partition_by else empty).save(path)


def replace_partitions(
    df: DataFrame, path: str, partition_by: tuple[str, ...], fmt: str = "parquet", sized: bool = True,
    counters: dict[str, Column] | None = None,
) -> dict:
    """Overwrite only the partitions present in `df`: repeating a write leaves one copy.

    Returns the `rows` written and any named `counters`, as `write_table` does.
    """
    seen = Observation()
    named = [c.alias(name) for name, c in (counters or {}).items()]
    out = df.observe(seen, F.count(F.lit(1)).alias("rows"), *named)
    if sized:
        out = out.hint("rebalance", *partition_by)
    (
        out.write.format(fmt).mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .save(path)
    )
    return seen.get


def new_rows(
    incoming: DataFrame, target: DataFrame | None, keys: list[str], prefer: list[Column]
) -> DataFrame:
    """Rows of `incoming` whose key is absent from `target`, one per key.

    The insert-only merge: the batch is first reduced to one row per key (the first in
    `prefer` order), then matched against the target, so neither an overlap with the
    target nor a repeat inside the batch can insert a key twice.
    """
    unique = keep_latest(incoming, keys, prefer)
    return unique if target is None else not_in_target(unique, target, keys)

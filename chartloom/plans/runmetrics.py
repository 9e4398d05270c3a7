"""Summaries over run records: micro-batches and pipeline stages."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chartloom import schemas
from chartloom.operators.positions import with_running_total


def read_batch_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.BATCH_METRICS_SCHEMA).json(path)


def read_stage_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.STAGE_METRICS_SCHEMA).json(path)


def batch_summary(batches: DataFrame) -> DataFrame:
    """Batches, rows, latency and throughput figures over all micro-batches."""
    return batches.agg(
        F.count(F.lit(1)).alias("batches"),
        F.sum("rows").alias("total_rows"),
        F.round(F.avg("rows"), 1).alias("mean_rows"),
        F.round(F.avg("processing_ms"), 1).alias("mean_ms"),
        F.round(F.max("processing_ms"), 1).alias("max_ms"),
        F.round(F.avg("throughput_rows_per_sec"), 1).alias("mean_throughput"),
        F.round(F.max("throughput_rows_per_sec"), 1).alias("peak_throughput"),
    )


def cumulative_rows(batches: DataFrame) -> DataFrame:
    """Rows ingested up to each batch; the running sum is spread over range partitions."""
    return with_running_total(
        batches.select("batch_id", "rows"), [], "batch_id", "rows", "cumulative_rows"
    )


def _mean_when(adaptive: bool) -> Column:
    return F.avg(F.when(F.col("aqe") == F.lit(adaptive), F.col("wall_sec")))


def stage_pivot(stages: DataFrame) -> DataFrame:
    """Mean wall time per stage, adaptive execution on and off side by side."""
    return (
        stages.groupBy("label").pivot("aqe", [True, False]).agg(F.avg("wall_sec"))
        .withColumnsRenamed({"true": "aqe_on", "false": "aqe_off"})
    )


def stage_summary(stages: DataFrame) -> DataFrame:
    return stages.groupBy("label", "aqe").agg(
        F.round(F.avg("wall_sec"), 1).alias("mean"),
        F.round(F.min("wall_sec"), 1).alias("min"),
        F.round(F.max("wall_sec"), 1).alias("max"),
        F.count("wall_sec").alias("runs"),
    )


def setting_gain(stages: DataFrame, label: str | None = None) -> DataFrame:
    """Wall time saved by adaptive execution per stage, in percent of the time without it."""
    rows = stages if label is None else stages.where(F.col("label") == label)
    means = rows.groupBy("label").agg(_mean_when(True).alias("aqe_on"), _mean_when(False).alias("aqe_off"))
    saved = F.try_divide((F.col("aqe_off") - F.col("aqe_on")) * 100, F.col("aqe_off"))
    return means.withColumn("gain_pct", saved)


def setting_total(stages: DataFrame) -> DataFrame:
    return stages.groupBy("aqe").agg(F.sum("wall_sec").alias("total_sec"))

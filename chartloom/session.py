"""Session builder. Cluster sizing belongs to the deployment; only behaviour is set here."""

import os

from pyspark.sql import SparkSession


def get_spark(app_name: str = "chartloom", adaptive: bool = True, extra: dict[str, str] | None = None) -> SparkSession:
    """A session with adaptive execution, UTC dates and shuffle sizes taken from the environment.

    With adaptive execution the partition count is only an upper bound: small shuffles are
    coalesced and skewed joins split at run time. `adaptive=False` exists for comparisons.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", str(adaptive).lower())
        .config("spark.sql.adaptive.skewJoin.enabled", str(adaptive).lower())
        .config("spark.sql.adaptive.coalescePartitions.enabled", str(adaptive).lower())
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128m")
        # a task that writes a few partition folders keeps their files open instead of sorting its rows
        .config("spark.sql.maxConcurrentOutputFileWriters", "8")
        .config("spark.sql.shuffle.partitions", os.getenv("SPARK_SHUFFLE_PARTITIONS", "200"))
    )
    master = os.getenv("SPARK_MASTER_URL")
    if master:
        builder = builder.master(master)
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()

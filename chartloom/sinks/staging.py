"""Staging: where intermediate results are cut off from their lineage.

Staged tables go under the folder the cluster names in `spark.checkpoint.dir`, which all
executors share, so losing an executor never loses a staged result. What was shuffled for a
table goes as soon as the table is written, not when the driver happens to collect its garbage.
"""

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def staging_root(spark: SparkSession) -> str:
    """The folder in `spark.checkpoint.dir`; where none is set, one under the session's warehouse."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_staging"
    return configured.rstrip("/")


_KNOWN: set[str] = set()  # folders of applications that this driver has asked to be removed at its end


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name in the application's own folder, which goes when the application ends."""
    own = f"{staging_root(spark)}/chartloom/{spark.sparkContext.applicationId}"
    if own not in _KNOWN:
        path = spark._jvm.org.apache.hadoop.fs.Path(own)
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)
        _KNOWN.add(own)
    return f"{own}/{name}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Queries executed inside leave no shuffle files behind; the session's own setting comes back after it."""
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREE_SHUFFLES)
        else:
            spark.conf.set(FREE_SHUFFLES, before)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once as a columnar table and return a scan of it."""
    path = staging_path(df.sparkSession, name)
    with shuffles_freed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

"""Batch scans of raw files and tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartloom import schemas
from chartloom.registry import DATASETS, Lake
from chartloom.sinks.batches import batch_table


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    multi_line: bool = False,
    corrupt_column: str | None = schemas.CORRUPT_COLUMN,
) -> DataFrame:
    """Headered CSV under a declared schema; malformed lines are kept in `corrupt_column`.

    Column pruning is switched off for this scan: a pruned parse does not look at the
    whole line, so a narrow projection would report malformed lines as clean.
    """
    reader = (
        spark.read.option("header", "true").option("encoding", "UTF-8")
        .option("multiLine", str(multi_line).lower())
        .option("quote", '"')
    )
    if corrupt_column:
        schema = schemas.with_corrupt_column(schema, corrupt_column)
        reader = (
            reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt_column)
            .option("columnPruning", "false")
        )
    return reader.schema(schema).csv(path)


def corrupt_counts(df: DataFrame, corrupt_column: str = schemas.CORRUPT_COLUMN) -> DataFrame:
    """Total and malformed row counts with their ratio, in one scan.

    `filled_rows` counts rows with a first field. It also makes the query read a data column,
    without which lines would not be parsed at all.
    """
    first_column = next(c for c in df.columns if c != corrupt_column)
    bad = F.count_if(F.col(corrupt_column).isNotNull())
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count(first_column).alias("filled_rows"),
        bad.alias("corrupt_rows"),
        F.try_divide(bad.cast("double"), F.count(F.lit(1))).alias("corrupt_ratio"),
    )


def read_parquet(spark: SparkSession, path: str | list[str], schema: T.StructType | None = None) -> DataFrame:
    """Parquet under a declared schema where one is given."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(*([path] if isinstance(path, str) else path))


def read_raw(spark: SparkSession, lake: Lake, key: str, **options) -> DataFrame:
    """One of the registered raw sources."""
    dataset = DATASETS[key]
    if dataset.source_format == "csv":
        return read_csv(spark, lake.path(key), dataset.schema, **options)
    return read_parquet(spark, lake.path(key), dataset.schema)


def read_table(spark: SparkSession, lake: Lake, key: str) -> DataFrame:
    """A registered table; partition columns come from its folders or log.

    Parquet tables with a declared schema are read under it, also while they are still empty.
    Of a table that holds a snapshot per batch, all snapshots that are kept come.
    """
    if DATASETS[key].by_batch:
        return batch_table(spark, lake, key).read()
    return read_stored(spark, lake.path(key), DATASETS[key].schema, lake.fmt)


def read_stored(spark: SparkSession, path: str, schema: T.StructType | None, fmt: str = "parquet") -> DataFrame:
    reader = spark.read.format(fmt)
    if schema is not None and fmt == "parquet":
        reader = reader.schema(schema)
    return reader.load(path)


def as_of(df: DataFrame, version: int | None, column: str = "batch_id") -> DataFrame:
    """The rows written up to and including batch `version`; all rows when it is None."""
    return df if version is None else df.where(F.col(column) <= version)


def load_gold(spark: SparkSession, lake: Lake, table: str, version: int | None = None) -> DataFrame:
    """A serving table, optionally as of an earlier version.

    Tables of the feed travel by batch. Of one that keeps every batch's rows any batch is there;
    one that is rewritten, or holds a snapshot per batch, has the versions above its low-water
    mark, and an older one raises. Other tables travel by the version numbers of Delta, or by a
    `batch_id` column if they have one.
    """
    key = f"gold.{table}"
    dataset = DATASETS[key]
    if dataset.by_batch:
        stored = batch_table(spark, lake, key)
        if dataset.snapshots:
            return stored.newest(version)
        if "batch_id" in dataset.schema.fieldNames():
            return as_of(stored.read(), version)
        return stored.read(live=stored.live(version))
    if version is None:
        return read_table(spark, lake, key)
    if lake.fmt == "delta":
        return spark.read.format("delta").option("versionAsOf", version).load(lake.path(key))
    df = read_table(spark, lake, key)
    if "batch_id" not in df.columns:
        raise ValueError(f"{key} is rewritten as a whole and keeps no earlier versions")
    return as_of(df, version)

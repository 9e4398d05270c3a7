"""The unbounded chart feed: JSON messages from Kafka or from files."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartloom import schemas

# The feed's topic and its default rate limit per trigger.
TOPIC = "charts-feed"
MAX_OFFSETS_PER_TRIGGER = 5000


def kafka_feed(
    spark: SparkSession, servers: str, topic: str = TOPIC, max_offsets: int = MAX_OFFSETS_PER_TRIGGER
) -> DataFrame:
    """Messages of a Kafka topic from its beginning; needs the Kafka connector package."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("maxOffsetsPerTrigger", str(max_offsets))
        .load()
        .select(F.col("value").cast("string").alias("value"), F.col("timestamp"))
    )


def file_stream(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", max_files: int | None = None
) -> DataFrame:
    """A folder (or one file) as a stream, at most `max_files` new files per trigger."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if files.exists(place) and files.getFileStatus(place).isFile():
        # the file source watches folders; a single file is picked out by name
        folder, _, name = path.rstrip("/").rpartition("/")
        return reader.option("pathGlobFilter", name).option("recursiveFileLookup", "true").load(folder)
    return reader.load(path)


def file_feed(spark: SparkSession, path: str, fmt: str = "text", max_files: int | None = 1) -> DataFrame:
    """Message files with one JSON object per line (text) or a `value` column (Parquet)."""
    schema = T.StructType([T.StructField("value", T.StringType())])
    return file_stream(spark, path, schema, fmt, max_files)


def parse_messages(messages: DataFrame, schema: T.StructType = schemas.CHARTS_RAW_SCHEMA,
                   value: str = "value") -> DataFrame:
    """Message text to columns; other columns are kept.

    A text that is not valid JSON parses to all nulls; rows without a title and an artist are dropped.
    """
    others = [c for c in messages.columns if c != value]
    parsed = messages.select(F.from_json(value, schema).alias("data"), *others)
    return parsed.select("data.*", *others).where(
        F.col("title").isNotNull() | F.col("artist").isNotNull()
    )

"""The registration decorator and the portable result format."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
EXPECTED: dict[str, str] = {}


def portable(df: DataFrame) -> DataFrame:
    """Result columns in types every engine prints alike.

    Integers become bigint, decimals double, doubles are rounded to six digits, dates become
    ISO text.
    """
    def convert(field: T.StructField):
        column, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, T.DateType):
            column = column.cast("string")
        elif isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)):
            column = column.cast("bigint")
        elif isinstance(kind, (T.DecimalType, T.DoubleType, T.FloatType)):
            column = F.round(column.cast("double"), 6)
        return column.alias(field.name)

    return df.select([convert(f) for f in df.schema.fields])


def query(name: str, expected: str | None = None) -> Callable[[Query], Query]:
    """Register a query and, where SQL can state it, its expected result."""
    def register(run: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        def produce(spark: SparkSession, folder: str) -> DataFrame:
            return portable(run(spark, folder))

        QUERIES[name] = produce
        if expected is not None:
            EXPECTED[name] = expected
        return run

    return register

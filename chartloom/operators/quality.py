"""Expectations over a table, all of them evaluated in one aggregation."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Expectation:
    name: str
    measure: Column  # an aggregate
    limit: float
    at_least: bool = False  # pass when measure >= limit instead of <= limit


def no_nulls(column: str) -> Expectation:
    return Expectation(f"no_nulls({column})", F.count_if(F.col(column).isNull()), 0)


def min_rows(rows: int) -> Expectation:
    return Expectation(f"min_rows({rows})", F.count(F.lit(1)), rows, at_least=True)


def column_range(column: str, low: float, high: float) -> Expectation:
    outside = (F.col(column) < low) | (F.col(column) > high)
    return Expectation(f"column_range({column}, {low}, {high})", F.count_if(outside), 0)


def quality_report(df: DataFrame, layer: str, expectations: list[Expectation]) -> DataFrame:
    """One row per expectation: layer, check, observed, passed. One scan for all of them."""
    measured = df.agg(*[e.measure.cast("bigint").alias(f"m{i}") for i, e in enumerate(expectations)])
    checks = [
        F.struct(
            F.lit(layer).alias("layer"),
            F.lit(e.name).alias("check"),
            F.col(f"m{i}").alias("observed"),
            (F.col(f"m{i}") >= e.limit if e.at_least else F.col(f"m{i}") <= e.limit).alias("passed"),
        )
        for i, e in enumerate(expectations)
    ]
    return measured.select(F.inline(F.array(*checks)))


def enforce(df: DataFrame, layer: str, expectations: list[Expectation]) -> None:
    """Raise naming every failed expectation; the report has one row per expectation."""
    failed = [r for r in quality_report(df, layer, expectations).collect() if not r.passed]
    if failed:
        details = "; ".join(f"{r.check} observed {r.observed}" for r in failed)
        raise ValueError(f"[{layer}] {details}")


def assert_no_nulls(df: DataFrame, column: str, layer: str) -> None:
    enforce(df, layer, [no_nulls(column)])


def assert_min_rows(df: DataFrame, rows: int, layer: str) -> None:
    enforce(df, layer, [min_rows(rows)])


def assert_column_range(df: DataFrame, column: str, low: float, high: float, layer: str) -> None:
    enforce(df, layer, [column_range(column, low, high)])


def layer_summary(df: DataFrame, layer: str, table: str) -> DataFrame:
    """Row and column counts of a table about to be written."""
    return df.agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(layer).alias("layer"), F.lit(table).alias("table"), "rows",
        F.lit(len(df.columns)).alias("columns"),
    )

"""Permissive CSV, message parsing and quality checks."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartloom import schemas
from chartloom.operators import quality
from chartloom.sources.feed import parse_messages
from chartloom.sources.files import corrupt_counts, read_csv

PAIR = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.StringType())])


def write(tmp_path, text, name="in.csv"):
    path = tmp_path / name
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_corrupt_lines_are_counted_whatever_is_selected(spark, tmp_path):
    path = write(tmp_path, 'a,b\n1,2\n3\n4,5,6\n7,8\n')
    df = read_csv(spark, path, PAIR)
    row = corrupt_counts(df).first()
    assert (row.total_rows, row.corrupt_rows, row.corrupt_ratio) == (4, 2, 0.5)
    bad = [r[schemas.CORRUPT_COLUMN] for r in df.select("a", schemas.CORRUPT_COLUMN).collect()]
    assert bad == [None, "3", "4,5,6", None]


def test_empty_file_has_no_ratio(spark, tmp_path):
    row = corrupt_counts(read_csv(spark, write(tmp_path, "a,b\n"), PAIR)).first()
    assert (row.total_rows, row.corrupt_rows, row.corrupt_ratio) == (0, 0, None)


def test_multi_line_values(spark, tmp_path):
    path = write(tmp_path, 'a,b\n"one\ntwo",2\n3,4\n')
    assert read_csv(spark, path, PAIR).count() == 3
    rows = read_csv(spark, path, PAIR, multi_line=True).select("a", "b").collect()
    assert [tuple(r) for r in rows] == [("one\ntwo", "2"), ("3", "4")]


def test_bom_and_mixed_quotes(spark, tmp_path):
    text = '﻿region_code,country_name,continent,population_2020,gdp_per_capita_usd\n' \
           'us,"United States",America,331000000,63000.5\ngb,United Kingdom, Europe,67000000,40000\n'
    df = read_csv(spark, write(tmp_path, text), schemas.COUNTRIES_RAW_SCHEMA, corrupt_column=None)
    assert [(r.region_code, r.country_name, r.population_2020) for r in df.collect()] == [
        ("us", "United States", 331000000), ("gb", "United Kingdom", 67000000)
    ]


def test_messages(spark):
    df = spark.createDataFrame([
        (1, '{"title":"t","artist":"a","rank":"3","unknown":1}'), (2, '{"title":"t","rank":7}'),
        (3, '{"title":"cut'), (4, "{}"), (5, None), (6, '{"artist":"a"}'),
    ], "id int, value string")
    rows = {r.id: (r.title, r.artist, r["rank"]) for r in parse_messages(df).collect()}
    assert rows == {1: ("t", "a", "3"), 2: ("t", None, "7"), 6: (None, "a", None)}


def test_quality_report_and_enforcement(spark):
    df = spark.createDataFrame([(1, 0.5), (None, 1.5)], "id int, v double")
    report = {r.check: (r.observed, r.passed) for r in quality.quality_report(
        df, "silver", [quality.no_nulls("id"), quality.min_rows(2), quality.column_range("v", 0, 2)]).collect()}
    assert report == {
        "no_nulls(id)": (1, False), "min_rows(2)": (2, True), "column_range(v, 0, 2)": (0, True)
    }
    quality.assert_min_rows(df, 2, "silver")
    quality.assert_no_nulls(df, "v", "silver")
    with pytest.raises(ValueError, match="no_nulls"):
        quality.assert_no_nulls(df, "id", "silver")
    with pytest.raises(ValueError, match="column_range"):
        quality.assert_column_range(df, "v", 0, 1, "silver")
    with pytest.raises(ValueError, match="min_rows"):
        quality.assert_min_rows(df.limit(0), 1, "silver")
    summary = quality.layer_summary(df, "silver", "t").first()
    assert (summary["rows"], summary["columns"]) == (2, 2)


def test_all_checks_share_one_scan(spark, tmp_path):
    spark.range(10).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    report = quality.quality_report(df, "x", [quality.no_nulls("id"), quality.min_rows(1), quality.column_range("id", 0, 9)])
    assert report._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert report.where(~F.col("passed")).count() == 0

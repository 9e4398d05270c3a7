"""Every registered query against its expected SQL, and the shape of the plans."""

import re
import subprocess
import sys
from collections import Counter
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_points
from chartloom.registered.catalog import EXPECTED, QUERIES

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages".split()
# results that consist of one aggregated row, or read what the query itself wrote
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


def plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    return round(value, 6) + 0.0 if isinstance(value, float) else value


def bag(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = entry_points.queries()[name](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [f for f in FORBIDDEN if f in plan]
    # no window may gather a whole table in one task: only per-partition offsets and one-row aggregates do
    for window_input in re.findall(r"Window .*?\n(?:.*\n)?.*Exchange SinglePartition", plan):
        assert "_part" in window_input
    rows = df.collect()
    cursor = duck.execute(entry_points.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(names)
    assert bag(df.columns, rows) == bag(names, cursor.fetchall())
    assert not any(isinstance(v, (date, datetime, Decimal)) for r in rows[:5] for v in r)


def test_every_query_has_an_expected_result():
    assert set(QUERIES) == set(EXPECTED)
    assert set(QUERIES) <= set(entry_points.queries())


@pytest.mark.parametrize("absent", ["ahocorasick", "chartloom.llm", "corpus_pipeline"])
def test_the_rest_works_without_the_optional_part(absent):
    code = (
        f"import sys; sys.modules[{absent!r}] = None\n"
        "import __spark_entry__ as e; from chartloom.registered.catalog import QUERIES\n"
        "assert set(e.queries()) == set(QUERIES) == set(e.oracle_sql()) and e.LEFT_OUT, e.LEFT_OUT"
    )
    subprocess.run([sys.executable, "-c", code], check=True, cwd=Path(__file__).resolve().parents[1], timeout=120)


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0

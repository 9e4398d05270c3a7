"""Helpers of the tests of this subpackage."""

from collections import Counter

import duckdb
import pytest

TABLES = "documents embeddings pages benchmark labels conversations".split()


def plain(value):
    return round(value, 6) + 0.0 if isinstance(value, float) else value


def bag(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


@pytest.fixture
def same_as_sql(spark):
    """Compare a frame with the result of SQL over the tables of a folder, or over given frames."""
    def check(df, sql, folder=None, **tables):
        con = duckdb.connect()
        for t in TABLES if folder else []:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
        for name, frame in tables.items():
            arrow = frame.toArrow()
            con.register(name, arrow)
        cursor = con.execute(sql)
        names = [d[0] for d in cursor.description]
        assert sorted(df.columns) == sorted(names)
        got, expected = bag(df.columns, df.collect()), bag(names, cursor.fetchall())
        assert got == expected, (list((got - expected).items())[:3], list((expected - got).items())[:3])
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
        return plan
    return check

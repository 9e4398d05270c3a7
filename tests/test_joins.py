"""Joins under skew, dimension matching, upserts and writers."""

import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from chartloom import medallion
from chartloom.operators import enrich, joins
from chartloom.registry import Lake, available_tables, register_views
from chartloom.sinks.staging import stage, staging_path
from chartloom.sinks.tables import ensure_table, new_rows, replace_partitions, write_table
from chartloom.sources.files import as_of, load_gold


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the facts carry one key; some keys have no dimension row, some keys are null."""
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None).otherwise(
        F.concat(F.lit("k"), (F.col("id") % 400).cast("string"))
    )
    facts = spark.range(6000).select("id", key.alias("track_id"))
    dim = spark.range(300).select(
        F.concat(F.lit("k"), F.col("id").cast("string")).alias("track_id"), F.col("id").alias("attr")
    ).union(spark.createDataFrame([("hot", -1)], "track_id string, attr bigint"))
    return facts, dim


def rows(df):
    return sorted((r.id, r.track_id, r.attr) for r in df.select("id", F.coalesce("track_id", F.lit("")).alias("track_id"),
                                                               F.coalesce("attr", F.lit(-9)).alias("attr")).collect())


def test_skew_joins_equal_the_plain_join(skewed):
    facts, dim = skewed
    plain = rows(facts.join(dim, "track_id", "left"))
    assert rows(joins.split_hot_join(facts, dim, "track_id", parts=10)) == plain
    assert rows(joins.salted_join(facts, dim, "track_id", salts=5)) == plain
    assert rows(enrich.join_tracks(facts, dim)) == plain


def test_hot_keys_are_found_and_bounded(skewed):
    facts, _ = skewed
    assert [r.track_id for r in joins.hot_keys(facts, "track_id", parts=10).collect()] == ["hot"]
    assert joins.hot_keys(facts, "track_id", parts=2000).count() <= 2000


def plan(df):
    return df._jdf.queryExecution().toString()


def test_broadcast_only_below_the_bound(spark, skewed):
    facts, dim = skewed
    assert "strategy=broadcast" in plan(joins.lookup(facts, dim, "track_id", max_rows=1000)).lower()
    assert "strategy=broadcast" not in plan(joins.lookup(facts, dim, "track_id", max_rows=100)).lower()


def test_salted_rows_are_not_broadcast(skewed):
    """The estimate of the repeated dimension is below the threshold; its rows are `salts` times as many."""
    facts, dim = skewed
    joined = joins.salted_join(facts, dim, "track_id", salts=5)
    executed = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in executed and "BroadcastHashJoin" not in executed
    joined.collect()
    assert "BroadcastHashJoin" not in joined._jdf.queryExecution().executedPlan().toString()


def test_country_by_name_or_code(spark):
    countries = spark.createDataFrame(
        [("gb", "United Kingdom", "Europe"), ("us", "United States", "America")],
        "region_code string, country_name string, continent string",
    )
    charts = spark.createDataFrame([("United Kingdom",), ("US",), ("global",), (None,)], "region string")
    got = {r.region: (r.region_code, r.continent) for r in enrich.join_countries(charts, countries).collect()}
    assert got == {
        "United Kingdom": ("gb", "Europe"), "US": ("us", "America"), "global": (None, None), None: (None, None)
    }


def test_per_capita_of_unknown_population(spark):
    df = spark.createDataFrame([(10, 5), (10, 0), (10, None)], "v bigint, p bigint")
    assert [r.x for r in enrich.per_capita(df, "v", "p", "x").collect()] == [2.0, None, None]


KEY = ["track_id", "chart_date", "region"]


def batch(spark, rows_):
    return spark.createDataFrame(
        [(t, date(2024, 1, d), g, r) for t, d, g, r in rows_], "track_id string, chart_date date, region string, rank int"
    )


def test_new_rows_dedupes_within_and_against(spark):
    target = batch(spark, [("a", 1, "us", 1), ("n", 1, None, 1)])
    incoming = batch(spark, [("a", 1, "us", 9), ("b", 1, "us", 3), ("b", 1, "us", 2), ("n", 1, None, 4)])
    got = [(r.track_id, r["rank"]) for r in new_rows(incoming, target, KEY, [F.col("rank")]).collect()]
    assert got == [("b", 2)]
    assert new_rows(incoming, None, KEY, [F.col("rank")]).count() == 3
    assert new_rows(incoming.limit(0), target, KEY, [F.col("rank")]).count() == 0


def test_increment_replay_changes_nothing(spark):
    path = staging_path(spark, "t")
    first, second = batch(spark, [("a", 1, "us", 1)]), batch(spark, [("a", 1, "us", 5), ("b", 2, "us", 1)])
    assert medallion.load_increment(spark, path, first, KEY, 0) == 1
    for _ in range(2):
        assert medallion.load_increment(spark, path, second, KEY, 1) == 1
        stored = sorted((r.track_id, r["rank"], r.batch_id) for r in spark.read.parquet(path).collect())
        assert stored == [("a", 1, 0), ("b", 1, 1)]
    assert as_of(spark.read.parquet(path), 0).count() == 1
    assert as_of(spark.read.parquet(path), None).count() == 2


def test_writers(spark):
    df = spark.range(100).select("id", (F.col("id") % 4).alias("g"), F.lit(2024).alias("year"))
    path = staging_path(spark, "w")
    counts = write_table(df, path, partition_by=("year", "g"), counters={"odd": F.count_if(F.col("id") % 2 == 1)})
    assert counts == {"rows": 100, "odd": 50}
    assert spark.read.parquet(path).where("g = 1").count() == 25
    assert replace_partitions(df.where("g = 1").limit(5), path, ("year", "g"))["rows"] == 5
    assert spark.read.parquet(path).count() == 80
    ensure_table(spark, path, df.schema)
    assert spark.read.parquet(path).count() == 80


def test_stage_survives_without_its_source(spark):
    assert stage(spark.range(10), "s").count() == 10


def test_catalog_and_versions(spark):
    lake = Lake(staging_path(spark, "lake"))
    assert available_tables(spark, lake) == []
    write_table(spark.range(3), lake.path("gold.streak_analysis"))
    write_table(spark.createDataFrame([(1, 0), (2, 1)], "v int, batch_id bigint"), lake.path("gold.track_longevity"))
    assert available_tables(spark, lake) == ["streak_analysis", "track_longevity"]
    assert load_gold(spark, lake, "streak_analysis").count() == 3
    assert load_gold(spark, lake, "track_longevity", version=0).count() == 1
    with pytest.raises(ValueError):
        load_gold(spark, lake, "streak_analysis", version=0)
    assert register_views(spark, lake) == ["gold_streak_analysis", "gold_track_longevity"]
    assert spark.sql("SELECT count(*) AS n FROM gold_streak_analysis").first().n == 3


def task_rows(spark, df):
    """Rows by partition of a frame's result."""
    return sorted(r.n for r in df.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect())


def test_null_and_hot_keys_stay_out_of_the_shuffle(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    for k, v in zip(before, ("-1", "false", "8")):
        spark.conf.set(k, v)
    try:
        key = F.when(F.col("id") % 3 == 0, None).when(F.col("id") % 3 == 1, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 1999).cast("string")))
        facts = spark.range(0, 60_000, 1, 8).select(key.alias("track_id"), "id")
        dim = spark.range(0, 3000).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("track_id"), (F.col("id") * 2).alias("attr"))
        dim = dim.union(spark.createDataFrame([("hot", -1)], "track_id string, attr bigint"))
        assert joins.hot_values(facts, "track_id", 100) == ["hot"]
        split = joins.split_hot_join(facts, dim, "track_id", 100)
        assert split.exceptAll(facts.join(dim, "track_id", "left")).count() == 0 and split.count() == 60_000
        sizes = task_rows(spark, split)
        assert sizes[-1] < 2 * sizes[len(sizes) // 2]
        plain = task_rows(spark, facts.join(dim, "track_id", "left"))
        assert plain[-1] > 4 * plain[len(plain) // 2]  # what it is good for
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_hot_keys_of_other_types_and_of_nothing(spark):
    df = spark.createDataFrame([(1, True)] * 50 + [(None, None)] * 50 + [(i, False) for i in range(20)], "n int, b boolean")
    assert joins.hot_values(df, "n", 10) == [1]
    assert joins.hot_values(df.limit(0), "n") == [] and joins.hot_values(df.select(F.lit(None).cast("string").alias("n")), "n") == []
    assert joins.hot_keys(df, "n", 10).schema["n"].dataType.simpleString() == "int"


def test_country_match_is_one_spread_join(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    for k, v in zip(before, ("-1", "false", "8")):
        spark.conf.set(k, v)
    try:
        countries = spark.createDataFrame(
            [("us", "United States", "America"), ("GB", "United Kingdom", "Europe"), ("xx", "us", "Nowhere"), ("dup", "Twin", "A"), ("dap", "Twin", "B"), (None, "No Code", "C"), ("nn", None, "D")],
            "region_code string, country_name string, continent string")
        rows = [(i, r) for i, r in enumerate(["United States", "US", "us", "gb", "united kingdom", "Twin", "No Code", "NN", "Global", ""])]
        charts = spark.createDataFrame(rows + [(100 + i, None) for i in range(4000)], "id int, region string")
        found = enrich.join_countries(charts, countries)
        got = sorted((r.id, r.region_code, r.continent) for r in found.where("id < 100").collect() if r.continent)
        assert got == [(0, "us", "America"), (1, "us", "America"), (2, "xx", "Nowhere"), (3, "GB", "Europe"), (5, "dap", "B"), (5, "dup", "A"), (6, None, "C"), (7, "nn", "D")]
        assert found.count() == 4011
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SortMergeJoin") + plan.count("ShuffledHashJoin") == 1
        sizes = task_rows(spark, found)
        assert len(sizes) == 8 and sizes[-1] < 2 * sizes[4]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_an_increment_reads_only_the_months_it_touches(spark):
    path = staging_path(spark, "increments")
    def part(*days):
        return spark.createDataFrame([(f"t{i}", date.fromisoformat(d), i) for d in days for i in range(3)], "track_id string, chart_date date, v int")
    keys = ["track_id", "chart_date"]
    assert medallion.load_increment(spark, path, part("2024-01-05", "2024-02-05", "2024-03-05"), keys, 0, day="chart_date") == 9
    plan = medallion.fresh_rows(spark, path, part("2024-02-05", "2024-02-06"), keys, 1, day="chart_date")._jdf.queryExecution().executedPlan().toString()
    scan = re.search(r"PartitionFilters: \[([^\]]*)\]", plan).group(1)
    assert "month_start" in scan and "2024-02-01" in scan and "2024-01-01" not in scan
    assert medallion.load_increment(spark, path, part("2024-02-05", "2024-02-06"), keys, 1, day="chart_date") == 3
    assert medallion.load_increment(spark, path, part("2024-02-05", "2024-02-06"), keys, 1, day="chart_date") == 3
    assert spark.read.parquet(path).count() == 12

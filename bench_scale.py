"""Run the batch layers on generated raw files of a chosen size: `bench_scale.py <folder> [chart rows] [feature rows]`.

The generated files have the shape of daily charts (70 regions, 200 ranks, two chart types, a
skewed choice of tracks) and of a track × artist feature table. Prints one JSON line with the
rows and seconds of every table.
"""

import json
import os
import sys
import time

from pyspark.sql import functions as F

from chartloom import medallion, schemas
from chartloom.registry import Lake
from chartloom.session import get_spark

REGIONS, RANKS = 70, 200


def pick(salt: int, modulus: int):
    return F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(modulus))


def write_raw(spark, lake: Lake, chart_rows: int, feature_rows: int) -> None:
    """Charts draw on one track in a hundred, half of the entries on one in ten thousand of them.

    A few dates, ids and ranks are damaged.
    """
    tracks = max(feature_rows * 7 // 10, 10_000)
    popular = F.when(pick(1, 2) == 0, pick(2, tracks // 10_000)).otherwise(pick(3, tracks // 100))
    day = F.date_add(F.lit("2017-01-01").cast("date"), F.floor(F.col("id") / (REGIONS * RANKS)).cast("int"))
    charts = spark.range(chart_rows).select(
        "id", day.alias("day"), popular.alias("track"),
        F.concat(F.lit("Country "), (F.floor(F.col("id") / RANKS) % REGIONS).cast("string")).alias("region"),
        (F.col("id") % RANKS + 1).alias("rank"),
    ).select(
        F.concat(F.lit("Title "), F.col("track").cast("string")).alias("title"),
        F.when(pick(4, 4000) == 0, "N/A").otherwise(F.col("rank").cast("string")).alias("rank"),
        F.when(pick(5, 200) == 0, F.date_format("day", "MM/dd/yyyy")).otherwise(F.col("day").cast("string")).alias("date"),
        F.concat(F.lit("Artist "), (F.col("track") % 50000).cast("string")).alias("artist"),
        F.when(pick(6, 300) != 0, F.concat(F.lit("https://charts.example.com/track/"), F.lpad(
            F.conv(F.col("track").cast("string"), 10, 36), 22, "0"))).alias("url"),
        "region",
        F.when(pick(7, 5) == 0, "viral50").otherwise("top200").alias("chart"),
        F.lit("SAME_POSITION").alias("trend"),
        F.when(pick(7, 5) != 0, pick(8, 500000).cast("string")).alias("streams"),
    )
    charts.write.option("header", "true").csv(lake.path("raw.charts.csv"))

    track = F.floor(F.col("id") * 7 / 10)
    values = {
        "track_id": F.lpad(F.conv(track.cast("string"), 10, 36), 22, "0"),
        "artist_name": F.concat(F.lit("Artist "), pick(9, 50000).cast("string")),
        "track_name": F.concat(F.lit("Title "), track.cast("string")),
        "album_name": F.concat(F.lit("Album "), pick(10, 100000).cast("string")),
        "album_release_date": F.date_add(F.lit("1955-01-01").cast("date"), pick(11, 25000).cast("int")),
    }
    columns = []
    for i, f in enumerate(schemas.TRACK_FEATURES_RAW_SCHEMA.fields):
        # features depend on the track alone, as in the data this stands for
        drawn = F.pmod(F.xxhash64(track, F.lit(20 + i)), F.lit(1020))
        value = values.get(f.name, drawn / 1000 if f.dataType.simpleString() == "double" else drawn)
        columns.append(value.cast(f.dataType).alias(f.name))
    spark.range(feature_rows).select(*columns).write.parquet(lake.path("raw.track_features.parquet"))

    spark.range(REGIONS - 2).select(
        F.concat(F.lit("c"), F.col("id").cast("string")).alias("region_code"),
        F.concat(F.lit(" Country "), F.col("id").cast("string")).alias("country_name"),
        F.concat(F.lit("Continent "), (F.col("id") % 6).cast("string")).alias("continent"),
        (F.col("id") * 1000000).alias("population_2020"), F.lit(1.5).alias("gdp_per_capita_usd"),
    ).coalesce(1).write.option("header", "true").csv(lake.path("raw.countries.csv"))


def main() -> None:
    folder = sys.argv[1]
    chart_rows = int(sys.argv[2]) if len(sys.argv) > 2 else 26_173_514
    feature_rows = int(sys.argv[3]) if len(sys.argv) > 3 else 56_277_664
    cpus = os.getenv("BENCH_CPUS", "8")
    spark = get_spark("bench-scale", extra={
        "spark.master": f"local[{cpus}]", "spark.driver.memory": "20g", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.sql.shuffle.partitions": "64",
        "spark.checkpoint.dir": f"{folder}/staging", "spark.local.dir": f"{folder}/local",
    })
    spark.sparkContext.setLogLevel("OFF")
    lake = Lake(f"{folder}/lake")
    started = time.perf_counter()
    write_raw(spark, lake, chart_rows, feature_rows)
    generated = time.perf_counter() - started
    report = medallion.run(spark, lake)
    total = sum(r["seconds"] for r in report.values())
    print(json.dumps({"generate_sec": round(generated, 1), "total_sec": round(total, 1), "cpus": int(cpus), "tables": report}))
    spark.stop()


if __name__ == "__main__":
    main()

"""Enrichment of chart entries with track features and country attributes."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartloom.operators.joins import broadcast_if_small, split_hot_join
from chartloom.sinks.staging import stage

NOWHERE = 100_003  # keys over which entries without a region are spread


def charted_tracks(charts: DataFrame, tracks: DataFrame, max_ids: int = 1_000_000) -> DataFrame:
    """The tracks that occur in the charts: all that the joins on the track can ever use.

    Charts touch a small part of a track catalogue. Their distinct ids are collected into a
    staged table; up to `max_ids` of them are broadcast, so the wide catalogue is filtered where
    it is read and never shuffled as a whole. More ids than that meet it in a shuffle join.
    """
    ids = stage(charts.select("track_id").distinct(), "charted-ids")
    return tracks.join(broadcast_if_small(ids, max_ids), "track_id", "left_semi")


def join_tracks(charts: DataFrame, tracks: DataFrame, split_hot: bool = False) -> DataFrame:
    """Every chart entry with its track's attributes.

    Both sides are shuffled once on the track, or neither when the tracks are small enough
    to broadcast; adaptive execution splits a skewed track over several tasks. `split_hot`
    measures the hot tracks first and keeps their entries out of the shuffle altogether.
    """
    tracks = tracks.drop("ingestion_ts")
    if split_hot:
        return split_hot_join(charts, tracks, "track_id")
    return charts.join(tracks, "track_id", "left")


def join_countries(charts: DataFrame, countries: DataFrame) -> DataFrame:
    """Every entry with its country's attributes, matching `region` by name or by code; the name wins.

    One join: the dimension becomes a table of folded names and codes, each with what it may
    stand for and its rank, and the matches of the best rank are picked afterwards. Entries
    without a region get a key of their own that stands for nothing, so that they spread over
    all tasks where the dimension is too large to broadcast.
    """
    attributes = [c for c in countries.columns if c != "country_name"]
    entry = F.struct(*[F.col(c) for c in attributes])

    def keyed(column: str, rank: int) -> DataFrame:
        # a name must be met exactly, a code in any case
        exact = F.col(column) if rank == 0 else F.lit(None).cast("string")
        return countries.where(F.col(column).isNotNull()).select(
            F.lower(column).alias("_key"), F.struct(F.lit(rank).alias("rank"), exact.alias("exact"), entry.alias("entry")).alias("_one"))

    table = keyed("country_name", 0).union(keyed("region_code", 1)).groupBy("_key").agg(F.collect_list("_one").alias("_all"))
    nowhere = F.concat(F.lit("\x00"), F.pmod(F.xxhash64(*charts.columns), F.lit(NOWHERE)).cast("string"))
    joined = charts.withColumn("_lookup", F.coalesce(F.lower("region"), nowhere)).join(table, F.col("_lookup") == F.col("_key"), "left")
    fits = F.filter("_all", lambda m: m["exact"].isNull() | (m["exact"] == F.col("region")))
    found = joined.withColumn("_fits", fits).withColumn("_rank", F.array_min(F.transform("_fits", lambda m: m["rank"])))
    best = F.transform(F.filter("_fits", lambda m: m["rank"] == F.col("_rank")), lambda m: m["entry"])
    return found.select(*charts.columns, F.explode_outer(best).alias("_entry")).select(
        *charts.columns, *[F.col(f"_entry.{c}").alias(c) for c in attributes])


def enrich_charts(
    charts: DataFrame, tracks: DataFrame, countries: DataFrame, split_hot: bool = False
) -> DataFrame:
    return join_countries(join_tracks(charts, tracks, split_hot), countries)


def per_capita(df: DataFrame, value: str, population: str, name: str, per: float = 1.0) -> DataFrame:
    """`value` per `per` inhabitants; null where the population is unknown or zero."""
    ratio = F.try_divide(F.col(value).cast("double") * per, F.col(population).cast("double"))
    return df.withColumn(name, ratio)

"""Row-shaping operators: keep-one-per-key, top-k, counts of kinds."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_latest(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row per key in `order`.

    The optimiser turns the row-number filter into a group limit that runs before the
    shuffle as well, so each task sends at most one row per key however many copies a
    key has. `order` should be total, otherwise equal rows are interchangeable.
    """
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(ranked)).where("_rn = 1").drop("_rn")


def top_k(df: DataFrame, k: int, order: list[Column]) -> DataFrame:
    """The first `k` rows in `order`: each task keeps `k`, one task merges them."""
    return df.orderBy(*order).limit(k)


def top_per_group(df: DataFrame, groups: list[str], k: int, order: list[Column], dense: bool = False,
                  name: str = "position") -> DataFrame:
    """The rows ranked within the first `k` of their group (dense: ties share a rank)."""
    w = Window.partitionBy(*groups).orderBy(*order)
    rank = F.dense_rank() if dense else F.row_number()
    return df.withColumn(name, rank.over(w)).where(F.col(name) <= k)

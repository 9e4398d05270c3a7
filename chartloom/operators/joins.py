"""Joins. Broadcasts happen only behind a size check; hot keys have their own path."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_ROWS = 50_000


def broadcast_if_small(dim: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark `dim` for broadcast when it has at most `max_rows` rows, else leave it alone.

    The check reads at most `max_rows + 1` rows. A dimension over the bound joins by
    shuffle, where adaptive execution still splits skewed partitions.
    """
    small = dim.limit(max_rows + 1).count() <= max_rows
    return F.broadcast(dim) if small else dim


def lookup(fact: DataFrame, dim: DataFrame, on: list[str] | str, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Left equi-join to a dimension that is broadcast when its size allows."""
    return fact.join(broadcast_if_small(dim, max_rows), on, "left")


def repeats_a_key(dims: list[tuple[DataFrame, Column]]) -> bool:
    """Whether in any of the dimensions two rows share their key; null keys match nothing and don't count."""
    keys = [dim.select(F.lit(i).alias("dim"), key.cast("string").alias("key")) for i, (dim, key) in enumerate(dims)]
    met = reduce(DataFrame.union, keys).where(F.col("key").isNotNull()).groupBy("dim", "key").agg(F.count(F.lit(1)).alias("n"))
    return not met.where("n > 1").isEmpty()


def not_in_target(incoming: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of `incoming` without a match in `target`; null keys match null keys."""
    left, right = incoming.alias("incoming"), target.select(*keys).alias("target")
    matched = reduce(
        lambda a, b: a & b,
        [F.col(f"incoming.{k}").eqNullSafe(F.col(f"target.{k}")) for k in keys],
    )
    return left.join(right, matched, "left_anti")


def hot_keys(fact: DataFrame, key: str, parts: int = 1000) -> DataFrame:
    """Keys holding about 1/`parts` of all rows or more, as a table of at most `parts` rows."""
    schema = T.StructType([fact.schema[key]])
    return fact.sparkSession.createDataFrame([(k,) for k in hot_values(fact, key, parts)], schema)


def hot_values(fact: DataFrame, key: str, parts: int = 1000) -> list:
    """The same keys as values; null is not among them.

    One scan of the key column with a sketch of frequent items, which tasks fill and merge; no
    key is shuffled. The sketch tracks far more keys than can be that frequent, so none of them
    is missed; the rest of the work is right whatever keys are named hot.
    """
    tracked = 8 * parts
    seen = fact.agg(F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(`{key}`, {parts}, {tracked})").alias("top")).first()
    return [t["item"] for t in seen["top"] or [] if t["item"] is not None and t["count"] * parts >= seen["n"]]


def split_hot_join(fact: DataFrame, dim: DataFrame, key: str, parts: int = 1000) -> DataFrame:
    """Left join that keeps hot keys and null keys out of the shuffle; `dim` has one row per `key`.

    Rows of a hot key (see `hot_values`) take their attributes from a broadcast of the at
    most `parts` matching dimension rows and stay where they were read, and so do rows without
    a key; all other rows go through an ordinary shuffle join. Together they give every row of
    the plain left join once.
    """
    hot = hot_values(fact, key, parts)
    is_hot = F.col(key).isin(hot) if hot else F.lit(False)
    out = [F.col(c) for c in fact.columns] + [F.col(c) for c in dim.columns if c != key]
    apart = fact.where(F.col(key).isNull() | is_hot).join(F.broadcast(dim.where(is_hot)), key, "left").select(*out)
    rest = fact.where(F.col(key).isNotNull() & ~is_hot).join(dim, key, "left").select(*out)
    return apart.unionByName(rest)


def salted_join(
    fact: DataFrame, dim: DataFrame, key: str, salts: int = 16, spread: list[Column] | None = None
) -> DataFrame:
    """Left join with every key spread over `salts` partitions.

    Each fact row picks a salt from its own content, each dimension row is repeated once
    per salt, so a key that holds most rows is joined by `salts` tasks. `dim` grows by the
    factor `salts`; prefer `split_hot_join` when `dim` is large and unique per key. The repeated
    rows are never broadcast: Spark's estimate of their size is that of `dim` before it grew.
    """
    basis = spread or [F.col(c) for c in fact.columns]
    salted_fact = fact.withColumn("_salt", F.pmod(F.xxhash64(*basis), F.lit(salts)).cast("int"))
    every_salt = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    salted_dim = dim.withColumn("_salt", every_salt)
    return salted_fact.join(salted_dim.hint("merge"), [key, "_salt"], "left").drop("_salt")

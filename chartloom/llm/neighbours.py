"""Approximate nearest neighbours by a hash-prefix forest.

Each tree gives a vector a long bit string, the signs of its products with random
directions, and keeps the strings of its vectors in a sorted array. A query descends in
every tree to the vectors that share its longest prefix; then all trees ascend together, one
prefix bit at a time, until the trees together hold enough candidates. These are scored
exactly, in double precision.

The index is cut into blocks of bounded size, each with its own forest, and the queries into
blocks as well; a query's best of all blocks are merged. Vectors that are exactly equal are
one entry of the index: it keeps its smallest ids, as many as can be among the results, so a
vector that occurs very often is one entry like any other. Every row is indexed.

How many candidates are needed depends on the data. Vectors without structure, such as
random ones in 64 dimensions, have neighbours hardly nearer than the rest, and a recall of
0.9 takes a fair share of each block (`SHARE`), far more than clustered vectors would need.

Defined results: vectors that are null, zero, or hold null or non-finite components neither
ask nor answer, nor do rows with a null id; of repeated rows (same id, same vector) one
counts; other columns are ignored. A vector only meets vectors of its own dimension.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chartloom.llm.catalog import query
from chartloom.sinks.staging import stage

TREES, BITS = 64, 32
SHARE = 0.40  # of a block: the candidates at which the trees stop ascending
BLOCK, QUERY_BLOCK = 8192, 2048  # entries of an index block, queries of a query block
SEED = 20


def usable(vector: Column) -> Column:
    """No null, NaN or infinite component, and not all zero."""
    def bad(x: Column) -> Column:
        return x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))

    return vector.isNotNull() & ~F.exists(vector, bad) & F.exists(vector, lambda x: x != 0)


def directions(dimension: int, trees: int = TREES, bits: int = BITS) -> np.ndarray:
    """Random directions, orthogonal in groups as large as the dimension allows; the same on every executor."""
    draw, rows = np.random.default_rng(SEED), []
    while len(rows) * dimension < trees * bits:
        rows.append(np.linalg.qr(draw.normal(size=(dimension, dimension)))[0].T)
    return np.concatenate(rows)[: trees * bits]


def codes(vectors: np.ndarray, trees: int = TREES, bits: int = BITS) -> np.ndarray:
    """Bit strings as integers, first bit highest: trees x vectors."""
    signs = (vectors @ directions(vectors.shape[1], trees, bits).T > 0).reshape(len(vectors), trees, bits)
    return (signs.astype(np.uint64) << np.arange(bits - 1, -1, -1, dtype=np.uint64)).sum(axis=2).T


class Forest:
    """The sorted arrays of one block."""

    def __init__(self, vectors: np.ndarray) -> None:
        own = codes(vectors)
        self.n = len(vectors)
        self.order = np.argsort(own, axis=1, kind="stable")
        self.sorted = np.take_along_axis(own, self.order, axis=1)

    def candidates(self, queries: np.ndarray, at_least: int) -> Iterator[np.ndarray]:
        """For each query the entries met when the trees' prefixes have become short enough."""
        asked = codes(queries)
        lows, highs = np.zeros((BITS + 1, *asked.shape), np.int32), np.zeros((BITS + 1, *asked.shape), np.int32)
        for length in range(BITS + 1):
            shift = np.uint64(BITS - length)
            start = asked >> shift << shift
            for tree in range(TREES):
                lows[length, tree] = np.searchsorted(self.sorted[tree], start[tree], "left")
                highs[length, tree] = np.searchsorted(self.sorted[tree], start[tree] + (np.uint64(1) << shift), "left")
        for q in range(asked.shape[1]):
            met = np.zeros(self.n, bool)
            for length in range(BITS, -1, -1):  # all trees one bit up, from the longest prefix
                low, high = lows[length, :, q], highs[length, :, q]
                if length and (high - low).sum() < at_least:
                    continue  # even without overlaps too few
                for tree in range(TREES):
                    met[self.order[tree, low[tree] : high[tree]]] = True
                if np.count_nonzero(met) >= at_least:
                    break
            yield np.flatnonzero(met)


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Each vector times a power of two that brings its largest component near one: squares neither overflow nor vanish, nothing is rounded."""
    _, power = np.frexp(np.abs(vectors).max(axis=1, initial=0.0))
    return np.ldexp(vectors, -power[:, None])


def _best(index: pd.DataFrame, queries: pd.DataFrame, k: int, share: float) -> pd.DataFrame:
    """The best `k` of one index block for each query of one query block."""
    out: list[tuple[int, int, float]] = []
    if len(index) and len(queries):
        vectors = scaled(np.array(index["vector"].tolist(), np.float64))
        asked = scaled(np.array(queries["vector"].tolist(), np.float64))
        unit = vectors / np.sqrt((vectors**2).sum(axis=1))[:, None]
        ids, own = index["ids"].tolist(), queries["vec_id"].tolist()
        length = np.sqrt((asked**2).sum(axis=1))
        forest = Forest(unit)
        for q, found in enumerate(forest.candidates(asked / length[:, None], max(int(share * len(index)), 4 * k))):
            scores = unit[found] @ asked[q] / length[q]
            # an entry may be the query itself alone, and ties go by id: take the k + 1 best entries and all their equals
            if len(found) > k + 1:
                edge = np.partition(scores, len(scores) - k - 1)[len(scores) - k - 1]
                near = scores >= edge - 1e-12
                found, scores = found[near], scores[near]
            for entry in found:
                a, b = vectors[entry], asked[q]
                exact = float((a * b).sum() / (np.sqrt((a * a).sum()) * np.sqrt((b * b).sum())))
                out += [(own[q], int(i), exact) for i in ids[entry] if i != own[q]]
    best = pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})
    return best.sort_values(["query_id", "score", "vec_id"], ascending=[True, False, True]).groupby("query_id").head(k)


def search(df: DataFrame, asks: Column, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding", share: float = SHARE) -> DataFrame:
    """query_id, rank, vec_id, score: the `k` nearest found for every row that `asks`, by cosine."""
    rows = df.where(df[vec_id].isNotNull() & usable(df[vector])).select(
        df[vec_id].cast("long").alias("vec_id"), df[vector].cast("array<double>").alias("vector"),
        F.coalesce(asks, F.lit(False)).alias("asks"))
    rows = rows.withColumn("vector", F.transform("vector", lambda x: x + F.lit(0.0)))  # -0.0 is 0.0
    # entries: equal vectors with their k + 1 smallest ids; each task passes on no more than that of a vector.
    # Repeated rows go first, or they would fill the places of other ids
    smallest = Window.partitionBy("vector").orderBy("vec_id")
    ids = rows.select("vector", "vec_id").distinct().withColumn("_at", F.row_number().over(smallest)).where(F.col("_at") <= k + 1)
    entries = stage(ids.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")), "ann-index")
    asking = stage(rows.where("asks").select("vec_id", "vector").distinct(), "ann-queries")
    blocks, query_blocks = max(1, -(-entries.count() // BLOCK)), max(1, -(-asking.count() // QUERY_BLOCK))
    size = F.size("vector").alias("size")

    def spread(frame: DataFrame, own: str, n: int, other: str, m: int) -> DataFrame:
        """Each row to its block by hash, once for every block of the other side."""
        return frame.withColumn(own, F.pmod(F.xxhash64("vector"), F.lit(n)).cast("int")).withColumn(
            other, F.explode(F.sequence(F.lit(0), F.lit(m - 1)))).withColumn("size", size)

    index = spread(entries, "block", blocks, "query_block", query_blocks)
    queries = spread(asking, "query_block", query_blocks, "block", blocks)
    keys = ["size", "block", "query_block"]

    def run(_key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return _best(left, right, k, share)

    found = index.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInPandas(run, "query_id long, vec_id long, score double")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.distinct().withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


@query("op10_hash_forest", exact=True)
def op10_hash_forest(spark: SparkSession, folder: str) -> DataFrame:
    vectors = spark.read.parquet(f"{folder}/embeddings.parquet")
    return search(vectors, F.col("vec_id") % 50 == 0)

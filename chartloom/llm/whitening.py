"""Whitening of embeddings, with covariances by polarisation.

An entry c becomes the integer x = floor(256 c). The fit list holds each distinct vector
once. Tasks add up, for every dimension and for every sum of two dimensions, the exact
square of the centred value n x - S, where n is the number of vectors and S their sum. The
covariance of two dimensions is half of what the variance of their sum exceeds the sum of
their variances by: integers throughout, rounded once at the end. Only sums for pairs of
dimensions reach the driver, d (d + 1) / 2 of them, however many vectors there are.

Defined results: vectors that are null or hold null or non-finite entries are dropped, and
so are those with an entry whose x does not fit a 64-bit integer; vectors of another length
than most distinct ones have (the longer, if two are as frequent) take no part, nor do empty
ones; repeated rows give equal rows, rows with a null id too; components without variance,
as with a single distinct vector, are left out; a deviation beyond 64 bits is null; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chartloom.llm.catalog import query
from chartloom.sinks.staging import stage

SCALE = 256
COMPONENTS = 4
ROWS = 8192  # of a block of vectors: what a task has in numpy at once

_LIMB = 24  # bits; squares of sums are added up in limbs that cannot overflow in a block
_LARGE = 1 << 60


def vectors_of(df: DataFrame, vector: str = "embedding", keep: tuple[str, ...] = ("vec_id",)) -> DataFrame:
    """`keep` and x, an array of integers, of the rows whose vector is whole."""
    def fit(c: Column) -> Column:
        return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float(2**63 // SCALE))

    values = df[vector].cast("array<double>")
    kept = df.where(values.isNotNull() & (F.size(values) > 0) & F.forall(values, fit))
    return kept.select(*[kept[k] for k in keep], F.transform(values, lambda c: F.floor(c * SCALE).cast("long")).alias("x"))


def blocks(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Slices of the batches, each with the vectors of a list column as a matrix of integers."""
    for batch in batches:
        for lo in range(0, batch.num_rows, ROWS):
            part = batch.slice(lo, ROWS)
            yield part, part.column(column).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)


def whole_sum(values: np.ndarray) -> list[int]:
    """Exact column sums of 64-bit integers, as Python integers."""
    low = (values & ((1 << 32) - 1)).sum(axis=0)
    return [(int(h) << 32) + int(m) for h, m in zip((values >> 32).sum(axis=0), low)]


def square_sums(values: np.ndarray) -> list[int]:
    """Exact sums of the squares of each column."""
    if values.dtype == object or not len(values) or np.abs(values).max() >= 1 << 2 * _LIMB:
        return [int(v) for v in (values.astype(object) ** 2).sum(axis=0)]
    high, low = values >> _LIMB, values & ((1 << _LIMB) - 1)
    parts = ((high * high).sum(axis=0), (high * low).sum(axis=0), (low * low).sum(axis=0))
    return [(int(a) << 2 * _LIMB) + (int(b) << _LIMB + 1) + int(c) for a, b, c in zip(*parts)]


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n x - S, as 64-bit integers where no sum of two can leave them, else as Python integers."""
    bound = n * int(max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0))))) + max(map(abs, sums), default=0)
    if bound < _LARGE:
        return x * n - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def _limbs(key: list[list[int]], values: list[int], names: list[str]) -> pa.RecordBatch:
    """Integers of any size as a high and a low part, which Spark adds up without loss."""
    kind = pa.decimal128(38, 0)
    high, low = [v >> 60 for v in values], [v & ((1 << 60) - 1) for v in values]
    return pa.RecordBatch.from_arrays([*[pa.array(k, pa.int32()) for k in key], pa.array(high, kind), pa.array(low, kind)], names=names)


def _added(partial: DataFrame, keys: list[str]) -> dict[tuple, int]:
    rows = partial.groupBy(*keys).agg(F.sum("high").alias("high"), F.sum("low").alias("low")).collect()
    return {tuple(r[k] for k in keys): (int(r["high"]) << 60) + int(r["low"]) for r in rows}


def sums_of(fit: DataFrame, dimension: int) -> list[int]:
    """S: the exact sum of every dimension."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * dimension
        for _, x in blocks(batches, 0):
            total = [a + b for a, b in zip(total, whole_sum(x))]
        yield _limbs([list(range(dimension))], total, ["i", "high", "low"])

    found = _added(fit.select("x").mapInArrow(run, "i int, high decimal(38,0), low decimal(38,0)"), ["i"])
    return [found.get((i,), 0) for i in range(dimension)]


def squares_of(fit: DataFrame, n: int, sums: list[int]) -> dict[tuple[int, int], int]:
    """For i = j the sum of squares of dimension i, else of the sum of dimensions i and j; all exact."""
    dimension = len(sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        i = [a for a in range(dimension) for _ in range(a, dimension)]
        j = [b for a in range(dimension) for b in range(a, dimension)]
        total = [0] * len(i)
        for _, x in blocks(batches, 0):
            v = np.asfortranarray(centred(x, n, sums))
            found = []
            for a in range(dimension):
                pair = v[:, a:] + v[:, a : a + 1]
                pair[:, 0] = v[:, a]  # the dimension alone
                found += square_sums(pair)
            total = [s + f for s, f in zip(total, found)]
        yield _limbs([i, j], total, ["i", "j", "high", "low"])

    return _added(fit.select("x").mapInArrow(run, "i int, j int, high decimal(38,0), low decimal(38,0)"), ["i", "j"])


@dataclass(frozen=True)
class Whitening:
    """What the fit list says: its size and sums, eigenvalues, directions (dimension x components) and the trace."""

    n: int
    sums: list[int]
    values: np.ndarray
    directions: np.ndarray
    trace: float

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened coordinates of integer vectors: (x - S / n) on each component, over its deviation."""
        v = centred(x, self.n, self.sums)
        return (v.astype(np.float64) / self.n) @ self.directions / np.sqrt(self.values)


def covariance(squares: dict[tuple[int, int], int], n: int, dimension: int) -> np.ndarray:
    """Polarisation: cov(a, b) = (var(a + b) - var(a) - var(b)) / 2; exact up to the last rounding."""
    out = np.zeros((dimension, dimension))
    for a in range(dimension):
        for b in range(a, dimension):
            both = squares[a, a] if a == b else Fraction(squares[a, b] - squares[a, a] - squares[b, b], 2)
            out[a, b] = out[b, a] = float(Fraction(both, n**3))
    return out


def fit_whitening(fit: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Of a staged list of distinct x vectors of one length; None if it is empty."""
    head = fit.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("x")).alias("d")).first()
    if not head["n"]:
        return None
    n, dimension = head["n"], head["d"]
    sums = sums_of(fit, dimension)
    v = covariance(squares_of(fit, n, sums), n, dimension)
    values, directions = np.linalg.eigh(v)
    values, directions = values[::-1], directions[:, ::-1]
    some = int((values[:components] > max(values[0], 0.0) * dimension * np.finfo(float).eps).sum())
    directions = directions[:, :some]
    turn = np.sign(directions[np.abs(directions).argmax(axis=0), np.arange(some)])  # the same sign on every run
    return Whitening(n, sums, values[:some].copy(), directions * turn, float(np.trace(v)))


def identity_error(fit: DataFrame, found: Whitening) -> float:
    """The largest entry of the whitened fit list's covariance minus the identity, measured on the list itself."""
    k = len(found.values)
    names = [f"z{c}" for c in range(k)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, x in blocks(batches, 0):
            z = found.project(x)
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(z[:, c])) for c in range(k)], names=names)

    z = fit.select("x").mapInArrow(run, ", ".join(f"{c} double" for c in names))
    pairs = [(a, b) for a in range(k) for b in range(a, k)]
    row = z.agg(*[F.covar_pop(names[a], names[b]).alias(f"c{a}_{b}") for a, b in pairs]).first()
    return max(abs(row[f"c{a}_{b}"] - (a == b)) for a, b in pairs)


def whiten(df: DataFrame, vector: str = "embedding", vec_id: str = "vec_id", components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a row for each vector and component."""
    rows = vectors_of(df, vector, (vec_id,))
    kind = dict(rows.dtypes)[vec_id]
    schema = f"vec_id {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    distinct = stage(rows.select("x").distinct(), "whitening-fit")
    lengths = distinct.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    most = lengths.orderBy(F.desc("n"), F.desc("d")).first()
    fit = distinct.where(F.size("x") == (most["d"] if most else 0))
    found = fit_whitening(fit, components)
    if found is None or not len(found.values):
        return df.sparkSession.createDataFrame([], schema)
    error, k = identity_error(fit, found), len(found.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in blocks(batches, 1):
            v = centred(x, found.n, found.sums)
            # the sum of squares over dimensions is exact: in 64 bits if it must fit, else in Python integers
            fits = v.dtype != object and float(np.abs(v).max()) ** 2 * v.shape[1] < 2.0**62
            far = (v * v).sum(axis=1) if fits else (v.astype(object) ** 2).sum(axis=1)
            far = [int(f) if f < 1 << 63 else None for f in far.tolist()]
            m = part.num_rows
            row = pa.array(np.repeat(np.arange(m), k))
            yield pa.RecordBatch.from_arrays([
                part.column(0).take(row), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                pa.array(np.full(m * k, found.n, np.int64)), pa.array(far, pa.int64()).take(row),
                pa.array(found.project(x).ravel()), pa.array(np.tile(found.values / found.trace, m)), pa.array(np.full(m * k, error)),
            ], names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.where(F.size("x") == most["d"]).mapInArrow(run, schema)


@query("op13_whitening", exact=True)
def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whiten(spark.read.parquet(f"{folder}/embeddings.parquet"))

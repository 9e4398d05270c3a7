"""What the operators of this subpackage share: folds, texts of Arrow batches, words as numpy hashes.

Texts are handled whole. Arrow batches are cut into chunks of whole documents, so the numpy
temporaries of a task are bounded by the larger of `CHUNK_BYTES` and its longest document.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Hashable, Iterable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHUNK_BYTES = 2 << 20

# Fixed value: the separators of the contract's word pattern `[^\x20\x09-\x0D]+`.
WORD_SEPARATORS = b"\x20\x09\x0a\x0b\x0c\x0d"
WORD_SPLIT = r"[\x20\x09-\x0D]+"

_P = np.uint64(0x9E3779B97F4A7C15 - 2)  # odd, = 3 mod 8, so differences of powers keep their low bits
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def held_out(doc_id: Column) -> Column:
    """The test fold: crc32 of the id as text leaves remainder 2 modulo 4; a null id is in no fold."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def trainable(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 != 2, F.lit(False))


def words_of(text: Column) -> Column:
    """Words of a text as an array; a null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WORD_SPLIT), "")


BROADCAST_ROWS = 500_000  # of a few numbers each: some tens of MB on an executor


def bounded(keys: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Staged narrow rows, marked for a broadcast if they are few; joins shuffle both sides if not."""
    return F.broadcast(keys) if keys.count() <= limit else keys


def with_made(df: DataFrame, keep: tuple[str, ...] | list[str], text: str, made: dict[str, T.DataType],
              run: Callable[[pa.Array], list[pa.Array]]) -> DataFrame:
    """`keep` and the columns that `run` makes from batches of the text column.

    The text crosses to Python once, also if it is kept. Columns go by place, so a name may be
    that of any other column.
    """
    keep = list(keep)
    place = keep.index(text) if text in keep else len(keep)
    picked = df.select(*[df[k] for k in (keep if text in keep else [*keep, text])])
    picked = picked.toDF(*[f"c{i}" for i in range(len(picked.columns))])
    fields = [*picked.schema.fields[: len(keep)], *[T.StructField(f"m{i}", kind) for i, kind in enumerate(made.values())]]
    names, width = [f.name for f in fields], len(keep)

    def batchwise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(width)), *run(batch.column(place))], names=names)

    return picked.mapInArrow(batchwise, T.StructType(fields)).toDF(*keep, *made)


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """`then(value)` with `value` worked out once, however often `then` uses it.

    A later filter on the result may be pushed below the projection and take the expression
    along; bound this way, it is evaluated once more and not once for each use.
    """
    return F.get(F.transform(F.array(value), then), 0)


_KEPT: dict[Hashable, Any] = {}  # of this worker process


def kept(name: Hashable, make: Callable[[], Any]) -> Any:
    """What `make` returns, kept by the worker process until other tables are asked for.

    Workers outlive stages: without this the tables of one operator would stand beside those of the next.
    """
    if name not in _KEPT:
        _KEPT.clear()  # before the new ones are made
        _KEPT[name] = make()
    return _KEPT[name]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


_BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))


class _Powers:
    """Powers of the base and of its inverse modulo 2^64, extended as longer inputs come."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) <= n:
            n = max(n + 1, 2 * len(self.up), 1 << 16)
            inverse = np.uint64(pow(int(_P), -1, 1 << 64))
            with np.errstate(over="ignore"):
                self.up = np.cumprod(np.r_[np.uint64(1), np.full(n, _P)])
                self.down = np.cumprod(np.r_[np.uint64(1), np.full(n, inverse)])
        return self.up, self.down


_POWERS = _Powers()


class RangeHash:
    """Hashes of any ranges of `data`, bytes or hashes of words, equal for equal ranges, whatever their place."""

    def __init__(self, data: np.ndarray) -> None:
        self.up, down = _POWERS.to(len(data))
        self.sums = np.zeros(len(data) + 1, np.uint64)
        values = _BYTE_VALUES[data] if data.dtype == np.uint8 else data
        np.cumsum(values * down[: len(data)], out=self.sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.up[end]

    def windows(self, width: int) -> np.ndarray:
        """The hash of every stretch of `width` bytes."""
        n = len(self.sums) - width
        return (self.sums[width:] - self.sums[:n]) * self.up[width : width + n] if n > 0 else np.zeros(0, np.uint64)


BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def bound_batches(spark: SparkSession, limit: int = CHUNK_BYTES) -> None:
    """From now on Spark hands Python workers batches of about `limit` bytes (more for one longer row).

    By default a batch has 10,000 rows, whatever their length; it stands in the executor's native memory
    and in the worker at the same time. A lower limit of the session stays.
    """
    own = spark.conf.get(BATCH_BYTES, None)
    if own is None or not own.isdigit() or int(own) > limit:
        spark.conf.set(BATCH_BYTES, str(limit))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts of an Arrow column as one byte array and its offsets; null reads as empty."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole, at


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive document ranges of at most `limit` bytes, or of one document."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi


def give_back() -> None:
    """Return what this worker process has freed to the system: it stays alive between tasks, beside the executor's heap."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:  # glibc
        trim(0)


def sliced(batches: Iterable[pa.RecordBatch], text: int, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """All rows, in parts of at most `limit` bytes of the text column at place `text` (more for one longer text).

    What a task makes of a part and sends on is bounded that way, and what it used is given back at its end.
    """
    try:
        for batch in batches:
            for lo, hi in chunks(text_bytes(batch.column(text))[1], limit):
                yield batch.slice(lo, hi - lo)
    finally:
        give_back()


_IS_SEPARATOR = np.zeros(256, bool)
_IS_SEPARATOR[list(WORD_SEPARATORS)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Words:
    """The words of consecutive documents: byte bounds, owner, 64-bit hash.

    `lower` folds A-Z. `first[d]:first[d + 1]` are the words of document d.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = True, separator: np.ndarray = _IS_SEPARATOR) -> None:
        base, end = int(offsets[0]), int(offsets[-1])
        part, at = data[base:end], offsets - base
        if lower:
            part = _LOWER[part]
        gap = separator[part]
        # a document's first byte starts a word even if the one before it ends none
        edge = np.zeros(len(part) + 1, bool)
        edge[at] = True
        inside = ~gap
        begins = inside.copy()
        begins[1:] &= gap[:-1] | edge[1:-1]
        ends = inside.copy()
        ends[:-1] &= gap[1:] | edge[1:-1]
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.start, at)
        self.hash = mix(RangeHash(part)(self.start, self.end))
        self.data = part

    def owners(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

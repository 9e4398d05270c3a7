"""Language identification: multinomial naive Bayes over hashed character n-grams.

Texts are folded to lower-case letters, every run of anything else to one blank. All n-grams
of one to three characters, blanks at both ends included, go to a fixed number of buckets.
The classifier is fitted on a bounded sample of labelled rows (`per_language` rows of each
language, those with the smallest hash of their id); the matrix of log-probabilities, one
row per language, is broadcast (languages x buckets x 4 bytes) and whole texts are scored in
numpy: only n-grams that occur are looked up and added.

Defined results: `und` with score 0 for a null text, a text without letters, or if nothing
was learned; a tie goes to the language that sorts first; rows with a null or unfit id are
scored but never learned from; repeated rows give equal rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartloom.llm.catalog import query
from chartloom.llm.common import bounded, chunks, documents, held_out, kept, sliced, text_bytes, trainable, with_made
from chartloom.sinks.staging import stage

UNDETERMINED = "und"
ORDERS = (1, 2, 3)
BUCKET_BITS = 16
SLICES = 64  # of a language, ranked apart
PER_LANGUAGE = 1500  # the documented bound of the training sample: rows per language
SMOOTHING = 0.5
SLICE_BYTES = 256 << 10  # of text, whose n-grams are at hand at once (more for one longer text)

_BLANK = 32


def _folding() -> np.ndarray:
    """Code point -> its lower-case letter, or a blank for what is no letter."""
    def made() -> np.ndarray:
        table = np.full(0x110000, _BLANK, np.uint32)
        for point in range(0x110000):
            letter = chr(point)
            if letter.isalpha():
                low = letter.lower()
                table[point] = ord(low) if len(low) == 1 else point
        return table

    return kept("folding", made)


def grams(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order: the buckets of all n-grams of consecutive documents, and their owners' starts.

    Yields (buckets, at) with `buckets[at[d]:at[d + 1]]` belonging to document d; a document
    without letters has none.
    """
    raw = data[offsets[0] : offsets[-1]]
    points = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    starts_before = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    at = starts_before[offsets - offsets[0]]
    # every document gets a blank in front; the one of the next document ends it
    letters = np.insert(_folding()[points], at, _BLANK)
    first = at + np.arange(len(at))
    blank = letters == _BLANK
    # of a run of blanks the last one stays: what ends a document is the blank in front of the next
    keep = np.ones(len(letters), bool)
    keep[:-1] = ~(blank[:-1] & blank[1:])
    shrunk = np.concatenate([[0], np.cumsum(keep)])
    bounds, line = shrunk[first], letters[keep].astype(np.uint64)
    has_letters = np.diff(bounds) > 1
    owner = np.repeat(np.arange(len(has_letters)), np.diff(bounds))
    for n in ORDERS:
        # grams start inside their document; the closing blank is the next document's first place
        size = max(min(len(line) - n + 1, len(owner)), 0)
        h = np.full(size, n, np.uint64)
        for i in range(n):
            h = (h + line[i : i + size]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        buckets = ((h * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - BUCKET_BITS)).astype(np.int32)
        # a gram of n characters from place i must end at the closing blank or before it
        inside = np.arange(n - 1, size + n - 1) <= bounds[1:][owner[:size]]
        inside &= has_letters[owner[:size]]
        if n == 1:
            inside &= line[:size] != _BLANK
        counts = np.bincount(owner[:size][inside], minlength=len(has_letters))
        yield buckets[inside], np.concatenate([[0], np.cumsum(counts)])


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    prior: np.ndarray  # log, by language
    weights: np.ndarray  # log, languages x buckets

    def score(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each document the place of its language (-1: none) and the posterior probability."""
        n = len(offsets) - 1
        total, found = np.tile(self.prior, (n, 1)), np.zeros(n, np.int64)
        for buckets, at in grams(data, offsets):
            own = np.flatnonzero(np.diff(at))
            found += np.diff(at)
            if len(own):
                for k in range(len(self.languages)):
                    total[own, k] += np.add.reduceat(self.weights[k][buckets], at[own], dtype=np.float64)
        if not self.languages:
            return np.full(n, -1), np.zeros(n)
        best = total.argmax(axis=1)
        share = np.exp(total - total.max(axis=1, keepdims=True))
        score = 1.0 / share.sum(axis=1)
        return np.where(found > 0, best, -1), np.where(found > 0, score, 0.0)


def training_rows(docs: DataFrame, fit_on: Column, per_language: int = PER_LANGUAGE) -> DataFrame:
    """Ids and texts of the sample: the rows of each language with the smallest id hashes.

    Ids alone are ranked, in two steps: each of `SLICES` parts of a language passes on at most
    `per_language` of them, so no task ever sees a whole language. Texts are not shuffled: the
    sample's ids are few and broadcast, unless there are very many languages.
    """
    hashed = docs.where(F.col("lang").isNotNull() & fit_on).select("doc_id", "lang", F.xxhash64("doc_id").alias("_hash"))
    for slices in (SLICES, 1):
        pick = Window.partitionBy("lang", F.pmod("_hash", F.lit(slices))).orderBy("_hash", "doc_id")
        hashed = hashed.withColumn("_rank", F.row_number().over(pick)).where(F.col("_rank") <= per_language)
    ids = bounded(stage(hashed.select("doc_id").distinct(), "language-sample"))
    return docs.where(F.col("lang").isNotNull() & fit_on).select("doc_id", "lang", "text").join(ids, "doc_id", "left_semi")


def fit(docs: DataFrame, fit_on: Column | None = None, per_language: int = PER_LANGUAGE) -> Model:
    """Count n-grams by language on the executors; languages x buckets sums reach the driver."""
    rows = training_rows(docs, trainable(F.col("doc_id")) if fit_on is None else fit_on, per_language)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            languages = np.array(batch.column(0).to_pylist(), dtype=object)
            for lo, hi in chunks(offsets, SLICE_BYTES):
                for lang in set(languages[lo:hi]):
                    sums.setdefault(lang, np.zeros((1 << BUCKET_BITS) + 1, np.int64))[-1] += (languages[lo:hi] == lang).sum()
                for buckets, at in grams(data, offsets[lo : hi + 1]):
                    owner = np.repeat(languages[lo:hi], np.diff(at))
                    for lang in set(languages[lo:hi]):
                        sums[lang][:-1] += np.bincount(buckets[owner == lang], minlength=1 << BUCKET_BITS)
        for lang, counts in sums.items():  # the last place holds the number of documents
            used = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(used), pa.string()), pa.array(used, pa.int64()), pa.array(counts[used], pa.int64())],
                names=["lang", "bucket", "n"])

    counted = rows.select("lang", "text").mapInArrow(count, "lang string, bucket bigint, n bigint")
    summed = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    languages = tuple(sorted(summed["lang"].unique()))
    table = np.zeros((len(languages), (1 << BUCKET_BITS) + 1))
    place = {lang: k for k, lang in enumerate(languages)}
    table[summed["lang"].map(place).to_numpy(int), summed["bucket"].to_numpy(int)] = summed["n"].to_numpy(float)
    seen = table[:, :-1] + SMOOTHING
    weights = np.log(seen / seen.sum(axis=1, keepdims=True)).astype(np.float32)
    prior = np.log(table[:, -1] / max(table[:, -1].sum(), 1.0))
    return Model(languages, prior, weights)


def predict(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",), text: str = "text",
            pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """`keep` and the predicted language and its posterior probability, for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scored(texts: pa.Array) -> list[pa.Array]:
        names = np.array([*shared.value.languages, UNDETERMINED], dtype=object)
        best, scores = _scored(shared.value, texts)
        return [pa.array(names[best].tolist(), pa.string()), pa.array(scores, pa.float64())]

    return with_made(docs, keep, text, {pred: T.StringType(), score: T.DoubleType()}, scored)


def keep_sure(docs: DataFrame, model: Model, least: float, text: str = "text") -> DataFrame:
    """The rows, as they are, whose language has at least the score `least`."""
    shared, place = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, place):
            best, scores = _scored(shared.value, batch.column(place))
            yield batch.filter(pa.array((best >= 0) & (scores >= least)))

    return docs.mapInArrow(run, docs.schema)


def _scored(model: Model, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = text_bytes(texts)
    found = [model.score(data, offsets[lo : hi + 1]) for lo, hi in chunks(offsets, SLICE_BYTES)]
    if not found:
        return np.zeros(0, int), np.zeros(0)
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


@query("op1_language_id")
def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    return predict(docs, fit(docs)).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")

"""Toxicity: a linear-chain conditional random field over words, aggregated to documents.

Only documents are labelled, so word labels are derived first: on a bounded sample of the
labelled rows, features (a word, its first 4, 5 and 6 bytes) that occur in many toxic and
hardly any clean documents mark words as toxic; only these features get weights. The field is trained on these sequences: two
states, hashed feature weights, a bias, four transition weights. Forward-backward gives each
word's probability of being toxic. A document's score is a logistic function, fitted on the
same sample's document labels, of the expected number of toxic words and the largest
probability. Spans are runs of words above one half.

Defined results: a null or empty text has no words, and the score of none; without both
labels in the sample every score is the share of toxic rows (0.5 if there are no rows); null
labels are not learned from; of an id with several labels the largest counts; rows with a
null id are scored but not learned from; repeated rows give equal rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartloom.llm.catalog import query
from chartloom.llm.common import RangeHash, Words, chunks, documents, held_out, mix, text_bytes, trainable, with_made

FILTER_BITS = 22
PREFIXES = (4, 5, 6)  # bytes
SAMPLE_TOXIC, SAMPLE_CLEAN = 900, 1500  # the documented bound of the training sample, in rows
MIN_SHARE, MIN_ODDS = 0.015, 3.0  # of toxic documents with the feature; log-odds against clean ones
ROUNDS, RATE, RIDGE = 25, 1.0, 1e-3
THRESHOLD = 0.3
BATCH_BYTES = 8 << 20

# words are runs of letters, digits and non-ASCII bytes
_BREAK = np.zeros(256, bool)
_BREAK[:0x30] = _BREAK[0x3A:0x61] = _BREAK[0x7B:0x80] = True


@dataclass
class Sequences:
    """Feature hashes (words x features, 0: none) of consecutive documents, and word bounds in bytes."""

    features: np.ndarray
    first: np.ndarray
    start: np.ndarray
    end: np.ndarray


def sequences(data: np.ndarray, offsets: np.ndarray) -> Sequences:
    """Hash the words of documents; bounds are bytes from the start of each document."""
    features, counts, starts, ends = [], [], [], []
    for lo, hi in chunks(offsets):
        words = Words(data, offsets[lo : hi + 1], separator=_BREAK)
        hashes = RangeHash(words.data)
        own = [words.hash]
        size = words.end - words.start
        for k in PREFIXES:  # a word that is not longer has no such feature
            h = mix(hashes(words.start, np.minimum(words.start + k, words.end)) + np.uint64(k))
            own.append(np.where(size > k, h, np.uint64(0)))
        features.append(np.stack(own, axis=1))
        counts.append(np.diff(words.first))
        base = (offsets[lo:hi] - offsets[lo])[words.owners()]
        starts.append(words.start - base)
        ends.append(words.end - base)
    if not features:
        return Sequences(np.zeros((0, 1 + len(PREFIXES)), np.uint64), np.zeros(1, int), np.zeros(0, int), np.zeros(0, int))
    first = np.concatenate([[0], np.cumsum(np.concatenate(counts))])
    return Sequences(np.concatenate(features), first, np.concatenate(starts), np.concatenate(ends))


def forward_backward(emission: np.ndarray, first: np.ndarray, a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ratios toxic : clean of forward and of backward sums, word by word.

    All documents advance together, the longest first, so that step t touches those that
    have a word t. `emission` and `a` (2 x 2) are factors, not logarithms.
    """
    lengths = np.diff(first)
    order = np.argsort(-lengths, kind="stable")
    begin, sizes = first[:-1][order], lengths[order]
    forward, backward = np.empty_like(emission), np.ones_like(emission)
    longest = int(sizes[0]) if len(sizes) else 0
    alive = np.searchsorted(-sizes, -np.arange(longest), "left")  # documents with more than t words
    ratio = np.empty(0)
    for t in range(longest):
        at = begin[: alive[t]] + t
        if t:
            ratio = ratio[: alive[t]]
            ratio = emission[at] * (a[0, 1] + a[1, 1] * ratio) / (a[0, 0] + a[1, 0] * ratio)
        else:
            ratio = emission[at]
        forward[at] = ratio
    finish = first[1:][order] - 1
    for t in range(1, longest):
        at = finish[: alive[t]] - t
        ahead = emission[at + 1] * backward[at + 1]
        backward[at] = (a[1, 0] + a[1, 1] * ahead) / (a[0, 0] + a[0, 1] * ahead)
    return forward, backward


def find(known: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of hashes in a sorted array, and which of them are really there."""
    if not len(known):
        return np.zeros(len(hashes), int), np.zeros(len(hashes), bool)
    place = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    return place, known[place] == hashes


@dataclass
class Tagger:
    known: np.ndarray  # sorted hashes of the features that have a weight
    weights: np.ndarray
    bias: float
    transitions: np.ndarray  # logarithms, 2 x 2
    document: np.ndarray  # logistic: constant, log1p(expected toxic words), largest probability

    def __post_init__(self) -> None:
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        self.filter[self.known >> np.uint64(64 - FILTER_BITS)] = True

    def emission(self, features: np.ndarray) -> np.ndarray:
        """exp(bias + weights of the word's features): a bit table first, an exact look-up for what passes it."""
        word, k = np.nonzero(self.filter[features >> np.uint64(64 - FILTER_BITS)])
        total = np.full(len(features), self.bias)
        if len(word):
            place, exact = find(self.known, features[word, k])
            total += np.bincount(word[exact], self.weights[place[exact]], len(features))
        return np.exp(np.clip(total, -30, 30))

    def marginals(self, seq: Sequences) -> np.ndarray:
        """The probability of each word to be toxic."""
        forward, backward = forward_backward(self.emission(seq.features), seq.first, np.exp(self.transitions))
        odds = forward * backward
        return odds / (1 + odds)

    def summary(self, p: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Per document: 1, log1p(expected toxic words), largest probability."""
        out = np.zeros((len(first) - 1, 3))
        out[:, 0] = 1
        own = np.flatnonzero(np.diff(first))
        if len(own):
            out[own, 1] = np.log1p(np.add.reduceat(p, first[own]))
            out[own, 2] = np.maximum.reduceat(p, first[own])
        return out

    def scores(self, p: np.ndarray, first: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.summary(p, first) @ self.document, -30, 30)))


def copy_groups(seq: Sequences, toxic: np.ndarray) -> np.ndarray:
    """A number for each document; documents whose smallest hash of two neighbouring words is equal share it."""
    word = seq.features[:, 0]
    least = mix(word[:-1] * np.uint64(3) + word[1:])
    smallest = np.zeros(len(toxic), np.uint64)
    for d, (lo, hi) in enumerate(zip(seq.first[:-1], seq.first[1:])):
        smallest[d] = least[lo : hi - 1].min() if hi - lo > 1 else np.uint64(d)
    return np.unique(smallest, return_inverse=True)[1].astype(np.int64)


def toxic_features(seq: Sequences, toxic: np.ndarray) -> np.ndarray:
    """Hashes of features that many toxic and hardly any clean documents have, sorted.

    A prefix counts only if it does not merely stand for one word: half as many documents
    again must have it as have the most common of its words. Copies count once, or else the
    words of a text that was copied often would pass.
    """
    names, place = np.unique(seq.features, return_inverse=True)
    place = place.reshape(seq.features.shape)
    copies = copy_groups(seq, toxic)
    of = np.repeat(copies * 2 + toxic, np.diff(seq.first))  # the group and the label of each word
    n, m = max(len(np.unique(copies[toxic == 1])), 1), max(len(np.unique(copies[toxic == 0])), 1)
    pairs = np.unique(place.astype(np.int64) * (of.max() + 1) + of[:, None])
    label, feature = pairs % (of.max() + 1) % 2, pairs // (of.max() + 1)
    having = np.bincount(feature[label == 1], minlength=len(names))
    clean = np.bincount(feature[label == 0], minlength=len(names))
    odds = np.log((having + 0.5) / (n + 1)) - np.log((clean + 0.5) / (m + 1))
    marks = (having >= max(3, MIN_SHARE * n)) & (odds >= MIN_ODDS) & (names != 0)
    most = np.zeros(len(names), np.int64)
    for k in range(1, place.shape[1]):
        some = marks[place[:, k]] & (of % 2 == 1)
        np.maximum.at(most, place[some, k], having[place[some, 0]])
    return names[marks & (having >= 1.5 * most)]


def train(seq: Sequences, toxic: np.ndarray) -> Tagger:
    """Maximise the likelihood of the derived word labels, then fit the document function."""
    share = (toxic.sum() + 0.0) / max(len(toxic), 1) if len(toxic) else 0.5
    constant = np.log(max(share, 1e-6) / max(1 - share, 1e-6))
    tagger = Tagger(np.zeros(0, np.uint64), np.zeros(0), -3.0, np.zeros((2, 2)), np.array([constant, 0.0, 0.0]))
    if not len(toxic) or share in (0.0, 1.0) or not len(seq.features):
        return tagger
    used = toxic_features(seq, toxic)
    place, exact = find(used, seq.features.ravel())
    word = np.flatnonzero(exact) // seq.features.shape[1]  # the words that have a feature with a weight
    feature = place[exact]
    y = (np.bincount(word, minlength=len(seq.features)) > 0) * np.repeat(toxic, np.diff(seq.first)).astype(float)
    count = np.bincount(feature, minlength=len(used))
    w, grown = np.zeros(len(used)), np.full(len(used), 1e-8)
    small, small_grown = np.array([-3.0, 0, 0, 0, 0]), np.full(5, 1e-8)  # bias and transitions
    inner = np.ones(len(y), bool)
    inner[seq.first[1:][np.diff(seq.first) > 0] - 1] = False
    i = np.flatnonzero(inner)  # words with a successor in their document
    for _ in range(ROUNDS):
        emission = np.exp(np.clip(np.bincount(word, w[feature], len(y)) + small[0], -30, 30))
        a = np.exp(small[1:].reshape(2, 2))
        forward, backward = forward_backward(emission, seq.first, a)
        p = forward * backward / (1 + forward * backward)
        miss = y - p
        slope = np.bincount(feature, miss[word], len(used)) - RIDGE * count * w
        ahead = emission[i + 1] * backward[i + 1]
        joint = np.stack([np.full(len(i), a[0, 0]), a[0, 1] * ahead, forward[i] * a[1, 0], forward[i] * a[1, 1] * ahead])
        joint /= joint.sum(axis=0)
        was, comes = y[i], y[i + 1]
        seen = np.array([((1 - was) * (1 - comes)).sum(), ((1 - was) * comes).sum(), (was * (1 - comes)).sum(), (was * comes).sum()])
        small_slope = np.r_[miss.sum(), seen - joint.sum(axis=1)] - 1.0 * np.r_[0, small[1:]]
        grown += slope**2
        small_grown += small_slope**2
        w += RATE * slope / np.sqrt(grown)
        small += 0.5 * RATE * small_slope / np.sqrt(small_grown)
    tagger = Tagger(used, w, float(small[0]), small[1:].reshape(2, 2), tagger.document)
    x, target = tagger.summary(tagger.marginals(seq), seq.first), toxic.astype(float)
    for _ in range(30):  # Newton steps with a ridge: three numbers
        q = 1 / (1 + np.exp(-np.clip(x @ tagger.document, -30, 30)))
        h = (x * (q * (1 - q))[:, None]).T @ x + np.diag([1e-3, 0.05, 0.05])
        tagger.document = tagger.document + np.linalg.solve(h, x.T @ (target - q) - np.array([1e-3, 0.05, 0.05]) * tagger.document)
    return tagger


def training_rows(docs: DataFrame, labels: DataFrame, toxic: int = SAMPLE_TOXIC, clean: int = SAMPLE_CLEAN) -> DataFrame:
    """Texts and labels of the sample: of each label the rows with the smallest id hashes.

    The ids are at most `toxic + clean`, so they are broadcast and no text is shuffled to find them.
    """
    known = (
        labels.where(F.col("toxic").isin(0, 1) & trainable(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    )

    def least(label: int, most: int) -> DataFrame:
        return known.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)

    ids = F.broadcast(least(1, toxic).union(least(0, clean)))
    return docs.select("doc_id", "text").join(ids, "doc_id").select("doc_id", "text", "toxic")


def fit(docs: DataFrame, labels: DataFrame) -> Tagger:
    """The sample's words are hashed on the executors; only hashes and labels reach the driver."""
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seq = sequences(*text_bytes(batch.column(1)))
            own = [seq.features[seq.first[d] : seq.first[d + 1]].tobytes() for d in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(own, pa.binary()), batch.column(2)],
                                             names=["doc_id", "features", "toxic"])

    # one row per id: of repeated ids the first text in order
    rows = training_rows(docs, labels).groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").cast("int").alias("toxic"))
    found = rows.mapInArrow(hashed, "doc_id bigint, features binary, toxic int").orderBy("doc_id").toPandas()
    width = 1 + len(PREFIXES)
    own = [np.frombuffer(raw, np.uint64).reshape(-1, width) for raw in found["features"]]
    features = np.concatenate(own) if own else np.zeros((0, width), np.uint64)
    first = np.concatenate([[0], np.cumsum([len(x) for x in own])]).astype(int)
    nothing = np.zeros(len(features), int)
    return train(Sequences(features, first, nothing, nothing), found["toxic"].to_numpy(int))


def score(docs: DataFrame, tagger: Tagger, keep: tuple[str, ...] = ("doc_id",), text: str = "text", with_spans: bool = False) -> DataFrame:
    """`keep` and the score of each row's whole text; with spans also the byte bounds of toxic runs."""
    shared = docs.sparkSession.sparkContext.broadcast(tagger)  # 4 MB and one weight per known feature

    def run(texts: pa.Array) -> list[pa.Array]:
        model, scores, runs = shared.value, [np.zeros(0)], []
        data, offsets = text_bytes(texts)
        for lo, hi in chunks(offsets, BATCH_BYTES):
            seq = sequences(data, offsets[lo : hi + 1])
            p = model.marginals(seq)
            scores.append(model.scores(p, seq.first))
            if with_spans:
                runs += toxic_runs(seq, p)
        spans = [pa.array(runs, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))] if with_spans else []
        return [pa.array(np.concatenate(scores), pa.float64()), *spans]

    span = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
    return with_made(docs, keep, text, {"score": T.DoubleType()} | ({"toxic_spans": T.ArrayType(span)} if with_spans else {}), run)


def toxic_runs(seq: Sequences, p: np.ndarray) -> list[list[dict[str, int]]]:
    """Per document the byte bounds of runs of words above one half."""
    out = []
    for lo, hi in zip(seq.first[:-1], seq.first[1:]):
        hot = np.flatnonzero(np.diff(np.concatenate([[0], p[lo:hi] > 0.5, [0]]).astype(int)))
        out.append([{"start": int(seq.start[lo + b]), "end": int(seq.end[lo + e - 1])} for b, e in hot.reshape(-1, 2)])
    return out


@query("op8_toxicity", exact=True)
def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    tagger = fit(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    # spans are byte bounds of the offending runs of words
    spans = F.array_join(F.transform("toxic_spans", lambda s: F.concat_ws(":", s["start"], s["end"])), ",")
    return score(docs, tagger, with_spans=True).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"), spans.alias("toxic_spans"))

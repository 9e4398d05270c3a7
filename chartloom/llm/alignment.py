"""Alignment of two tokenizers over the same bytes, with corpus-wide counts of linked id pairs.

Every text is encoded by a byte-level BPE (A, of a blank and the text) and by a piece model
(B, which adds that blank). A chunk of documents then stays in Arrow: the lists of ids are
flattened with their parent indices, token lengths are summed up within each document, and
an outer hash join on (document, end) brings the ends of both sides together. In the order
of ends, each row is one overlap of an A token with a B token: the one that ends there, or
the next to end. Rows where both end close a group.

Id pairs are counted by `group_by` within a chunk, and Spark adds up these partial counts.
The staged table holds a document's links as places in its chunk's list of pairs, so to
find their corpus-wide counts only the lists are joined, and the documents of a chunk meet
that chunk's list again. Nothing but the best count of each B id, a row per entry of a fixed
vocabulary, is broadcast.

Defined results: texts that are null or empty, or that one of the tokenizers does not give
back byte by byte, have no tokens: zeros and an empty digest; repeated rows are counted
each, and give equal rows; rows with a null id as well; other columns are ignored. A chunk
is cut by bytes, between documents.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartloom.llm.catalog import query
from chartloom.llm.common import chunks, documents, text_bytes
from chartloom.sinks.staging import stage

A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
END_BITS = 40  # of a key: the place in a document; the rest is the document
LONG_TEXT = 1 << 20  # characters; longer texts go to the library that splits them without recursion

# Fixed value: the marker that pieces have for a blank.
BLANK_PIECE = "▁"


def byte_letters() -> dict[str, int]:
    """The letters by which byte-level vocabularies write bytes: printable ones as they are, the others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@dataclass
class Side:
    """One tokenizer: ids of texts, and the bytes of every id."""

    encode: callable
    tokens: pa.Array
    lengths: pa.Array

    @staticmethod
    def of(encode, tokens: list[bytes]) -> Side:
        return Side(encode, pa.array(tokens, pa.binary()), pa.array([len(t) for t in tokens], pa.int64()))


def byte_side(path: str, pattern: str) -> Side:
    """A byte-level BPE from its JSON file; special tokens in a text are plain text.

    Where the file numbers tokens in the order of its merges, ranks are ids and the faster
    of two libraries gives the same result.
    """
    import tiktoken
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as file:
        read = json.load(file)
    model, letter = read["model"], byte_letters()
    special = {t["content"] for t in read["added_tokens"] if t["special"]}
    ids = {t: i for t, i in model["vocab"].items() if t not in special}
    tokens = [b""] * (1 + max([*ids.values(), *(t["id"] for t in read["added_tokens"])]))
    for token, i in ids.items():
        tokens[i] = bytes(letter[c] for c in token)
    merged = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in model["merges"]]
    plain = Tokenizer.from_file(path)
    plain.encode_special_tokens = True
    ranked = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks={tokens[i]: i for i in ids.values()}, special_tokens={})
    in_order = all(ids[m] == 256 + i for i, m in enumerate(merged)) and read["normalizer"] is None

    def encode(texts: list[str]) -> list[list[int]]:
        if in_order:
            return [ranked.encode_ordinary(" " + t) if len(t) < LONG_TEXT else plain.encode(" " + t, add_special_tokens=False).ids for t in texts]
        return [e.ids for e in plain.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]

    return Side.of(encode, tokens)


def piece_side(path: str) -> Side:
    """A piece model with byte fallback; it puts a blank in front of a text by itself."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    tokens = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        tokens.append(bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace(BLANK_PIECE, " ").encode())
    return Side.of(lambda texts: model.encode(texts, num_threads=1), tokens)


_SIDES: dict[tuple[str, str, str], tuple[Side, Side]] = {}  # of this worker process


def sides(a_path: str, b_path: str, pattern: str) -> tuple[Side, Side]:
    if (a_path, b_path, pattern) not in _SIDES:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        pa.set_cpu_count(1)  # a task has one core
        _SIDES[a_path, b_path, pattern] = byte_side(a_path, pattern), piece_side(b_path)
    return _SIDES[a_path, b_path, pattern]


def lists_of(ids: list[list[int]]) -> pa.ListArray:
    at = np.concatenate([[0], np.cumsum([len(i) for i in ids], dtype=np.int64)])
    flat = np.fromiter((i for own in ids for i in own), np.int32, at[-1])
    return pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(flat))


def given_back(ids: pa.ListArray, side: Side, texts: list[str]) -> np.ndarray:
    """For each document whether its tokens' bytes are a blank and the text."""
    taken = side.tokens.take(ids.flatten())
    data = taken.buffers()[2]
    data = data.to_pybytes() if data is not None else b""
    at = np.frombuffer(taken.buffers()[1], np.int32) if len(taken) else np.zeros(1, np.int32)
    bounds = at[np.asarray(ids.offsets)].tolist()
    return np.array([data[b:e] == b" " + t.encode() for b, e, t in zip(bounds, bounds[1:], texts)], bool)


def keyed(ids: pa.ListArray, side: Side, name: str) -> pa.Table:
    """(document, end within it) as one key, and the id that ends there."""
    flat, parent = ids.flatten(), pc.list_parent_indices(ids).cast(pa.int64())
    running = pc.cumulative_sum(side.lengths.take(flat))
    before = pa.array(np.concatenate([[0], running.to_numpy(zero_copy_only=False)])[np.asarray(ids.offsets)[:-1]])
    end = pc.subtract(running, before.take(parent))  # the sum starts anew in each document
    return pa.table({"key": pc.add(pc.shift_left(parent, pa.scalar(END_BITS, pa.int64())), end), name: flat})


def overlaps(a: pa.ListArray, b: pa.ListArray, a_side: Side, b_side: Side) -> pa.Table:
    """doc, a, b and the ids covering each stretch (a_over, b_over), in the order of the stretches' ends; a or b is null where it does not end."""
    both = keyed(a, a_side, "a").join(keyed(b, b_side, "b"), keys="key", join_type="full outer", use_threads=False)
    both = both.sort_by("key").combine_chunks()
    # every stretch lies in the token that ends there or in the next to end; both sides end with the document
    over = {f"{side}_over": pc.fill_null_backward(both[side]) for side in ("a", "b")}
    doc = pc.shift_right(both["key"], pa.scalar(END_BITS, pa.int64()))
    return pa.table({"doc": doc, "a": both["a"], "b": both["b"], **over})


def group_texts(met: pa.Table, n: int) -> list[str]:
    """For each document `a1,a2|b1;a3|b2,b3`: the ids of its groups."""
    common = pc.and_(met["a"].is_valid(), met["b"].is_valid()).to_numpy()
    sides_ = []
    for name in ("a", "b"):
        valid = met[name].is_valid().to_numpy()
        at = np.concatenate([[0], np.cumsum(valid)[common]])
        ids = met[name].drop_null().cast(pa.string()).combine_chunks()
        sides_.append(pc.binary_join(pa.ListArray.from_arrays(pa.array(at, pa.int32()), ids), ","))
    groups = pc.binary_join_element_wise(*sides_, "|")
    counts = np.bincount(met["doc"].to_numpy()[common], minlength=n)
    at = np.concatenate([[0], np.cumsum(counts)])
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(at, pa.int32()), groups), ";").to_pylist()


STAGED = pa.schema([
    ("chunk", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()),
    ("groups_sha256", pa.string()), ("links", pa.list_(pa.int32())), ("pairs", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64()))])
STAGED_SQL = ("chunk bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string,"
              " links array<int>, pairs array<bigint>, counts array<bigint>")


def aligned_chunk(chunk: int, doc_ids: pa.Array, texts: list[str], a_side: Side, b_side: Side) -> list[pa.RecordBatch]:
    """Rows of the documents, and one row with the chunk's id pairs and how often each is linked."""
    n = len(texts)
    some = [d for d in range(n) if texts[d]]
    own = [texts[d] for d in some]
    a, b = lists_of(a_side.encode(own)), lists_of(b_side.encode(own))
    whole = given_back(a, a_side, own) & given_back(b, b_side, own)
    place, mask = np.array(some, np.int64)[whole], pa.array(whole, pa.bool_())
    a, b = a.filter(mask), b.filter(mask)
    columns = {name: np.zeros(n, np.int64) for name in ("n_a", "n_b", "n_groups", "n_links")}
    digests, links, rows = [""] * n, np.zeros(0, np.int32), []
    if len(place):
        met = overlaps(a, b, a_side, b_side)
        doc = met["doc"].to_numpy()
        common = pc.and_(met["a"].is_valid(), met["b"].is_valid()).to_numpy()
        columns["n_a"][place], columns["n_b"][place] = (np.diff(np.asarray(side.offsets)) for side in (a, b))
        columns["n_links"][place] = np.bincount(doc, minlength=len(place))
        columns["n_groups"][place] = np.bincount(doc[common], minlength=len(place))
        for d, text in zip(place.tolist(), group_texts(met, len(place))):
            digests[d] = hashlib.sha256(text.encode()).hexdigest()
        pair = pc.add(pc.multiply(met["a_over"].cast(pa.int64()), pa.scalar(len(b_side.tokens), pa.int64())), met["b_over"].cast(pa.int64()))
        counted = pa.table({"pair": pair}).group_by("pair", use_threads=False).aggregate([("pair", "count")])
        counted = counted.sort_by([("pair_count", "descending"), ("pair", "ascending")])  # small places for frequent pairs
        listed = counted["pair"].combine_chunks()
        links = pc.index_in(pair, value_set=listed).to_numpy()
        one = [pa.nulls(1, t.type) for t in STAGED]
        one[0] = pa.array([chunk], pa.int64())
        ends = pa.array([0, len(listed)], pa.int32())
        one[-2:] = [pa.ListArray.from_arrays(ends, values) for values in (listed, counted["pair_count"].combine_chunks())]
        rows.append(pa.RecordBatch.from_arrays(one, schema=STAGED))
    at = pa.array(np.concatenate([[0], np.cumsum(columns["n_links"])]), pa.int32())
    rows.append(pa.RecordBatch.from_arrays([
        pa.array(np.full(n, chunk, np.int64)), doc_ids.cast(pa.int64()), *[pa.array(c) for c in columns.values()], pa.array(digests, pa.string()),
        pa.ListArray.from_arrays(at, pa.array(links, pa.int32())), pa.nulls(n, STAGED.field("pairs").type), pa.nulls(n, STAGED.field("counts").type)],
        schema=STAGED))
    return rows


def align_chunks(docs: DataFrame, a_path: str, b_path: str, pattern: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The staged rows of every chunk. Chunks are numbered within the task, so a table of them must be written once and reread."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a_side, b_side = sides(a_path, b_path, pattern)
        chunk = TaskContext.get().partitionId() << 32
        for batch in batches:
            _, offsets = text_bytes(batch.column(1))
            for lo, hi in chunks(offsets):
                yield from aligned_chunk(chunk, batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo).to_pylist(), a_side, b_side)
                chunk += 1

    return docs.select(docs[doc_id].cast("long"), docs[text]).mapInArrow(run, STAGED_SQL)


RESULT = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
RESULT_SQL = ", ".join(f"{c} {'string' if c == 'groups_sha256' else 'bigint'}" for c in RESULT)


def _counted(docs: pa.Table, pairs: pa.Table) -> pa.Table:
    """The documents of one chunk with the corpus-wide counts of their links."""
    total, best = np.zeros(pairs.num_rows, np.int64), np.zeros(pairs.num_rows, np.int64)
    place = pairs["place"].to_numpy()
    total[place], best[place] = pairs["total"].to_numpy(), pairs["best"].to_numpy()
    links = docs["links"].combine_chunks()
    at, flat = np.asarray(links.offsets), links.values.to_numpy()
    sums = [np.concatenate([[0], np.cumsum(values[flat])])[at] for values in (best, total)]
    out = docs.drop_columns(["chunk", "links"])
    return out.append_column("n_best", pa.array(np.diff(sums[0]))).append_column("count_sum", pa.array(np.diff(sums[1]))).select(list(RESULT))


def align(docs: DataFrame, a_path: str, b_path: str, pattern: str, b_size: int) -> DataFrame:
    """One row a document: tokens of both sides, groups, links, and what the links' corpus-wide counts add up to.

    `b_size` is the number of entries of B's vocabulary.
    """
    staged = stage(align_chunks(docs, a_path, b_path, pattern), "alignment")
    partial = staged.where("pairs IS NOT NULL").select(F.col("chunk").alias("of"), F.posexplode(F.arrays_zip("pairs", "counts")).alias("place", "own")).select(
        "of", "place", F.col("own.pairs").alias("pair"), F.col("own.counts").alias("n"))
    totals = stage(
        partial.groupBy("pair").agg(F.sum("n").alias("total")).withColumn("b", F.pmod("pair", F.lit(b_size)).cast("int")), "pair-totals")
    highest = totals.groupBy("b").agg(F.max("total").alias("most"))  # at most `b_size` rows
    known = totals.join(F.broadcast(highest), "b").select("pair", "total", (F.col("total") == F.col("most")).cast("long").alias("best"))
    lists = partial.select("of", "place", "pair").join(known, "pair").select("of", "place", "total", "best")
    rows = staged.where("pairs IS NULL").select("chunk", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links")
    return rows.groupBy("chunk").cogroup(lists.groupBy("of")).applyInArrow(_counted, RESULT_SQL)


def pair_counts(docs: DataFrame, a_path: str, b_path: str, pattern: str, b_size: int) -> DataFrame:
    """a, b, n: how often each pair of ids is linked in all documents, e.g. to map one vocabulary to the other."""
    chunk = align_chunks(docs, a_path, b_path, pattern).where("pairs IS NOT NULL")
    own = chunk.select(F.explode(F.arrays_zip("pairs", "counts")).alias("own"))
    return own.groupBy(F.expr(f"own.pairs div {b_size}").alias("a"), F.expr(f"own.pairs % {b_size}").alias("b")).agg(F.sum("own.counts").alias("n"))


def b_vocabulary(path: str) -> int:
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path).get_piece_size()


@query("op11_tokenizer_alignment", exact=True)
def op11_tokenizer_alignment(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    b_path = public_tokenizers.path(B_FILE)
    return align(documents(spark, folder), public_tokenizers.path(A_FILE), b_path, public_tokenizers.PATTERN, b_vocabulary(b_path))

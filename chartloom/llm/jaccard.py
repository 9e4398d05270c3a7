"""Similarity join on word n-grams, by prefix filters under several orders of the tokens.

If two sets have a Jaccard similarity of at least t, then under any order of all tokens the
first `n - ceil(t n) + 1` tokens of each have one in common. Three global orders are used. In
all of them tokens that occur in more documents stand behind those that occur in fewer, so a
passage that documents share leads to no candidates unless they consist of little else.
Documents that share a prefix token under the first order are candidates if their prefixes
also meet under the second and the third order and their sizes allow the similarity; then
the whole sets are compared.

How many documents have a token is counted exactly, over all documents: tasks send sorted
blocks of token hashes, cut by ranges of hashes of bounded size. The most common tokens, a
bounded number of them, go to all tasks. The order is a matter of speed alone.

No group of copies is expanded into pairs. Equal sets are one node. In a bucket (the nodes
with the same prefix token) every node is compared with one leader at most, again and again
with other leaders as long as that finds links: first the text with most copies, later the
node with most links, since copies gather around such. Only nodes of different components
are compared, because a link inside a component would tell nothing new. What is left at the
end is compared without exception, so no link between components is lost: in small buckets
all pairs that lie in different components and meet all filters (tiny ones pair by id first, as
the same few nodes share many tokens); large buckets, such as many
variants of a text that differ a little too much, are cut into blocks, and a task compares
two blocks by all their tokens (16 bits of each, which never hides a common one) and passes
on only pairs that can still be similar enough.

Defined results: a null or empty text has an empty set and is linked with nothing, its
component is its own id; rows with a null id take part, but a component's id is its smallest
id that is not null; repeated rows are equal sets; other columns are ignored. Tokens and
sets are known by 64-bit hashes.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chartloom.llm.catalog import query
from chartloom.llm.common import Words, bounded, chunks, documents, give_back, kept, mix, sliced, text_bytes
from chartloom.sinks.staging import stage

COMMON_LEAST = 6  # documents that have a token, from which on it counts as common
COMMON_MOST = 1 << 21  # common tokens that all tasks know: 5 bytes each
BLOCK_BYTES = 16 << 20  # of text, whose tokens one task counts
SLICE_BYTES = 256 << 10  # of text, whose words and shingles are at hand at once (more for one longer text)
MAX_ROUNDS, MAX_STEPS = 6, 60
TINY = 12  # nodes of a bucket whose pairs are written before they are filtered
BUCKET = 256  # nodes; larger buckets are compared in blocks, inside tasks
BLOCK = 1024  # nodes of a block

_SEEDS = mix(np.arange(11, 31, dtype=np.uint64))


def shingles(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes and lengths of all runs of `width` words, and the documents' bounds among them.

    A document with fewer words has its whole sequence as its only run.
    """
    words = Words(data, offsets)
    count = np.diff(words.first)
    runs = np.where(count == 0, 0, np.maximum(count - width + 1, 1))
    at = np.concatenate([[0], np.cumsum(runs)])
    start = np.arange(at[-1]) - np.repeat(at[:-1] - words.first[:-1], runs)
    size = np.repeat(np.minimum(count, width), runs)
    total, letters = np.zeros(len(start), np.uint64), np.concatenate([[0], np.cumsum(words.end - words.start)])
    for k in range(width):
        there = size > k
        total[there] += words.hash[start[there] + k] * (_SEEDS[k] | np.uint64(1))
    return mix(total + size.astype(np.uint64)), letters[start + size] - letters[start], at


def prefix_size(n: int, percent: int) -> int:
    return n + percent * n // -100 + 1 if n else 0


def _bits(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def planes(values: np.ndarray) -> bytes:
    """All first bytes, then all second bytes and so on: small numbers compress well that way."""
    return values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()


def numbers(raw: bytes, kind: type) -> np.ndarray:
    """What `planes` was given."""
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, -1).T).view(kind).ravel()


def common_tokens(docs: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The most common tokens (upper half of their hash, sorted) and their levels: four times the binary logarithm of their document counts."""
    size = docs.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    parts = 1 + size // BLOCK_BYTES

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 0):
            data, offsets = text_bytes(batch.column(0))
            own = []
            for a, b in chunks(offsets, SLICE_BYTES):
                h, _, at = shingles(data, offsets[a : b + 1], width)
                own += [np.unique((h[s:e] >> np.uint64(32)).astype(np.uint32)) for s, e in zip(at[:-1], at[1:])]
            tokens, n = np.unique(np.concatenate(own), return_counts=True)
            # sorted hashes, cut at equal distances
            cuts = np.searchsorted(tokens.astype(np.uint64) * np.uint64(parts) >> np.uint64(32), np.arange(parts + 1))
            full = np.flatnonzero(np.diff(cuts))
            steps = np.diff(tokens, prepend=np.uint32(0))
            steps[cuts[full]] = tokens[cuts[full]]
            n = np.minimum(n, 65535).astype(np.uint16)
            yield pa.RecordBatch.from_arrays([
                pa.array(full.astype(np.int32)),
                pa.array([planes(steps[cuts[p] : cuts[p + 1]]) for p in full], pa.binary()),
                pa.array([planes(n[cuts[p] : cuts[p + 1]]) for p in full], pa.binary()),
            ], names=["part", "steps", "counts"])

    def counted(table: pa.Table) -> pa.Table:
        tokens = np.concatenate([np.cumsum(numbers(t.as_py(), np.uint32), dtype=np.uint32) for t in table["steps"]])
        n = np.concatenate([numbers(t.as_py(), np.uint16) for t in table["counts"]])
        names, place = np.unique(tokens, return_inverse=True)
        total = np.bincount(place, n, len(names)).astype(np.int64)
        many = total >= COMMON_LEAST
        del tokens, n, place
        give_back()
        return pa.table({"token": names[many].astype(np.int64), "n": total[many]})

    cut = docs.select("text").mapInArrow(blocks, "part int, steps binary, counts binary")
    found = stage(cut.groupBy("part").applyInArrow(counted, "token bigint, n bigint"), "common")
    # the bound on their number sets the count from which on tokens are taken
    least, taken = COMMON_LEAST, 0
    for row in found.groupBy(F.least("n", F.lit(1 << 16)).alias("n")).count().orderBy(F.desc("n")).toLocalIterator():
        taken += row["count"]
        if taken > COMMON_MOST:
            least = row["n"] + 1
            break
    table = found.where(F.col("n") >= least).toArrow()
    tokens, n = table["token"].to_numpy().astype(np.uint32), table["n"].to_numpy()
    order = np.argsort(tokens)
    return tokens[order], np.minimum(4 * np.log2(n[order]), 63).astype(np.uint8)


def sets(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """doc_id, mark (hash of the text), n, node (hash of the set; 0: empty) and the prefixes under three orders.

    Prefix one holds token hashes; two and three, which only filter, hold 16 bits of them.
    """
    known = docs.sparkSession.sparkContext.broadcast(common_tokens(docs, width))
    names, name = ["doc_id", "mark", "n", "node", "one", "two", "three"], ("common", uuid.uuid4().hex)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, levels = known.value

        def by_first_bits() -> np.ndarray:
            table = np.zeros(1 << 24, bool)
            table[common >> np.uint32(8)] = True
            return table

        maybe = kept(name, by_first_bits)  # most tokens need no look-up
        for batch in sliced(batches, 2):
            data, offsets = text_bytes(batch.column(2))
            sizes, nodes, prefixes = [], [], ([], [], [])
            for lo, hi in chunks(offsets, SLICE_BYTES):
                h, length, at = shingles(data, offsets[lo : hi + 1], width)
                for s, e in zip(at[:-1], at[1:]):
                    tokens, first = np.unique(h[s:e], return_index=True)
                    n, p = len(tokens), prefix_size(len(tokens), percent)
                    sizes.append(n)
                    nodes.append(int((mix(tokens + _SEEDS[10]).sum() + np.uint64(n)).view(np.int64)) or 1 if n else 0)
                    if not n:
                        for k in range(3):
                            prefixes[k].append(np.zeros(0, np.int64 if not k else np.int16))
                        continue
                    level = np.zeros(n, np.uint64)
                    half = (tokens >> np.uint64(32)).astype(np.uint32)  # in order, as the tokens are
                    look = np.flatnonzero(maybe[half >> np.uint32(8)])
                    if len(look):
                        place = np.minimum(np.searchsorted(common, half[look]), len(common) - 1)
                        there = common[place] == half[look]
                        level[look[there]] = levels[place[there]]
                    # fewer documents first; then, in two of the orders, longer words first, as they tend to be rarer
                    long = np.uint64(255) - np.minimum(length[s:e][first], 255).astype(np.uint64)
                    for k, lead in enumerate((long, np.uint64(0), long >> np.uint64(4))):
                        order = level << np.uint64(58) | lead << np.uint64(50) | mix(tokens + _SEEDS[11 + k]) >> np.uint64(14)
                        chosen = tokens[np.argpartition(order, p - 1)[:p]]
                        prefixes[k].append(_bits(chosen) if not k else np.unique((chosen & np.uint64(0xFFFF)).astype(np.uint16)).view(np.int16))
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()),
                pa.array(prefixes[0], pa.list_(pa.int64())), pa.array(prefixes[1], pa.list_(pa.int16())),
                pa.array(prefixes[2], pa.list_(pa.int16()))], names=names)

    return docs.select("doc_id", F.xxhash64("text").alias("mark"), "text").mapInArrow(
        run, "doc_id bigint, mark bigint, n bigint, node bigint, one array<bigint>, two array<smallint>, three array<smallint>")


def texts_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """node and a text that has its set, for the rows named by `wanted` (node, doc_id, mark)."""
    w = bounded(wanted).alias("w")
    rows = docs.select("doc_id", F.xxhash64("text").alias("mark"), "text").alias("d").join(
        w, F.col("d.doc_id").eqNullSafe(F.col("w.doc_id")) & (F.col("d.mark") == F.col("w.mark")))
    # repeated rows have equal texts; tasks pass one on
    return rows.groupBy("node").agg(F.first("text").alias("text"))


def verified(pairs: DataFrame, width: int, percent: int) -> DataFrame:
    """Of rows a, a_text, b, b_text the pairs (a, b) whose whole sets are similar enough."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 1):
            keep = np.zeros(batch.num_rows, bool)
            known: dict[int, np.ndarray] = {}
            for lo in range(0, batch.num_rows, 200):
                part = batch.slice(lo, 200)
                both = []
                for node, text in ((0, 1), (2, 3)):
                    data, offsets = text_bytes(part.column(text))
                    ids = part.column(node).to_pylist()
                    for d, i in enumerate(ids):
                        if i not in known:
                            known[i] = np.unique(shingles(data, offsets[d : d + 2], width)[0])
                    both.append(ids)
                for r, (i, j) in enumerate(zip(*both)):
                    x, y = known[i], known[j]
                    common = len(np.intersect1d(x, y, assume_unique=True))
                    keep[lo + r] = 100 * common >= percent * (len(x) + len(y) - common)
                known.clear()
            chosen = pa.array(np.flatnonzero(keep))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(chosen), batch.column(2).take(chosen)], names=["a", "b"])

    return pairs.select("a", "a_text", "b", "b_text").mapInArrow(run, "a bigint, b bigint")


def components(links: DataFrame) -> DataFrame:
    """node and comp, the smallest node that links reach, for all nodes of `links` (a, b).

    Each step takes the smallest label around and then the label of that label, so paths
    shrink by half. Steps are written to the shared folder.
    """
    edges = stage(links.select(F.col("a").alias("x"), F.col("b").alias("y")).union(links.select("b", "a")).distinct(), "links")
    labels = stage(edges.groupBy("x").agg(F.min("y").alias("m")).select(F.col("x").alias("node"), F.least("x", "m").alias("comp")), "labels")
    for _ in range(MAX_STEPS):
        around = edges.join(labels, edges["y"] == labels["node"]).groupBy("x").agg(F.min("comp").alias("m"))
        nearer = labels.join(around, labels["node"] == around["x"]).select("node", F.col("comp").alias("old"), F.least("comp", "m").alias("c"))
        heads = labels.select(F.col("node").alias("head"), F.col("comp").alias("beyond"))
        after = stage(
            nearer.join(heads, nearer["c"] == heads["head"], "left")
            .select("node", "old", F.least("c", F.coalesce("beyond", "c")).alias("comp")), "labels")
        labels = after.select("node", "comp")
        if after.where("old <> comp").isEmpty():
            return labels
    raise RuntimeError("the components did not settle")


def _side(frame: DataFrame, own: str, *columns: str) -> DataFrame:
    return frame.select(F.col("node").alias(own), *[F.col(c).alias(f"{own}_{c}") for c in columns])


def _meet() -> Column:
    return F.arrays_overlap("a_two", "b_two") & F.arrays_overlap("a_three", "b_three")


def filtered(pairs: DataFrame, filters: DataFrame) -> DataFrame:
    """The pairs (a, b) whose prefixes meet under the orders two and three."""
    return pairs.join(_side(filters, "a", "two", "three"), "a").join(_side(filters, "b", "two", "three"), "b").where(_meet()).select("a", "b")


def linked(pairs: DataFrame, filters: DataFrame, docs: DataFrame, width: int, percent: int, met: bool = False) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough: filters of orders two and three, unless `met`, then the whole sets.

    `filters` has a row for each node.
    """
    if not met:
        pairs = stage(filtered(pairs, filters), "close")
    asked = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    wanted = stage(filters.select("node", "doc_id", "mark").join(asked, "node"), "wanted")
    whole = stage(texts_of(docs, wanted), "whole-texts")
    # one side's text goes along with the pair, which is keyed by the other node then: no node gathers texts
    both = pairs.join(_side(whole, "a", "text"), "a").join(_side(whole, "b", "text"), "b")
    return stage(verified(both, width, percent), "linked")


def signatures(texts: DataFrame, width: int) -> DataFrame:
    """node and all tokens of its set, 16 bits of each; the k-th token with the same bits counts as another one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 1):
            data, offsets = text_bytes(batch.column(1))
            own = []
            for lo, hi in chunks(offsets, SLICE_BYTES):
                h, _, at = shingles(data, offsets[lo : hi + 1], width)
                for s, e in zip(at[:-1], at[1:]):
                    bits = np.sort((np.unique(h[s:e]) & np.uint64(0xFFFF)).astype(np.uint32))
                    again = np.arange(len(bits)) - np.searchsorted(bits, bits)
                    own.append((bits | again.astype(np.uint32) << np.uint32(16)).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(own, pa.binary())], names=["node", "tokens"])

    return texts.select("node", "text").mapInArrow(run, "node bigint, tokens binary")


def compare_blocks(rows: DataFrame, percent: int) -> DataFrame:
    """a and b, of different components, that can be similar enough by all their tokens.

    `rows` has token (the bucket), left and right (two blocks of it), block, node, comp, tokens.
    """
    def run(table: pa.Table) -> pa.Table:
        node, comp, block = (table[c].to_numpy() for c in ("node", "comp", "block"))
        sets_ = [np.frombuffer(t.as_py(), np.uint32) for t in table["tokens"]]
        size = np.array([len(t) for t in sets_])
        names, flat = np.unique(np.concatenate(sets_), return_inverse=True)
        at = np.concatenate([[0], np.cumsum(size)])
        left, right = table["left"][0].as_py(), table["right"][0].as_py()
        there, a, b = np.zeros(len(names), bool), [], []
        other = np.flatnonzero(block == right)
        for i in np.flatnonzero(block == left):
            there[flat[at[i] : at[i + 1]]] = True
            common = np.add.reduceat(there[flat], at[:-1], dtype=np.int64)[other]
            there[flat[at[i] : at[i + 1]]] = False
            near = other[(100 * common >= percent * (size[i] + size[other] - common)) & (comp[other] != comp[i])]
            near = near[node[near] > node[i]] if left == right else near
            a.append(np.full(len(near), node[i]))
            b.append(node[near])
        return pa.table({"a": np.concatenate([np.zeros(0, np.int64), *a]), "b": np.concatenate([np.zeros(0, np.int64), *b])})

    return rows.groupBy("token", "left", "right").applyInArrow(run, "a bigint, b bigint").distinct()


def in_blocks(large: DataFrame, filters: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs of large buckets (token, node, comp, size) that can be links; a bucket's rows are repeated once for each of its blocks."""
    wanted = stage(filters.select("node", "doc_id", "mark").join(large.select("node").distinct(), "node", "left_semi"), "wanted")
    tokens = stage(signatures(texts_of(docs, wanted), width), "signatures")
    count = F.ceil(F.col("size") / BLOCK).cast("int")
    dealt = large.withColumn("block", F.pmod(F.xxhash64("node"), count).cast("int")).withColumn(
        "with", F.explode(F.sequence(F.lit(0), count - 1)))
    rows = dealt.join(tokens, "node").select(
        "token", F.least("block", "with").alias("left"), F.greatest("block", "with").alias("right"), "block", "node", "comp", "tokens")
    return compare_blocks(rows, percent)


def join(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """doc_id, mark (of the text), n_shingles, node (of equal sets), comp, component_id and links of every row.

    `comp` is the component's own label, its smallest node (null for an empty set); ids may occur in several components.
    `links` counts the links that were found between the row's node and others; links inside
    a component that other links had already joined are not looked for.
    """
    table = stage(sets(docs.select("doc_id", "text"), width, percent), "sets")
    classes = stage(
        table.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("rows")), "classes")
    repeated = stage(classes.where("rows > 1").select("node", "rows"), "repeated")
    # most sets occur once; only rows of the others meet to leave one of each
    sets_ = table.where("n > 0")
    single = sets_.join(repeated, "node", "left_anti").withColumn("rows", F.lit(1).cast("long"))
    nodes = single.select("node", "n", "rows", "one").union(
        sets_.join(repeated, "node").dropDuplicates(["node"]).select("node", "n", "rows", "one"))
    postings = nodes.select("node", "n", "rows", F.explode("one").alias("token"))
    several = postings.groupBy("token").agg(F.count(F.lit(1)).alias("size")).where("size > 1").select("token")
    shared = stage(postings.join(several, "token", "left_semi"), "buckets")
    filters = stage(
        sets_.join(shared.select("node").distinct(), "node", "left_semi").select("node", "doc_id", "mark", "two", "three").dropDuplicates(["node"]), "filters")

    def likely(frame: DataFrame) -> DataFrame:
        """Rows of a, a_n, b, b_n whose sizes allow the similarity."""
        return frame.where((F.col("a") != F.col("b")) & (100 * F.least("a_n", "b_n") >= percent * F.greatest("a_n", "b_n")))

    def ordered(met: DataFrame) -> DataFrame:
        return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()

    def of_links(links: DataFrame) -> DataFrame:
        return links.select(F.col("a").alias("node")).union(links.select("b")).groupBy("node").agg(F.count(F.lit(1)).alias("links"))

    links = comps = tried = None
    last, turn = False, 0
    while True:
        open_ = shared.withColumns({"comp": F.col("node"), "links": F.lit(0).cast("long")})
        if links is not None:
            state = of_links(links).join(comps, "node")
            open_ = shared.join(state, "node", "left").withColumns({"comp": F.coalesce("comp", "node"), "links": F.coalesce("links", F.lit(0))})
            mixed = open_.groupBy("token").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low <> high").select("token")
            open_ = stage(open_.join(mixed, "token", "left_semi"), "open")
        member = open_.select("token", F.col("node").alias("a"), F.col("n").alias("a_n"), F.col("comp").alias("a_c"))
        if not last:
            rank = F.struct("links", "rows", F.xxhash64("node", F.lit(turn)).alias("dice"), "node", "n", "comp")
            lead = open_.groupBy("token").agg(F.max(rank).alias("l")).select(
                "token", F.col("l.node").alias("b"), F.col("l.n").alias("b_n"), F.col("l.comp").alias("b_c"))
            # of its leaders a node is compared with the one it meets in most buckets
            votes = likely(member.join(lead, "token").where("a_c <> b_c")).groupBy("a", "b").agg(F.count(F.lit(1)).alias("votes"))
            if tried is not None:
                votes = votes.join(tried, (votes["a"] == tried["low"]) & (votes["b"] == tried["high"]), "left_anti")
            met = stage(votes.groupBy("a").agg(F.max(F.struct("votes", "b")).alias("best")).select("a", "best.b"), "met")
            pairs = stage(ordered(met), "pairs")
        else:
            sizes = open_.groupBy("token").agg(F.count(F.lit(1)).alias("size"))
            sized = stage(open_.join(sizes, "token").select("token", "node", "n", "comp", "size"), "sized")
            # tiny buckets make fewer pairs than their rows with all filters would weigh; most pairs come from several of them
            tiny, few, large = (sized.where(w) for w in (
                F.col("size") <= TINY, (F.col("size") > TINY) & (F.col("size") <= BUCKET), F.col("size") > BUCKET))
            left = tiny.select("token", F.col("node").alias("a"), F.col("n").alias("a_n"), F.col("comp").alias("a_c"))
            right = tiny.select("token", F.col("node").alias("b"), F.col("n").alias("b_n"), F.col("comp").alias("b_c"))
            close = filtered(stage(ordered(likely(left.join(right, "token").where(F.col("a_c") < F.col("b_c")))), "pairs"), filters)
            if not few.isEmpty():
                left = few.select("token", F.col("node").alias("a"), F.col("n").alias("a_n"), F.col("comp").alias("a_c")).join(
                    _side(filters, "a", "two", "three"), "a")
                right = left.toDF(*[c.replace("a_", "b_") if c != "a" else "b" for c in left.columns])
                close = close.union(likely(left.join(right, "token").where((F.col("a_c") < F.col("b_c")) & _meet())).select("a", "b"))
            if not large.isEmpty():
                close = close.union(in_blocks(large, filters, docs, width, percent))
            pairs = stage(ordered(close), "close")
        fresh, asked = 0, 0 if last else pairs.count()
        if last or asked:
            found = linked(pairs, filters, docs, width, percent, met=last)
            fresh = found.count()
            if not last:
                both_ways = pairs.select(F.col("a").alias("low"), F.col("b").alias("high"))
                both_ways = both_ways.union(both_ways.select("high", "low"))
                tried = both_ways if tried is None else tried.union(both_ways)
        if fresh:
            links = stage(found if links is None else links.union(found).distinct(), "links-so-far")
            comps = components(links)
        if last:
            break
        turn += 1
        last = turn == MAX_ROUNDS or turn > 1 and fresh * 20 <= asked  # few leaders find anything any more
    result = table.select("doc_id", "mark", F.col("n").alias("n_shingles"), "node")
    if links is None:
        empty = classes.select("node").limit(0)
        comps, links = empty.withColumn("comp", F.col("node")), empty.select(F.col("node").alias("a"), F.col("node").alias("b"))
    ends = of_links(links)
    named = classes.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    smallest = named.groupBy("comp").agg(F.min("least").alias("component_id"))
    of_node = named.join(smallest, "comp").join(ends, "node", "left").select(
        F.col("node").alias("_node"), "comp", "component_id", F.coalesce("links", F.lit(0)).alias("links"))
    return result.join(of_node, F.col("node") == F.col("_node"), "left").select(
        "doc_id", "mark", "n_shingles", "node", "comp",
        F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.coalesce("links", F.lit(0)).cast("long").alias("links"))


def keep_one(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One document of each component stays, that of the smallest id; documents without words all stay.

    Should several rows of that id be in the component, the one whose text hashes lowest
    stays, once. Components whose rows have no id at all leave the row of the lowest hash.
    """
    found = join(docs, width, percent).where("n_shingles > 0")
    marked = stage(found.groupBy("comp", "doc_id", "mark").agg(F.count(F.lit(1)).alias("rows")), "marked")
    lowest = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "mark", "rows")).alias("lowest")
    first = stage(marked.groupBy("comp").agg(lowest).select("comp", "lowest.doc_id", "lowest.mark", "lowest.rows"), "first")
    m, f = marked.alias("m"), first.alias("f")
    gone = stage(
        m.join(f, (F.col("m.comp") == F.col("f.comp")) & F.col("m.doc_id").eqNullSafe(F.col("f.doc_id"))
               & (F.col("m.mark") == F.col("f.mark")), "left_anti").select("doc_id", "mark"), "gone")
    twice = stage(first.where("rows > 1").select("doc_id", "mark"), "twice")
    # a row's own columns stay together in `row`, whatever their names are
    d = docs.select(F.col("doc_id").alias("own_id"), F.xxhash64("text").alias("own_mark"), F.struct(*[docs[c] for c in docs.columns]).alias("row")).alias("d")

    def same(other: str):
        return F.col("own_id").eqNullSafe(F.col(f"{other}.doc_id")) & (F.col("own_mark") == F.col(f"{other}.mark"))

    gone, twice = bounded(gone).alias("g"), bounded(twice).alias("t")
    stay = d.join(gone, same("g"), "left_anti")
    once = stay.join(twice, same("t"), "left_anti")
    # rows that occur several times and have words: any of them
    several = stay.join(twice, same("t"), "left_semi").dropDuplicates(["own_id", "own_mark"])
    return once.union(several).select("row.*")


@query("op5_ngram_jaccard")
def op5_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return join(documents(spark, folder), 3, 90).select("doc_id", "n_shingles", "component_id")

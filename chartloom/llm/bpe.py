"""Byte-level BPE encoding by a lazily determinised transducer; streaming decode.

The encoding of a byte string has a last token for each of its prefixes, and a sequence of
tokens is the encoding of its bytes if and only if each neighbouring pair is the encoding of
its own bytes. So a reader that goes through the bytes once needs to keep only those
positions from which a longer token may still start, with the chain of tokens that leads to
them. That set is the state. Where all chains agree on their first tokens, these are
settled and are emitted: the lookahead never exceeds what the longest token can still
reach. States and transitions are made when first met, kept in a table of bounded size, and
made again after the table was emptied. Where the table has no step within the last bytes of an
input, the positions are followed to the end without states, as few inputs share their ends.

Defined results: a null or empty text has no tokens; text is never normalised; every byte
sequence decodes back to itself; repeated rows give equal rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import codecs
import hashlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from chartloom.llm.catalog import query
from chartloom.llm.common import documents, kept, sliced

DEAD = -1
HEAD = 4  # bytes at the start of an input that are looked up together
TAIL = 3  # bytes at its end for which no new states are made
ROOM = 200_000  # pieces, and states, that a worker remembers
_START = array("i", (DEAD, DEAD, 0)).tobytes()


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a base64 token and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merge_pairs(ranks: dict[bytes, int], piece: bytes, until: int = 1) -> list[int]:
    """The definition: again and again join the leftmost pair of the lowest rank, until so few parts are left."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > until:
        best, at = min(((ranks.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))))
        if best == 1 << 60:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return [ranks[p] for p in parts]


class Transducer:
    """Bytes in, token ids out, one pass, tables made on demand.

    A state is a row of entries (parent, token, node), oldest position first, kept as the bytes
    of their 32-bit integers. Entry 0 is the settled position; the other entries hang on it as a tree
    whose edges are tokens not emitted yet. `node` is the place in the token trie of the bytes
    read since the position.
    """

    def __init__(self, ranks: dict[bytes, int], max_states: int = 200_000, max_pairs: int = 300_000) -> None:
        self.ranks, self.max_states, self.max_pairs = ranks, max_states, max_pairs
        self.trie: dict[int, int] = {}
        self.token_at: list[int] = [DEAD]
        for token, rank in ranks.items():
            node = 0
            for byte in token:
                node = self.trie.setdefault(node << 8 | byte, len(self.token_at))
                if node == len(self.token_at):
                    self.token_at.append(DEAD)
            self.token_at[node] = rank
        # the two tokens that the last merge of a token's own bytes joins; a token that they do not merge to has none
        self.halves: dict[int, tuple[int, int]] = {}
        self.joined: dict[tuple[int, int], int] = {}
        for token, rank in ranks.items():
            if len(token) > 1 and len(parts := merge_pairs(ranks, token, until=2)) == 2 and ranks[token] == rank:
                self.halves[rank] = parts[0], parts[1]
                self.joined[parts[0], parts[1]] = rank
        self.single = {ranks[t] for t in ranks if len(t) == 1}
        self.pairs: dict[int, bool] = {}
        self._forget()

    def _forget(self) -> None:
        self.rows: list[bytes] = [_START]
        self.number = {_START: 0}
        self.steps: dict[int, tuple[int, tuple[int, ...]]] = {}
        self.finals: dict[int, tuple[int, ...]] = {}
        self.heads: dict[bytes, tuple[int, tuple[int, ...]]] = {}  # where the first bytes lead to, and what they emit

    @property
    def states(self) -> list[tuple[tuple[int, ...], ...]]:
        """The states made so far, each with its entries."""
        return [tuple(zip(*[iter(array("i", row))] * 3)) for row in self.rows]

    def _apart(self, left: int, right: int) -> bool:
        """Whether no merge ever joins bytes of two neighbouring tokens.

        The merges that made them are undone, the latest first. Two parts that meet at the
        border would have been joined if their merge comes before the one just undone.
        """
        before = len(self.token_at) + 1
        while True:
            if self.joined.get((left, right), before) < before:
                return False
            undo_left = left > right
            if (left if undo_left else right) in self.single:
                undo_left = not undo_left
                if (left if undo_left else right) in self.single:
                    return True
            if undo_left:
                before, left = left, self.halves[left][1]
            else:  # of equal merges the one further left comes first
                before, right = right + 1, self.halves[right][0]

    def _fits(self, left: int, right: int) -> bool:
        """Whether `right` may follow `left` (DEAD: stand first)."""
        known = self.pairs.get((left + 1) << 32 | right)
        if known is None:
            if len(self.pairs) >= self.max_pairs:
                self.pairs.clear()
            known = (right in self.halves or right in self.single) and (left == DEAD or self._apart(left, right))
            self.pairs[(left + 1) << 32 | right] = known
        return known

    def _step(self, state: bytes, byte: int) -> tuple[bytes, tuple[int, ...]]:
        entries = array("i", state).tolist()
        parents, tokens, nodes = entries[::3], entries[1::3], entries[2::3]
        trie, token_at, alive, n = self.trie.get, self.token_at, [], len(nodes)
        owner = DEAD
        for i, node in enumerate(nodes):
            if node != DEAD:
                nodes[i] = node = trie(node << 8 | byte, DEAD)
                if node != DEAD:
                    alive.append(i)
                    found = token_at[node]
                    if owner == DEAD and found != DEAD and self._fits(tokens[i], found):
                        owner = i
                        parents.append(i)
                        tokens.append(found)
        if owner == DEAD:
            raise ValueError(f"no token ends at byte {byte}: the vocabulary lacks single bytes")
        nodes.append(0)
        alive.append(n)
        # positions are needed that may still go on, and those that lead to them
        children = [0] * (n + 1)  # of a needed position the only needed child; DEAD: several
        needed = [False] * (n + 1)
        for i in alive:
            while i and not needed[i]:
                needed[i] = True
                parent = parents[i]
                children[parent] = DEAD if children[parent] else i
                i = parent
        root, emitted = 0, []
        while nodes[root] == DEAD and children[root] != DEAD:  # the settled position is of no more use: move on while only one way leads on
            root = children[root]
            emitted.append(tokens[root])
        place = {root: 0}
        kept = array("i", (DEAD, DEAD if nodes[root] == DEAD else tokens[root], nodes[root]))
        for i in range(root + 1, n + 1):
            if needed[i] and parents[i] in place:
                place[i] = len(place)
                kept.extend((place[parents[i]], tokens[i], nodes[i]))
        return kept.tobytes(), tuple(emitted)

    def _rest(self, state: bytes) -> tuple[int, ...]:
        """At the end of the input the newest position is the one that counts."""
        entries = array("i", state)
        tokens, i = [], len(entries) // 3 - 1
        while i:
            tokens.append(entries[3 * i + 1])
            i = entries[3 * i]
        return tuple(reversed(tokens))

    def _learn(self, at: int, byte: int) -> tuple[int, tuple[int, ...]]:
        """A step that is met for the first time."""
        state, emitted = self._step(self.rows[at], byte)
        to = self.number.get(state)
        if to is None:
            if len(self.rows) >= self.max_states:  # made again as they are met again; the present one stays
                self._forget()
                to = self.number.setdefault(state, len(self.rows))
                if to == len(self.rows):
                    self.rows.append(state)
                return to, emitted
            to = self.number[state] = len(self.rows)
            self.rows.append(state)
        step = self.steps[at << 8 | byte] = to, emitted
        return step

    def _tail(self, state: bytes, rest: bytes) -> list[int]:
        """The tokens still to come when the input ends with `rest`: its positions are followed and no state is made."""
        entries = array("i", state).tolist()
        parents, tokens = entries[::3], entries[1::3]
        trie, token_at, pairs = self.trie.get, self.token_at, self.pairs.get
        alive = [(i, node) for i, node in enumerate(entries[2::3]) if node != DEAD]
        for byte in rest:
            owner, going = DEAD, []
            for i, node in alive:
                node = trie(node << 8 | byte)
                if node is not None:
                    going.append((i, node))
                    if owner == DEAD and (found := token_at[node]) != DEAD:
                        left = tokens[i]
                        fits = pairs((left + 1) << 32 | found)
                        if self._fits(left, found) if fits is None else fits:
                            owner, token = i, found
            if owner == DEAD:
                raise ValueError(f"no token ends at byte {byte}: the vocabulary lacks single bytes")
            going.append((len(parents), 0))
            parents.append(owner)
            tokens.append(token)
            alive = going
        out, i = [], len(parents) - 1
        while i:
            out.append(tokens[i])
            i = parents[i]
        out.reverse()
        return out

    def encode(self, piece: bytes) -> list[int]:
        head = piece[:HEAD]
        known = self.heads.get(head)
        if known is None:
            out, at = [], 0
            for byte in head:
                at, emitted = self.steps.get(at << 8 | byte) or self._learn(at, byte)
                out += emitted
            if len(self.heads) >= self.max_states:
                self.heads.clear()
            self.heads[head] = at, tuple(out)
        else:
            at, emitted = known
            out = [*emitted]
        steps, left = self.steps, len(piece) - len(head)
        for byte in piece[HEAD:]:
            step = steps.get(at << 8 | byte)
            if step is None:
                if left <= TAIL:
                    out += self._tail(self.rows[at], piece[-left:])
                    return out
                step = self._learn(at, byte)
                steps = self.steps
            at, emitted = step
            if emitted:
                out += emitted
            left -= 1
        final = self.finals.get(at)
        if final is None:
            final = self.finals[at] = self._rest(self.rows[at])
        out += final
        return out


class Encoder:
    """Whole texts to ids: the split pattern, then the transducer, with pieces seen lately remembered.

    Pieces are remembered in two halves; when the newer one is full, the older one goes.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str, max_pieces: int = ROOM) -> None:
        self.transducer, self.find = Transducer(ranks, max_pieces, max_pieces * 3 // 2), regex.compile(pattern).findall
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.half = max_pieces // 2
        self.code = {rank: rank.to_bytes(4, "little") for rank in ranks.values()}

    def _piece(self, piece: str) -> bytes:
        packed = self.older.get(piece)
        if packed is None:
            raw = piece.encode()
            whole = self.transducer.ranks.get(raw)
            if whole is not None:
                packed = self.code[whole]
            else:
                packed = b"".join(map(self.code.__getitem__, self.transducer.encode(raw)))
        if len(piece) <= 64:
            if len(self.known) >= self.half:
                self.known, self.older = {}, self.known
            self.known[piece] = packed
        return packed

    def packed(self, text: str | None) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        pieces = self.find(text)
        found = list(map(self.known.get, pieces))
        if None in found:
            miss = self._piece
            found = [known or miss(piece) for known, piece in zip(found, pieces)]
        return b"".join(found)

    def ids(self, text: str | None) -> list[int]:
        return np.frombuffer(self.packed(text), "<u4").tolist()


class Decoder:
    """Ids to text as they arrive.

    The state between calls is that of an incremental UTF-8 machine: up to three bytes of a
    character that is not complete yet. Malformed bytes become U+FFFD.
    """

    def __init__(self, ranks: dict[bytes, int]) -> None:
        tokens = [b""] * (1 + max(ranks.values(), default=0))
        for token, rank in ranks.items():
            tokens[rank] = token
        self.tokens = pa.array(tokens, pa.large_binary())
        self.machine = codecs.getincrementaldecoder("utf-8")("replace")

    def raw(self, ids: Iterable[int] | np.ndarray) -> bytes:
        taken = self.tokens.take(pa.array(ids if isinstance(ids, np.ndarray) else list(ids), pa.int64()))
        data = taken.buffers()[2]
        return data.to_pybytes() if data is not None else b""

    def feed(self, ids: Iterable[int] | np.ndarray) -> str:
        return self.machine.decode(self.raw(ids))

    def finish(self) -> str:
        rest = self.machine.decode(b"", True)
        self.machine.reset()
        return rest

    def stream(self, ids: np.ndarray, step: int = 65_536) -> Iterator[str]:
        """The text of whole ids in parts of `step` ids, as a reader of a stream would get it."""
        for lo in range(0, len(ids), step):
            yield self.feed(ids[lo : lo + step].astype(np.int64))
        yield self.finish()


def _tools(path: str, pattern: str, room: int = ROOM) -> tuple[Encoder, Decoder]:
    def made() -> tuple[Encoder, Decoder]:
        ranks = read_ranks(path)
        return Encoder(ranks, pattern, room), Decoder(ranks)

    return kept(("bpe", path, pattern, room), made)


def encode(df: DataFrame, path: str, pattern: str, keep: tuple[str, ...] = ("doc_id",), text: str = "text",
           with_ids: bool = True, room: int = ROOM) -> DataFrame:
    """`keep`, then n_tokens, ids (if asked for), ids_sha256, decoded_sha256 of each row's whole text.

    The rank file must be at `path` on every executor. The decoded bytes are made from the
    ids by the streaming decoder, so the last column proves the round trip. A smaller `room`
    saves memory of the workers and costs time; the result is the same.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = _tools(path, pattern, room)
        sha = hashlib.sha256
        for batch in sliced(batches, len(keep)):
            lists, counts, digests, decoded = [], [], [], []
            for value in batch.column(len(keep)):
                packed = encoder.packed(value.as_py())
                ids = np.frombuffer(packed, "<u4")
                if with_ids:
                    lists.append(ids.astype(np.int32))
                counts.append(len(ids))
                digests.append(sha(packed).hexdigest())
                back = sha()
                for part in decoder.stream(ids):
                    back.update(part.encode())
                decoded.append(back.hexdigest())
            columns = [batch.column(i) for i in range(len(keep))] + [pa.array(counts, pa.int64())]
            if with_ids:
                columns.append(pa.array(lists, pa.list_(pa.int32())))
            columns += [pa.array(digests, pa.string()), pa.array(decoded, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    picked = df.select(*keep, df[text].alias("_text"))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in picked.schema.fields[:-1]] + ["n_tokens bigint"]
    fields += ["ids array<int>"] * with_ids + ["ids_sha256 string", "decoded_sha256 string"]
    names = [*keep, "n_tokens", *["ids"] * with_ids, "ids_sha256", "decoded_sha256"]
    return picked.mapInArrow(run, ", ".join(fields))


@query("op2_byte_bpe")
def op2_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return encode(documents(spark, folder), path, public_tokenizers.PATTERN, with_ids=False)

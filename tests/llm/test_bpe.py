"""The transducer against tiktoken and against the definition; decoding against the bytes."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from chartloom.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
RANKS = bpe.read_ranks(PATH)
ENCODER, DECODER = bpe.Encoder(RANKS, public_tokenizers.PATTERN), bpe.Decoder(RANKS)
KNOWN = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
TEXTS = ["", " ", "a", "Hello world", "the  the\n\n the", "été 日本語 🙂🙂‍🔥 ﷽", "<|endoftext|>", "x" * 3000, " " * 700 + "z",
         "ab" * 900, "\u0000\u0001\x7f", "can't WE'LL I'd", "1234567890" * 40, "\r\n\t mixed space "]


@pytest.mark.parametrize("text", TEXTS)
def test_known_texts(text):
    assert ENCODER.ids(text) == KNOWN.encode_ordinary(text)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=80))
def test_any_text(text):
    ids = ENCODER.ids(text)
    assert ids == KNOWN.encode_ordinary(text)
    assert DECODER.raw(ids) == text.encode()


def test_transducer_follows_the_definition_on_any_bytes():
    pick = random.Random(3)
    machine = bpe.Transducer(RANKS)
    for _ in range(1500):
        raw = bytes(pick.choice(b"aeinot erhs\xc3\xa9AB01") for _ in range(pick.randint(1, 40)))
        assert machine.encode(raw) == bpe.merge_pairs(RANKS, raw)


def test_small_tables_only_cost_time():
    small = bpe.Transducer(RANKS, max_states=20, max_pairs=10)
    for raw in (b"tokenization of unusual words", b"aaaaaaaaaaaaaaaaaaaaaaaaa", b"\xff\xfe\x00"):
        assert small.encode(raw) == bpe.merge_pairs(RANKS, raw)


def test_inputs_that_differ_in_their_ends_need_no_new_states():
    machine = bpe.Transducer(RANKS)
    letters = b"aeinrstxz\xc3\xa9"
    machine.encode(b"thereo")
    states, steps = len(machine.states), len(machine.steps)
    for a in letters:
        for b in letters:
            for raw in (b"there" + bytes((a,)), b"there" + bytes((a, b)), b"ther" + bytes((a, b)), b"ther" + bytes((b,)), b"ther"):
                assert machine.encode(raw) == bpe.merge_pairs(RANKS, raw)
    assert (len(machine.states), len(machine.steps)) == (states, steps)


def test_tokens_are_emitted_before_the_end():
    machine = bpe.Transducer(RANKS)
    machine.encode(b"internationalization and more words follow here")
    assert any(emitted for _, emitted in machine.steps.values())
    assert max(len(s) for s in machine.states) < 40


def test_streaming_decode_holds_back_half_characters():
    ids = ENCODER.ids("naïve 🙂 日本")
    stream = bpe.Decoder(RANKS)
    pieces = [stream.feed([i]) for i in ids] + [stream.finish()]
    assert "".join(pieces) == "naïve 🙂 日本"
    assert stream.feed([RANKS[b"\xf0"]]) == "" and stream.finish() == "�"


def test_frame(spark):
    rows = [(1, None, "x"), (1, None, "x"), (None, "", "x"), (2, "Hello 日本", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = sorted(bpe.encode(df, PATH, public_tokenizers.PATTERN).collect(), key=str)
    none = hashlib.sha256(b"").hexdigest()
    ids = KNOWN.encode_ordinary("Hello 日本")
    assert [r for r in got if r.doc_id == 2][0].ids == ids
    assert [r for r in got if r.doc_id == 2][0].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
    assert [(r.doc_id, r.n_tokens, r.ids_sha256) for r in got if r.doc_id != 2] == [(1, 0, none)] * 2 + [(None, 0, none)]
    assert bpe.encode(df.limit(0), PATH, public_tokenizers.PATTERN).count() == 0

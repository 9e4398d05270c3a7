"""Alignment against plain loops over the tokenizers' own results; edge cases."""

import hashlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest

from chartloom.llm import alignment
from chartloom.llm.catalog import QUERIES

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def tools():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def brute(rows, tools):
    a_tool, b_tool = tools
    letter = alignment.byte_letters()

    def piece(i):
        p = b_tool.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b_tool.is_byte(i) else p.replace("▁", " ").encode()

    found, counts = [], Counter()
    for doc_id, text in rows:
        a = a_tool.encode(" " + (text or ""), add_special_tokens=False).ids
        b = b_tool.encode(text or "")
        a_bytes = [bytes(letter[c] for c in a_tool.id_to_token(i)) for i in a]
        b_bytes = [piece(i) for i in b]
        raw = (" " + (text or "")).encode()
        if not text or b"".join(a_bytes) != raw or b"".join(b_bytes) != raw:
            found.append((doc_id, [], [], [], []))
            continue
        spans = []
        for tokens in (a_bytes, b_bytes):
            at, own = 0, []
            for t in tokens:
                own.append((at, at := at + len(t)))
            spans.append(own)
        links, j = [], 0
        for i, (s, e) in enumerate(spans[0]):
            while spans[1][j][1] <= s:
                j += 1
            k = j
            while k < len(b) and spans[1][k][0] < e:
                links.append((a[i], b[k]))
                k += 1
        ends = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        groups, before = [], 0
        for end in ends:
            own = [",".join(str(i) for i, (_, e) in zip(ids, sp) if before < e <= end) for ids, sp in zip((a, b), spans)]
            groups.append("|".join(own))
            before = end
        counts.update(links)
        found.append((doc_id, a, b, groups, links))
    best = defaultdict(int)
    for (_, y), n in counts.items():
        best[y] = max(best[y], n)
    return sorted(((
        d, len(a), len(b), len(g), len(x), sum(counts[p] == best[p[1]] for p in x), sum(counts[p] for p in x),
        hashlib.sha256(";".join(g).encode()).hexdigest() if g else "") for d, a, b, g, x in found), key=str), counts


def got(df):
    return sorted((tuple(r[c] for c in alignment.RESULT) for r in df.collect()), key=str)


def test_table(spark, tools):
    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    df = QUERIES["op11_tokenizer_alignment"](spark, folder)
    assert df.columns == list(alignment.RESULT)
    assert got(df) == brute([(d, (t or "")[:]) for d, t in rows], tools)[0]


def test_edges(spark, tools, monkeypatch):
    monkeypatch.setattr(alignment, "LONG_TEXT", 500)  # the other way to encode A
    texts = ["", None, " ", "a", "é", "<|endoftext|> and <s> </s> <0x41>", "x▁y", "日本語のテキスト", "\U0001f600\U0001f601 smile", "a\x00b", "tab\tand\nlines\r\n  ",
             "ﬁ ½ ①", "word " * 300, "Zürich straße " * 40, "​﻿", "é", "   three blanks   ", "'s 're don't", "1234567890" * 20, "a", "a"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "no id"), (None, "no id"), (3, "a")]
    docs = spark.createDataFrame([(i, t, 9, "z") for i, t in rows], "doc_id int, text string, chunk int, pairs string")
    size = alignment.b_vocabulary(B)
    expected, counts = brute(rows, tools)
    for parts in (1, 5):
        assert got(alignment.align(docs.repartition(parts), A, B, public_tokenizers.PATTERN, size)) == expected
    assert any(e[1] == 0 and rows[i][1] for i, e in enumerate(expected[: len(texts)]) if e[0] == 6)
    pairs = alignment.pair_counts(docs, A, B, public_tokenizers.PATTERN, size).collect()
    assert {(r.a, r.b): r.n for r in pairs} == counts
    assert alignment.align(docs.limit(0), A, B, public_tokenizers.PATTERN, size).count() == 0


def test_chunks_do_not_change_results(spark, tools, monkeypatch):
    plain = alignment.chunks
    monkeypatch.setattr(alignment, "chunks", lambda offsets: plain(offsets, 3000))  # local, so it goes to the workers by value
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60).collect()]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(alignment.align(docs, A, B, public_tokenizers.PATTERN, alignment.b_vocabulary(B))) == brute(rows, tools)[0]

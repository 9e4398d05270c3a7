"""The stages against plain code on a whole small table, and on edge cases."""

import public_tokenizers
import tiktoken
from test_jaccard import brute
from test_pii import pii

import corpus_pipeline
from chartloom.llm import bpe, mixture

FOLDER = "/root/testdata/sf0.001"


def step(spark, name, docs):
    return dict(corpus_pipeline.STAGES)[name](spark, docs, FOLDER)


def test_whole_table(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    first = step(spark, "language", docs)
    assert first.columns == docs.columns
    rows = sorted((r.doc_id, r.text) for r in first.collect())
    assert len(rows) >= 0.97 * docs.count()
    second = step(spark, "near_copies", first)
    assert second.columns == docs.columns
    own = brute(rows, 5, 80)
    assert {r.doc_id for r in second.collect()} == {c for _, _, c in own}
    third = step(spark, "personal_data", second)
    assert third.columns == docs.columns
    texts = {r.doc_id: r.text for r in second.collect()}
    assert {r.doc_id: (r.text, r.n_chars) for r in third.collect()} == {d: (pii.masked(t), len(pii.masked(t))) for d, t in texts.items()}
    fourth = step(spark, "mix", third)
    assert fourth.columns == docs.columns
    assert fourth.agg({"n_chars": "count"}).collect()[0][0] > 0
    taken = {r.doc_id: r.taken for r in mixture.mix(third).collect()}
    words = {}
    for r in fourth.collect():
        words[r.doc_id] = words.get(r.doc_id, 0) + len([w for w in r.text.replace("\x0b", " ").replace("\x0c", " ").split()])
    assert words == {d: n for d, n in taken.items() if n}
    ids = {(r.doc_id, tuple(r.ids)) for r in corpus_pipeline.run(spark, FOLDER).collect()}
    ranks = bpe.read_ranks(public_tokenizers.path(corpus_pipeline.TOKENIZER))
    known = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert ids == {(r.doc_id, tuple(known.encode_ordinary(r.text))) for r in fourth.collect()}


def test_edges(spark):
    text = "the cat and the dog are in the house with you " * 3
    rows = [(1, text, "en", "s0", 1, "x"), (1, text, "en", "s0", 1, "x"), (2, text + "too", "en", None, 1, None), (None, "the only one of that kind", None, "s1", 1, "y"),
            (3, None, "en", "s0", 0, "x"), (4, "", "en", "s0", 0, "x"), (5, "12 34", None, "s0", 5, "x"), (6, "mail me@x.org and the rest of it", "en", "s1", 3, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score string")
    for name, _ in corpus_pipeline.STAGES[:-1]:
        docs = step(spark, name, docs)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "score"]
        assert {r.doc_id for r in docs.collect()} == ({1, 2, 6, None} if name == "language" else {1, 6, None})
    assert any("<EMAIL>" in r.text for r in docs.collect())
    assert step(spark, "tokens", docs).count() == docs.count()
    nothing = docs.limit(0)
    for name, _ in corpus_pipeline.STAGES:
        nothing = step(spark, name, nothing)
    assert nothing.count() == 0


def test_workers_get_batches_bounded_by_bytes(spark, monkeypatch):
    plain = bpe.sliced

    def sliced(batches, text):  # local, so it goes to the workers by value
        def seen():
            for batch in batches:
                assert batch.nbytes < 4 << 20, batch.nbytes
                yield batch

        yield from plain(seen(), text)

    monkeypatch.setattr(bpe, "sliced", sliced)
    docs = spark.range(0, 3000, 1, 1).selectExpr("id AS doc_id", "repeat('word and ', 400) AS text", "'en' AS lang", "'s0' AS source")
    assert step(spark, "tokens", docs).count() == 3000

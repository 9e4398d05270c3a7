"""N-grams against a loop over characters; accuracy on the held-out fold; edge cases."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from chartloom.llm import language
from chartloom.llm.catalog import QUERIES
from chartloom.llm.common import chunks, text_bytes

FOLDER = "/root/testdata/sf0.01"


def plain_counts(text):
    folded = "".join(c.lower() if c.isalpha() and len(c.lower()) == 1 else c if c.isalpha() else " " for c in text)
    words = folded.split()
    line = " " + " ".join(words) + " " if words else ""
    return [sorted(line[i : i + n] for i in range(len(line) - n + 1) if n > 1 or line[i] != " ") for n in language.ORDERS]


def test_grams_are_those_of_each_document():
    texts = ["", None, "a", "  Été, l'été!  ", "x y", "123", "日本語 text", "same", "same", ".", "end. "]
    data, offsets = text_bytes(pa.array(texts, pa.string()))
    assert list(chunks(offsets, 4))[-1][1] == len(texts)
    seen = {}
    for n, (buckets, at) in zip(language.ORDERS, language.grams(data, offsets)):
        for d, text in enumerate(texts):
            expected = plain_counts(text or "")[n - 1]
            own = buckets[at[d] : at[d + 1]]
            assert len(own) == len(expected), (n, text)
            alone = list(language.grams(*text_bytes(pa.array([text], pa.string()))))[n - 1][0]
            assert sorted(alone) == sorted(own)
            assert len(set(own)) <= len(set(expected))
            seen[n, text] = sorted(own)
    assert seen[2, "same"]


def test_held_out_accuracy(spark):
    found = QUERIES["op1_language_id"](spark, FOLDER)
    truth = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang")
    rows = found.join(truth, "doc_id").where("held_out").select("lang", "lang_pred", "score").collect()
    assert len(rows) > 150
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)
    assert found.count() == truth.count()


def test_prediction_ignores_label_and_id(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(60)
    model = language.fit(docs)
    plain = {r.doc_id: r.lang_pred for r in language.predict(docs, model).collect()}
    other = docs.withColumn("lang", F.lit("zz")).withColumn("source", F.lit(None).cast("string"))
    assert {r.doc_id: r.lang_pred for r in language.predict(other, model).collect()} == plain


def test_edges(spark):
    rows = [(1, "the cat and the dog", "en", 1), (2, "der Hund und die Katze", "de", 1), (None, "der Hund", "fr", 1),
            (3, None, "en", 1), (4, "", None, 1), (5, "123 !!", "de", 1), (6, "und der Hund", None, 1), (6, "und der Hund", None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int")
    model = language.fit(docs, F.lit(True))
    got = {(r.doc_id, r.lang_pred) for r in language.predict(docs, model).collect()}
    assert got == {(1, "en"), (2, "de"), (None, "de"), (3, "und"), (4, "und"), (5, "und"), (6, "de")}
    assert language.predict(docs, model).count() == 8
    empty = language.fit(docs.limit(0))
    assert {r.lang_pred for r in language.predict(docs, empty).collect()} == {"und"}
    assert language.predict(docs.limit(0), model).count() == 0
    # a document's score does not depend on its neighbours
    long = spark.createDataFrame([(i, "der Hund und die Katze " * (40000 if i == 1 else 1), None) for i in range(3)], docs.drop("score").schema)
    assert {r.lang_pred for r in language.predict(long, model).collect()} == {"de"}


def test_training_sample_is_bounded(spark):
    docs = spark.range(500).selectExpr("id AS doc_id", "'a' AS text", "if(id < 400, 'x', 'y') AS lang")
    sample = language.training_rows(docs, F.lit(True), 30).groupBy("lang").count().collect()
    assert {(r.lang, r["count"]) for r in sample} == {("x", 30), ("y", 30)}


def test_columns_may_have_any_names(spark):
    rows = [(1, "the cat and the dog", "en", "a", 1.0), (2, "der Hund und die Katze", "de", "b", 2.0), (3, "12", "de", "c", 3.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, _text string, _lang_pred double")
    model = language.fit(docs, F.lit(True))
    got = language.predict(docs, model, ("doc_id", "_text", "text", "_lang_pred"), pred="found")
    assert got.columns == ["doc_id", "_text", "text", "_lang_pred", "found", "score"]
    assert sorted((r.doc_id, r._text, r.text, r._lang_pred, r.found) for r in got.collect()) == [
        (1, "a", rows[0][1], 1.0, "en"), (2, "b", rows[1][1], 2.0, "de"), (3, "c", "12", 3.0, "und")]
    sure = language.keep_sure(docs, model, 0.5)
    assert sure.schema == docs.schema and {r.doc_id for r in sure.collect()} == {1, 2}


def test_query_against_plain_counting(spark):
    """Sample, counts, weights, best language and posterior by loops over single documents."""
    import math
    from collections import Counter, defaultdict
    from zlib import crc32

    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]

    def buckets(text):
        return [int(b) for own, _ in language.grams(*text_bytes(pa.array([text], pa.string()))) for b in own]

    counts, documents = defaultdict(Counter), Counter()
    for doc_id, text, lang in rows:
        if lang is not None and doc_id is not None and crc32(str(doc_id).encode()) % 4 != 2:
            counts[lang].update(buckets(text))
            documents[lang] += 1
    assert max(documents.values()) <= language.PER_LANGUAGE
    size = 1 << language.BUCKET_BITS
    expected = {}
    for doc_id, text, _ in rows:
        own = buckets(text)
        logs = {k: math.log(documents[k] / sum(documents.values())) for k in sorted(counts)}
        for k in logs:
            total = sum(counts[k].values()) + language.SMOOTHING * size
            logs[k] += sum(math.log((counts[k][b] + language.SMOOTHING) / total) for b in own)
        best = max(logs, key=logs.get)
        expected[doc_id] = (best, 1 / sum(math.exp(v - logs[best]) for v in logs.values())) if own else ("und", 0.0)
    got = {r.doc_id: (r.lang_pred, r.score) for r in QUERIES["op1_language_id"](spark, folder).collect()}
    assert got.keys() == expected.keys()
    for d, (lang, score) in expected.items():
        assert got[d][0] == lang and abs(got[d][1] - score) < 1e-3, d

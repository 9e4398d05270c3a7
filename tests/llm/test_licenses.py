"""The scan against SQL and against plain search for the phrases; edge cases."""

import re

from chartloom.llm import licenses
from chartloom.llm.catalog import EXPECTED, QUERIES

FOLDER = "/root/testdata/sf0.01"
NAME = "op7_license_scan"


def plain(text):
    folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", folded) if w]
    places = [(i, label) for label, phrase in licenses.BASE_PHRASES for i in range(len(words))
              if words[i : i + len(phrase.split())] == phrase.split()]
    starts = [i for i, _ in places]
    return (len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places})))


def base(r):
    return (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels)


def test_tables(spark, same_as_sql):
    found = QUERIES[NAME](spark, FOLDER)
    plan = same_as_sql(found, EXPECTED[NAME], FOLDER)
    assert not re.search("Python|Pandas|Arrow", plan)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = found.collect()
    assert all(base(r) == plain(texts[r.doc_id]) for r in rows)
    assert any("gpl-3" in r.labels for r in rows)
    assert all(r.labels == "" for r in rows if "icense" not in texts[r.doc_id] and "CC BY" not in texts[r.doc_id])


def test_edges(spark, same_as_sql):
    mit = licenses.TEMPLATES[0][1]
    torn = mit.replace("free of charge ", "").replace("obtaining a", "who is obtaining a")
    texts = [None, "", "two words", "Under THE mit-License", "under the mit license " * 50, "cc by nc cc by nc", "cc-by-nc under the MIT licenſe",
             mit, torn, "x " * 500 + torn.upper() + " y" * 500, "a copy of this software", "apache license version 22", "İ K under the mit license",
             "under the mit license apache license, version 2.0", "é" * 300]
    rows = [(i, t, "s") for i, t in enumerate(texts)] + [(None, "cc by nc", "s"), (4, texts[4], "s"), (4, texts[4], "s"), (6, "other", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, label string")
    found = licenses.scan(docs)
    same_as_sql(found.withColumn("score", licenses.F.round("score", 6)), EXPECTED[NAME], documents=docs)
    got = found.collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got if r.doc_id not in (4, 6)}
    assert all(base(by_id[i]) == plain(t) for i, t in enumerate(texts) if i not in (4, 6))
    assert "mit" in by_id[8].labels and "mit" in by_id[9].labels and by_id[10].labels == ""
    assert licenses.scan(docs.limit(0)).count() == 0


def test_repeated_words_of_a_template_are_no_license(spark, same_as_sql):
    gpl = dict(licenses.TEMPLATES)["gpl"]
    scattered = " ".join(" ".join(gpl.split()[i : i + 3]) + " and then some other words of one's own" for i in range(0, 27, 3))
    texts = ["version 2 0 " * 9, "with or without " * 20, "under the terms " * 8, "general public license " * 6, scattered, gpl + " x " + gpl, gpl]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = licenses.scan(docs)
    same_as_sql(found.withColumn("score", licenses.F.round("score", 6)), EXPECTED[NAME], documents=docs)
    got = {r.doc_id: (r.labels, r.score) for r in found.collect()}
    assert [got[i] for i in range(5)] == [("", 0.0)] * 5
    assert [got[i] for i in (5, 6)] == [("gpl", 1.0)] * 2


def test_whole_texts_as_templates(spark):
    text = " ".join(f"w{i % 61}x{i % 7} clause{i}" for i in range(300))
    docs = spark.createDataFrame([(1, "Preface. " + text), (2, text.replace(" clause5 ", " ")), (3, " ".join(text.split()[:200])), (4, "clause1 " * 500)],
                                 "doc_id long, text string")
    got = {r.doc_id: r for r in licenses.scan(docs, templates=(("own", text),)).collect()}
    assert (got[1].labels, got[1].score) == ("own", 1.0) and got[2].labels == "own" and 0.98 < got[2].score < 1
    assert got[3].labels == "" and got[4].labels == ""

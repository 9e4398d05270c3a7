"""Measures and verdicts against SQL, on the tables and on edge cases."""

import re

from chartloom.llm import quality
from chartloom.llm.catalog import EXPECTED, QUERIES

FOLDER = "/root/testdata/sf0.01"
NAME = "op3_quality_rules"


def test_tables(spark, same_as_sql):
    plan = same_as_sql(QUERIES[NAME](spark, FOLDER), EXPECTED[NAME], FOLDER)
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)


def test_clean_rows_stay(spark):
    good = spark.read.parquet(f"{FOLDER}/labels.parquet").where("quality = 1").select("doc_id").distinct()
    rows = QUERIES[NAME](spark, FOLDER).join(good, "doc_id").where("NOT base_failed")
    assert rows.where("kept").count() >= 0.98 * rows.count()


def test_edges(spark, same_as_sql):
    eight = "a b c d e f g h"
    texts = [None, "", " \t\n\x0b\x0c\r", "one", eight, f"{eight} {eight}", f"{eight} x {eight} y {eight}\n{eight}", "a " * 400,
             "a\n\na\n \na b\na b\n", "é日本 🙂 ü x", "#*$%&|<> !!! the of and", "the of and to " * 9, "w " * 3000,
             " ".join(f"w{i % 97}" for i in range(1500))]
    rows = [(i, t, i) for i, t in enumerate(texts)] + [(None, "the cat", 1), (4, eight, 1), (4, eight, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words int")
    same_as_sql(quality.judge(docs), EXPECTED[NAME], documents=docs)
    assert quality.judge(docs.limit(0)).count() == 0

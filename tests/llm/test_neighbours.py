"""Scores, order and recall against brute force; edge cases."""

import numpy as np
from pyspark.sql import functions as F

from chartloom.llm import neighbours
from chartloom.llm.catalog import QUERIES


def brute(ids, vectors, queries, k=5):
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    out = {}
    for q in queries:
        scores = unit @ unit[ids.index(q)]
        best = sorted(((-round(float(s), 12), i) for s, i in zip(scores, ids) if i != q))[:k]
        out[q] = [(i, -s) for s, i in best]
    return out


def test_recall_and_exact_scores(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = df.orderBy("vec_id").collect()
    ids, vectors = [r.vec_id for r in rows], np.array([r.embedding for r in rows], float)
    truth = brute(ids, vectors, [i for i in ids if i % 50 == 0])
    got = neighbours.search(df, F.col("vec_id") % 50 == 0).collect()
    place = {i: n for n, i in enumerate(ids)}
    hits = 0
    for q, expected in truth.items():
        own = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q)
        assert [r for r, _, _ in own] == [1, 2, 3, 4, 5]
        assert [(-s, i) for _, i, s in own] == sorted((-s, i) for _, i, s in own)
        for _, i, s in own:
            a, b = vectors[place[q]], vectors[place[i]]
            assert abs(s - a @ b / np.linalg.norm(a) / np.linalg.norm(b)) < 1e-12
        hits += len({i for _, i, _ in own} & {i for i, _ in expected})
    assert hits >= 0.9 * 5 * len(truth), hits / 5 / len(truth)


def test_longest_prefixes_come_first():
    pick = np.random.default_rng(5)
    vectors = pick.normal(size=(400, 16))
    forest = neighbours.Forest(vectors)
    found = list(forest.candidates(vectors[:10] + 1e-9, 30))
    assert all(q in f and len(f) >= 30 for q, f in enumerate(found))
    assert all(len(f) == 400 for f in forest.candidates(vectors[:2], 400))


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    good = [(i, [float(np.cos(i)), float(np.sin(i)), 0.5]) for i in range(60)]
    same = [(1000 + i, [1.0, 2.0, 3.0]) for i in range(40)]
    bad = [(200, None), (250, [0.0, 0.0, 0.0]), (300, [nan, 1.0, 1.0]), (350, [inf, 1.0, 0.0]), (400, [None, 1.0, 1.0]), (None, [1.0, 1.0, 1.0]), (450, [])]
    rows = good + same + bad + [(0, good[0][1]), (1000, same[0][1])]
    df = spark.createDataFrame([(i, v, 7) for i, v in rows], "vec_id long, embedding array<float>, score int")
    got = neighbours.search(df, F.col("vec_id") % 50 == 0, share=1.0).collect()
    as_float = {i: np.array(v, np.float32).astype(float) for i, v in good + same}
    ids = list(as_float)
    truth = brute(ids, np.array(list(as_float.values())), [0, 50, 1000])
    assert {r.query_id for r in got} == {0, 50, 1000}
    for q, expected in truth.items():
        assert [r.vec_id for r in sorted(got, key=lambda r: r.rank) if r.query_id == q] == [i for i, _ in expected]
    few = neighbours.search(df.where("vec_id in (0, 1, 2)"), F.col("vec_id") == 0).collect()
    assert [(r.rank, r.vec_id) for r in sorted(few, key=lambda r: r.rank)] == [(1, 1), (2, 2)]
    assert neighbours.search(df.limit(0), F.lit(True)).count() == 0


def test_repeated_rows_do_not_push_out_other_ids(spark):
    same = [1.0, 2.0, 3.0]
    for rows in (
        [(1000, same)] * 20 + [(1000 + i, same) for i in range(1, 10)],
        [(1000 + i, same) for i in range(10) for _ in range(3)],
    ):
        df = spark.createDataFrame(rows + [(1, [3.0, 2.0, 1.0])], "vec_id long, embedding array<float>")
        got = neighbours.search(df, F.col("vec_id") == 1000, share=1.0).collect()
        assert sorted((r.rank, r.vec_id) for r in got) == [(i, 1000 + i) for i in range(1, 6)]
        assert all(abs(r.score - 1) < 1e-12 for r in got)


def test_very_large_and_very_small_components(spark):
    rows = [(0, [1e200, 1e200, 0.0]), (1, [1.0, 1.0, 1.0]), (2, [1e-200, 0.0, 1e-200]), (3, [5e-324, 0.0, 0.0]), (4, [-1e308, 1e308, 1e308])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r.vec_id: r.score for r in neighbours.search(df, F.col("vec_id") == 0, share=1.0).collect()}
    expected = {1: 2 / 6**0.5, 2: 0.5, 3: 0.5**0.5, 4: 0.0}
    assert got.keys() == expected.keys() and all(abs(got[i] - s) < 1e-12 for i, s in expected.items())


def test_the_registered_query_is_exact(spark):
    folder = "/root/testdata/sf0.01"
    df = QUERIES["op10_hash_forest"](spark, folder)
    assert [(f.name, f.dataType.simpleString()) for f in df.schema.fields] == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "double")]
    rows = {r.vec_id: np.array(r.embedding, float) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect() if r.embedding is not None}
    got = df.collect()
    truth = brute(list(rows), np.array(list(rows.values())), [i for i in rows if i % 50 == 0])
    hits = sum(r.vec_id in {i for i, _ in truth[r.query_id]} for r in got)
    assert len(got) == 5 * len(truth) and hits >= 0.9 * len(got)
    for r in got:
        a, b = rows[r.query_id], rows[r.vec_id]
        assert abs(r.score - a @ b / np.linalg.norm(a) / np.linalg.norm(b)) < 1e-12

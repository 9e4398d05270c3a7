"""The mix against SQL and against sharing out the excess step by step; edge cases."""

from collections import defaultdict

from chartloom.llm import mixture
from chartloom.llm.catalog import EXPECTED, QUERIES

FOLDER = "/root/testdata/sf0.01"
NAME = "op6_source_mix"


def shared_out(sizes):
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: mixture.WEIGHTS[i % 3] for i, s in enumerate(names)}
    target, left, free = dict.fromkeys(names, 0.0), 1.5 * sum(sizes.values()), set(names)
    while left > 1e-9 and free:
        total = sum(weight[s] for s in free)
        for s in free:
            target[s] += left * weight[s] / total
        left = sum(max(0.0, target[s] - 2 * sizes[s]) for s in free)
        for s in list(free):
            if target[s] >= 2 * sizes[s]:
                target[s] = 2.0 * sizes[s]
                free.discard(s)
    return target


def check(rows):
    sizes, took, target = defaultdict(int), defaultdict(int), {}
    for r in rows:
        sizes[r.source] += r.size
        took[r.source] += r.taken
        target[r.source] = r.target
        assert 0 <= r.taken <= 2 * r.size
    for s, t in shared_out(sizes).items():
        assert abs(target[s] - t) < 1e-6 * max(t, 1)
        assert 0 <= t - took[s] < 4, s


def test_tables(spark, same_as_sql):
    plan = same_as_sql(QUERIES[NAME](spark, FOLDER), EXPECTED[NAME], FOLDER)
    assert "Python" not in plan
    check(mixture.mix(spark.read.parquet(f"{FOLDER}/documents.parquet")).collect())


def test_edges(spark, same_as_sql):
    rows = [(i, "w " * (i % 7), f"s{i % 5 if i % 3 else 0}", 1) for i in range(300)]
    rows += [(1000 + i, "x y z", None, 1) for i in range(40)] + [(None, "a b", "s1", 1)] * 3 + [(2000, None, "empty", 1), (7, "", "s2", 1)]
    rows += [(5000, "long " * 3000, "s4", 2), (5001, "w", "z1", 0), (5001, "w", "z1", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size int")
    found = mixture.mix(docs)
    check(found.collect())
    same_as_sql(found.select("doc_id", "size", "source_size", mixture.F.round("target", 6).alias("target"), "taken"),
                EXPECTED[NAME], documents=docs)
    assert mixture.mix(docs.limit(0)).count() == 0


def test_apply_takes_what_mix_says(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    mixed = mixture.apply(docs)
    assert mixed.columns == docs.columns
    got = mixed.groupBy("doc_id").agg(mixture.F.sum(mixture.size_of(mixture.F.col("text"))).alias("n"))
    expected = mixture.mix(docs).where("taken > 0").select("doc_id", "taken")
    assert got.exceptAll(expected).count() == 0 and expected.exceptAll(got).count() == 0


def test_a_lot_of_equal_rows_is_shared_to_the_last_word(spark, same_as_sql):
    for rows in ([(None, "w", "s", "a")] * 1000, [(None, "a b", None, "x")] * 7 + [(1, "one two three", "s", "y")] * 5, [(i % 3, "w v", "s", "z") for i in range(50)]):
        docs = spark.createDataFrame(rows, "doc_id long, text string, source string, place string").repartition(5)
        found = mixture.mix(docs)
        got = found.collect()
        same_as_sql(found.select("doc_id", "size", "source_size", mixture.F.round("target", 6).alias("target"), "taken"), EXPECTED[NAME], documents=docs)
        took, target = defaultdict(int), {}
        for r in got:
            took[r.source] += r.taken
            target[r.source] = r.target
            assert 0 <= r.taken <= 2 * r.size
        assert all(0 <= target[s] - took[s] < 1 for s in target)
        applied = mixture.apply(docs)
        words = applied.groupBy("source").agg(mixture.F.sum(mixture.size_of(mixture.F.col("text"))).alias("n")).collect()
        assert {r.source: r.n for r in words} == took


def test_columns_may_have_any_names(spark):
    names = ["row", "size", "key", "taken", "shares", "c", "times", "part", "time", "_size", "_key", "_c", "epochs", "cut_more"]
    rows = [(i, "a b c " * (i % 4), f"s{i % 3}", *[f"{n}{i}" for n in names]) for i in range(40)]
    docs = spark.createDataFrame(rows, ["doc_id", "text", "source", *names])
    plain = mixture.apply(docs.select("doc_id", "text", "source")).collect()
    got = mixture.apply(docs)
    assert got.columns == docs.columns
    got = got.collect()
    assert sorted((r.doc_id, r.text) for r in got) == sorted((r.doc_id, r.text) for r in plain)
    assert all(r[n] == f"{n}{r.doc_id}" for r in got for n in names)

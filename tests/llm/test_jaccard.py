"""Components against brute force over all pairs; hot groups; edge cases."""

import random
import re
from itertools import combinations

import duckdb
import pytest

from chartloom.llm import jaccard
from chartloom.llm.catalog import QUERIES


def plain_sets(texts, width):
    out = []
    for text in texts:
        folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", folded) if x]
        out.append({tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set())
    return out


def brute(rows, width, percent):
    """{row place: smallest id of its component} and sizes, by inverted lists and full comparison."""
    sets = plain_sets([t for _, t in rows], width)
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        a, b = sets[i], sets[j]
        if a and b and 100 * min(len(a), len(b)) >= percent * max(len(a), len(b)):
            both = len(a & b)
            if 100 * both >= percent * (len(a) + len(b) - both):
                parent[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)] = min(least.get(root(i), doc_id), doc_id)
    return sorted(((rows[i][0], len(sets[i]), least.get(root(i))) for i in range(len(rows))), key=str)


def got(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=str)


def test_prefix_sizes():
    for percent in (80, 90):
        for n in range(1, 200):
            need = -(-percent * n // 100)
            assert jaccard.prefix_size(n, percent) == n - need + 1
    assert jaccard.prefix_size(0, 90) == 0


def test_table(spark):
    folder = "/root/testdata/sf0.001"
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{folder}/documents.parquet'").fetchall()
    assert got(QUERIES["op5_ngram_jaccard"](spark, folder)) == brute(rows, 3, 90)


@pytest.mark.parametrize(("width", "percent", "seed"), [(3, 90, 1), (5, 80, 2)])
def test_near_copies_chains_and_hot_passages(spark, width, percent, seed):
    pick = random.Random(seed)
    word = lambda: "".join(pick.choice("abcdefgh") for _ in range(pick.randint(2, 5)))
    passage = " ".join(word() for _ in range(40))
    rows = []
    for g in range(6):
        text = [word() for _ in range(pick.choice([30, 80, 200]))]
        for _ in range(pick.choice([1, 5, 25])):
            rows.append(" ".join(text))
            text = text[:]
            for _ in range(pick.randint(0, 1 + len(text) // 60)):  # a chain: each a near copy of the one before
                text[pick.randrange(len(text))] = word()
    rows += [passage + " " + " ".join(word() for _ in range(pick.randint(0, 60))) for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(rows)]
    pick.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(jaccard.join(docs, width, percent)) == brute(rows, width, percent)


def test_edges(spark):
    long = " ".join(f"w{i}" for i in range(3000))
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "ONE"), (6, "one two"), (7, "One  Two\n"), (8, long), (9, long.upper()),
            (9, long), (9, long), (None, long), (None, "alone here now"), (None, "alone here now"), (10, long + " x"), (11, "é É one"), (None, None)]
    docs = spark.createDataFrame([(i, t, 5) for i, t in rows], "doc_id long, text string, n int")
    for width, percent in ((3, 90), (5, 80)):
        assert got(jaccard.join(docs, width, percent)) == [
            (d, n, d if n == 0 else c) for d, n, c in brute(rows, width, percent)]
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, (r.text or "")[:9]) for r in kept.collect()), key=str) == sorted(
        [(1, ""), (2, ""), (3, " \n\t"), (4, "one"), (6, "one two"), (8, long[:9]), (None, "alone her"), (11, "é É one"), (None, "")], key=str)
    assert jaccard.join(docs.limit(0), 3, 90).count() == 0


def test_one_row_of_each_component_stays(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(100)) for x in "abc")
    for rows, expected in (
        ([(5, a), (5, b), (7, b + " x")], [(5, a), (5, b)]),  # one id in two components, the smallest of both
        ([(5, b), (5, a), (7, a + " x"), (5, a)], [(5, a), (5, b)]),
        ([(5, a), (6, a + " x"), (None, a + " y"), (None, b)], [(5, a), (None, b)]),
    ):
        kept = jaccard.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
        assert sorted(((r.doc_id, r.text) for r in kept), key=str) == sorted(expected, key=str)
    # near copies without any id: one of them stays
    kept = jaccard.keep_one(spark.createDataFrame([(None, c), (None, c + " x"), (None, c + " y"), (None, a)], "doc_id long, text string")).collect()
    assert sorted(r.text[:2] for r in kept) == ["a0", "c0"]


def test_columns_may_have_any_names(spark):
    a, b = (" ".join(f"{x}{i}" for i in range(60)) for x in "ab")
    rows = [(1, a, "m1", 7), (2, a + " x", "m2", 8), (3, b, "m3", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _mark string, node int").withColumnRenamed("node", "own_mark")
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(tuple(r) for r in kept.collect()) == [rows[0], rows[2]]


@pytest.mark.parametrize(("bucket", "block"), [(2, 5), (2, 1000)])
def test_large_buckets_in_blocks(spark, monkeypatch, bucket, block):
    monkeypatch.setattr(jaccard, "TINY", 1)
    monkeypatch.setattr(jaccard, "BUCKET", bucket)
    monkeypatch.setattr(jaccard, "BLOCK", block)
    monkeypatch.setattr(jaccard, "MAX_ROUNDS", 1)  # leave much to the blocks
    pick = random.Random(8)
    base = [f"w{pick.randrange(10 ** 6)}" for _ in range(60)]
    rows = []
    for i in range(70):
        text = base[:]
        for _ in range(pick.randint(0, 3)):
            text[pick.randrange(60)] = f"v{i}x{pick.randrange(10 ** 6)}"
        rows.append((i, " ".join(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for width, percent in ((3, 90), (5, 80)):
        assert got(jaccard.join(docs, width, percent)) == brute(rows, width, percent)


def test_signatures_never_hide_a_common_token(spark):
    pick = random.Random(3)
    texts = [" ".join(f"w{pick.randrange(3000)}" for _ in range(4000)) for _ in range(3)]  # more tokens than bits can tell apart
    docs = spark.createDataFrame(list(enumerate(texts)), "node long, text string")
    sig = {r.node: set(jaccard.np.frombuffer(r.tokens, jaccard.np.uint32).tolist()) for r in jaccard.signatures(docs, 1).collect()}
    plain = plain_sets(texts, 1)
    for i in range(3):
        assert len(sig[i]) == len(plain[i])
        for j in range(3):
            assert len(sig[i] & sig[j]) >= len(plain[i] & plain[j])

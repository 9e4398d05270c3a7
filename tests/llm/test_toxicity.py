"""Marginals against enumeration of all taggings; held-out quality; edge cases."""

import itertools

import numpy as np
import pyarrow as pa

from chartloom.llm import toxicity
from chartloom.llm.catalog import QUERIES
from chartloom.llm.common import text_bytes

FOLDER = "/root/testdata/sf0.1"


def test_marginals_are_those_of_all_taggings():
    pick = np.random.default_rng(1)
    first = np.array([0, 0, 5, 6, 6, 10])
    emission, a = np.exp(pick.normal(size=10)), np.exp(pick.normal(size=(2, 2)))
    forward, backward = toxicity.forward_backward(emission, first, a)
    got = forward * backward / (1 + forward * backward)
    for lo, hi in zip(first[:-1], first[1:]):
        total, toxic = 0.0, np.zeros(hi - lo)
        for tags in itertools.product((0, 1), repeat=hi - lo):
            weight = np.prod([emission[lo + i] for i, t in enumerate(tags) if t] or [1.0])
            weight *= np.prod([a[x, y] for x, y in zip(tags, tags[1:])] or [1.0])
            total += weight
            toxic += weight * np.array(tags)
        assert np.allclose(got[lo:hi], toxic / total)


def test_held_out_quality(spark):
    found = QUERIES["op8_toxicity"](spark, FOLDER)
    assert dict(found.dtypes) == {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int", "toxic_spans": "string"}
    assert found.where("predicted <> if(score >= 0.3, 1, 0)").count() == 0 and found.where("predicted = 1 and toxic_spans <> ''").count() > 100
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    rows = found.join(labels, "doc_id").where("held_out").select("toxic", "predicted", "score").collect()
    hit = sum(r.predicted for r in rows if r.toxic == 1) / sum(r.toxic for r in rows)
    wrong = sum(r.predicted for r in rows if r.toxic == 0) / sum(r.toxic == 0 for r in rows)
    assert hit > 0.9 and wrong < 0.03, (hit, wrong)


def test_frame(spark):
    rows = [(i, ("you idiot moron " if i % 2 else "you nice friend ") * (1 + i % 3) + f"w{i}", i % 2) for i in range(60)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(100, None), (100, None), (None, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, x) for i, _, x in rows] + [(None, 1), (3, None)], "doc_id long, toxic int")
    tagger = toxicity.fit(docs, labels)
    got = toxicity.score(docs, tagger, with_spans=True).collect()
    assert len(got) == 63
    assert all((r.score >= 0.3) == (r.doc_id % 2 == 1) for r in got if r.doc_id is not None and r.doc_id < 60)
    spans = next(r.toxic_spans for r in got if r.doc_id == 1)
    assert spans and all("idiot" in rows[1][1][s.start : s.end] for s in spans)
    assert all(r.toxic_spans == [] for r in got if r.doc_id in (100, None))
    assert toxicity.score(docs.limit(0), tagger).count() == 0
    untaught = toxicity.fit(docs, labels.limit(0))
    assert {r.score for r in toxicity.score(docs, untaught).collect()} == {0.5}


def test_a_score_does_not_depend_on_neighbours():
    some = toxicity.sequences(*text_bytes(pa.array(["bc word ça"], pa.string()))).features[:, 0]
    tagger = toxicity.Tagger(np.sort(some), np.array([1.0, -2.0, 3.0]), -1.0, np.eye(2), np.array([-1.0, 1, 1]))
    texts = ["a bc def", "", "word " * 5000, "Été, ça va"]
    def scores(some):
        seq = toxicity.sequences(*text_bytes(pa.array(some, pa.string())))
        return tagger.scores(tagger.marginals(seq), seq.first)
    together = scores(texts)
    assert np.allclose(together, [scores([t])[0] for t in texts])


def test_query_against_plain_loops(spark):
    """Scores of whole texts by a forward-backward pass in plain Python, word by word."""
    import math

    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    tagger = toxicity.fit(docs, labels)
    weight, a = dict(zip(tagger.known.tolist(), tagger.weights)), np.exp(tagger.transitions)

    def plain(text):
        words = toxicity.sequences(*text_bytes(pa.array([text], pa.string()))).features.tolist()
        e = [math.exp(min(max(tagger.bias + sum(weight.get(f, 0.0) for f in w), -30), 30)) for w in words]
        forward, backward = [], [None] * len(e)
        for t, x in enumerate(e):  # states clean and toxic, scaled at each step
            clean, toxic = (1.0, x) if not t else (
                forward[-1][0] * a[0, 0] + forward[-1][1] * a[1, 0], x * (forward[-1][0] * a[0, 1] + forward[-1][1] * a[1, 1]))
            forward.append((clean / (clean + toxic), toxic / (clean + toxic)))
        for t in reversed(range(len(e))):
            if t == len(e) - 1:
                backward[t] = (0.5, 0.5)
            else:
                c, x = backward[t + 1][0], e[t + 1] * backward[t + 1][1]
                clean, toxic = a[0, 0] * c + a[0, 1] * x, a[1, 0] * c + a[1, 1] * x
                backward[t] = (clean / (clean + toxic), toxic / (clean + toxic))
        p = [f[1] * b[1] / (f[0] * b[0] + f[1] * b[1]) for f, b in zip(forward, backward)]
        x = tagger.document @ [1, math.log1p(sum(p)), max(p, default=0.0)]
        return 1 / (1 + math.exp(-min(max(x, -30), 30)))

    got = {r.doc_id: r.score for r in QUERIES["op8_toxicity"](spark, folder).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert got.keys() == texts.keys() and any(s > 0.9 for s in got.values())
    assert all(abs(got[d] - plain(t)) < 1e-6 for d, t in texts.items())

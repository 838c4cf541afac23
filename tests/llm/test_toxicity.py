import random
import zlib

import pytest

from clientincome.llm import queries, toxicity
from clientincome.llm.common import table
from tests.llm import brute


def test_maximal_segments():
    rng = random.Random(1)
    for _ in range(300):
        n = rng.randrange(1, 25)
        other = -rng.uniform(0.2, 3)
        hits = [(i, rng.uniform(-0.5, 5)) for i in range(n) if rng.random() < 0.4]
        scores = [other] * n
        for i, s in hits:
            scores[i] = s
        assert [(a, b) for a, b, _ in toxicity.maximal_segments(hits, other)] == brute.maximal_segments(scores)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r["doc_id"]: r["toxic"] for r in table(spark, sf, "labels").collect()}
    rows = queries.op2_toxicity(spark, sf).collect()
    assert len(rows) == 10_000 and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert all(r["predicted"] == int(r["score"] >= 0.5) and 0 <= r["score"] <= 1 for r in rows)
    held = [(r["predicted"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    right = sum(p == y for p, y in held)
    false = sum(p and not y for p, y in held)
    assert right >= 0.97 * len(held) and false <= 0.01 * len(held)


def test_passages_and_drop(spark, make_docs):
    rng = random.Random(3)
    plain = [f"word{i}" for i in range(500)]
    text = lambda n: [rng.choice(plain) for _ in range(n)]
    rows, labels = [], []
    for i in range(400):
        t = text(200)
        if i % 4 == 0:
            t[100:110] = ["vile", *text(3), "nasty", "vile", *text(3), "awful"]
        rows.append((i, " ".join(t)))
        labels.append((i, 1, int(i % 4 == 0)))
    docs = make_docs(rows)
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert {"vile", "nasty", "awful"} >= set(model.segments.weights) >= {"vile"}
    found = toxicity.passages(docs, model).collect()
    assert {r["doc_id"] for r in found} == {i for i in range(400) if i % 4 == 0}
    assert all(90 <= r["first"] <= 110 and r["end"] <= 112 for r in found)
    kept = toxicity.drop_toxic(docs, model)
    assert {r["doc_id"] for r in kept.collect()} == {i for i in range(400) if i % 4} and kept.columns == docs.columns


@pytest.mark.parametrize("toxic, share", [([], 0), ([0, 0], 0), ([1, 1], 1)])
def test_labels_of_one_class(spark, make_docs, toxic, share):
    labels = spark.createDataFrame([(i, 1, y) for i, y in enumerate(toxic)], "doc_id long, quality int, toxic int")
    docs = make_docs([(i, "some words") for i in range(4)])
    assert [round(r["score"]) for r in toxicity.score(docs, toxicity.fit(docs, labels)).collect()] == [share] * 4


def test_odd_rows(spark, odd_docs, make_docs):
    labels = spark.createDataFrame([(1, 0, 1), (1, 0, 0), (3, None, None), (None, 1, 1), (4, 1, 0), (6, 1, 0)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(odd_docs, labels)
    assert toxicity.score(odd_docs, model).count() == odd_docs.count()
    assert toxicity.drop_toxic(odd_docs, model).columns == odd_docs.columns
    assert toxicity.score(make_docs([]), toxicity.fit(make_docs([]), labels)).count() == 0

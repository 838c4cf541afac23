"""Language identification: segmentations by enumeration, held-out accuracy, odd rows."""

import math
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from clientincome.llm import language_id as li
from clientincome.llm import queries

SF = "/root/testdata/sf0.01"


def segmentations(word: bytes, pieces: dict[bytes, int]):
    if not word:
        yield []
    for end in range(1, len(word) + 1):
        if word[:end] in pieces:
            for rest in segmentations(word[end:], pieces):
                yield [pieces[word[:end]], *rest]


@pytest.fixture(scope="module")
def sums():
    v = li.Vocabulary(queries.vocabulary(queries.MULTI_RANKS))
    p = np.random.default_rng(1).dirichlet(np.ones(v.none), 3).T
    return li.Segmentations(v, np.vstack([p, np.zeros(3)]))


WORDS = [b" the", b" information", " über".encode(), " été".encode(), b" x", b" information"]


def test_forward_sums_every_segmentation(sums):
    got = sums.log_sums(WORDS)
    for w, row in zip(WORDS, got, strict=True):
        want = sum(np.prod(sums.p[s], axis=0) for s in segmentations(w, sums.v.number))
        assert np.allclose(np.exp(row), want, rtol=1e-9)


def test_expected_counts_are_those_of_every_segmentation(sums):
    counts = np.arange(1.0, 1 + 3 * len(WORDS)).reshape(-1, 3)
    want = np.zeros_like(sums.p)
    for w, n in zip(WORDS, counts, strict=True):
        all_ = [(s, np.prod(sums.p[s], axis=0)) for s in segmentations(w, sums.v.number)]
        total = sum(x for _, x in all_)
        for s, x in all_:
            for i in s:
                want[i] += n * x / total
    assert np.allclose(sums.expected(WORDS, counts), want, rtol=1e-9)


def test_long_words_agree_with_short_ones(sums, monkeypatch):
    words = [b" " + b"abcdefgh" * 7, " éè".encode() * 9]
    whole = sums.log_sums(words)
    monkeypatch.setattr(li, "LONG", 8)
    assert np.allclose(sums.log_sums(words), whole)
    assert np.isfinite(sums.log_sums([b" " + b"qx" * 20_000])).all()


def test_words_of_a_text():
    assert li.words_of("L'Été 12 ab_c x\n") == [w.encode() for w in ("l", "été", "ab", "c", "x")]
    assert li.words_of("日本 a") == ["日本".encode(), b"a"] and li.words_of("日本") == ["日本".encode()]
    assert li.words_of(None) == li.words_of("12 -- ½") == li.words_of("… — ²") == []


def test_table_of_hashes_holds_each_piece_and_no_other(sums):
    v = sums.v
    pieces = [p for p in v.number if len(p) == 7]
    where, ids = v.find(np.array([h(p) for p in pieces], np.uint64))
    assert list(where) == list(range(len(pieces))) and list(ids) == [v.number[p] for p in pieces]
    others = [b"%07d" % i for i in range(5000) if b"%07d" % i not in v.number]
    assert len(v.find(np.array([h(p) for p in others], np.uint64))[0]) == 0


def h(piece: bytes) -> int:
    out = 0
    for c in piece:
        out = (out + c + 1) * int(li._FACTOR) % 2**64
    return out


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = queries.op12_language_id(spark, SF).join(docs.select("doc_id", "lang", "text"), "doc_id").collect()
    assert len(rows) == docs.count()
    learnt = {r["lang"] for r in rows if not r["held_out"]}
    for r in rows:
        assert r["held_out"] == (crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["lang_pred"] in learnt | {"und"}
        assert (r["lang_pred"] == "und") == (not li.words_of(r["text"]))
    judged = [r for r in rows if r["held_out"] and r["lang_pred"] != "und" and len(li.words_of(r["text"])) >= 5]
    assert len(judged) > 150 and sum(r["lang"] == r["lang_pred"] for r in judged) >= 0.97 * len(judged)


def test_odd_rows_and_what_is_not_an_input(spark, odd_docs):
    docs = odd_docs.withColumn("lang", F.when(F.col("doc_id") == 4, "aa").when(F.col("doc_id") == 3, "bb")).withColumn("lang_pred", F.lit("x"))
    model = li.fit(docs, F.col("doc_id") > 0, queries.vocabulary(queries.MULTI_RANKS))
    assert model.languages == ["aa", "bb"] and math.isclose(np.exp(model.log_prior).sum(), 1)
    got = li.identify(docs, model)
    rows = sorted((r["doc_id"] or 0, r["lang_pred"], round(r["score"], 9)) for r in got.collect())
    assert len(rows) == docs.count()
    assert [r for r in rows if r[0] in (1, 2, 5)] == [(1, "und", 0.0), (2, "und", 0.0), (5, "und", 0.0)]
    # other ids, languages and sources: the same predictions
    other = docs.withColumn("lang", F.lit("zz")).withColumn("source", F.lit(None).cast("string")).withColumn("doc_id", F.col("doc_id") + 100)
    moved = sorted((r["doc_id"] - 100 if r["doc_id"] else 0, r["lang_pred"], round(r["score"], 9)) for r in li.identify(other, model).collect())
    assert moved == rows


def test_nothing_learnt_and_empty(spark, make_docs):
    docs = make_docs([(1, "some words"), (2, None)])
    nothing = li.fit(docs, F.lit(False), queries.vocabulary(queries.MULTI_RANKS))
    assert {tuple(r) for r in li.identify(docs, nothing).collect()} == {(1, "und", 0.0), (2, "und", 0.0)}
    one = li.fit(docs, F.lit(True), queries.vocabulary(queries.MULTI_RANKS))
    assert {tuple(r) for r in li.identify(docs, one).collect()} == {(1, "en", 1.0), (2, "und", 0.0)}
    assert li.identify(docs.limit(0), one).collect() == []

import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from clientincome.llm import decontaminate, line_dedup
from clientincome.llm.queries import CAPACITY
from tests.llm import brute

FOLDER = "/root/testdata/sf0.01"
ODD = 1_000_000  # added to the ids of the odd rows

STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def odd_folder(spark, odd_docs, tmp_path_factory):
    """Tables with whole documents, odd rows, and columns whose names clash with the operators' own."""
    folder = str(tmp_path_factory.mktemp("tables"))
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").unionByName(odd_docs.withColumn("doc_id", F.col("doc_id") + ODD))
    extra = docs.withColumns({"score": F.lit("x"), "node": F.col("doc_id"), "piece": F.lit(1), "a": F.lit(None).cast("int"), "held_out": F.lit(True)})
    extra.write.parquet(f"{folder}/documents.parquet")
    for name in ("labels", "benchmark"):
        os.symlink(f"{FOLDER}/{name}.parquet", f"{folder}/{name}.parquet")
    return folder


def test_stages(spark, odd_folder):
    """Each stage on what its predecessor kept, against the plain versions of the operators."""
    docs = spark.read.parquet(f"{odd_folder}/documents.parquet").cache()
    columns = docs.columns
    rows = lambda df: sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "") for r in df.collect())

    calm = STAGES["toxicity"](spark, docs, odd_folder).cache()
    assert calm.columns == columns and set(rows(calm)) < set(rows(docs))
    toxic = {r["doc_id"] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").where("toxic = 1").collect()}
    clean = {r["doc_id"] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").where("toxic = 0").collect()}
    left = {r["doc_id"] for r in calm.collect()}
    # some 40 toxic labels to learn from: no more than that most toxic rows go, and clean ones stay
    assert len(toxic & left) < 0.5 * len(toxic) and len(clean - left) <= 0.05 * len(clean)

    cut = STAGES["line dedup"](spark, calm, odd_folder).cache()
    assert cut.columns == columns and cut.count() == calm.count()
    plain = brute.spread_lines([(i, r["text"], r["source"]) for i, r in enumerate(calm.collect())], line_dedup.MIN_SITES)
    assert sorted(plain.values()) == sorted(r["text"] or "" for r in cut.collect())

    single = STAGES["near duplicates"](spark, cut, odd_folder).cache()
    assert single.columns == columns
    texts = [(r["doc_id"], r["text"]) for r in cut.collect() if r["doc_id"] is not None and r["doc_id"] != ODD + 4]  # an id with two texts
    want = {d for d, (_, c) in brute.near_duplicates(texts).items() if d == c}
    assert {r["doc_id"] for r in single.collect() if r["doc_id"] is not None} - {ODD + 4} == want

    kept = STAGES["decontamination"](spark, single, odd_folder).cache()
    assert kept.columns == columns
    items = [decontaminate.normal(r["text"] or "") for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    held = {r["doc_id"] for r in single.collect() if any(i and i in decontaminate.normal(r["text"] or "") for i in items)}
    assert not held & {r["doc_id"] for r in kept.collect()}

    packed = STAGES["packing"](spark, kept, odd_folder).collect()
    assert {r["doc_id"] for r in packed} == {r["doc_id"] for r in kept.collect()}
    by = {}
    for r in packed:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= CAPACITY


def test_run(spark, odd_folder):
    assert corpus_pipeline.run(spark, odd_folder).count() > 0

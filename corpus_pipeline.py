"""Corpus pipeline: documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet in the shared folder and reread as the next stage's docs.
The first four keep the columns of documents: toxic documents go, boilerplate
lines are cut, one document of each near-duplicate group stays, documents that
hold a benchmark item go.  The last returns one row per packed piece.

Each stage states nulls, repeated rows and empty tables in its operator's
docstring; columns beyond doc_id, text and source pass through unread.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clientincome.llm import decontaminate, line_dedup, near_dup, packing, toxicity
from clientincome.llm.common import table, written
from clientincome.llm.queries import BYTE_VOCABULARY, CAPACITY, PACK_END, held_out, vocabulary


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is below 0.5; labels are learnt outside the held-out fifth."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), ~held_out())
    return toxicity.drop_toxic(docs, model)


def cut_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that many sources share."""
    return line_dedup.drop_lines(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, that of the smallest doc_id."""
    return near_dup.drop_near_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents left and their places in sequences."""
    return packing.pack(docs, vocabulary(BYTE_VOCABULARY), PACK_END, CAPACITY)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", cut_boilerplate),
    ("near duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

ORACLE_SQL = None  # toxicity, near duplicates and packing are beyond SQL; see tests/llm


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs

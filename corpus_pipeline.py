"""The corpus pipeline: quality rules, near duplicates, benchmark leaks, PII, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and reread as
the docs of the next. All stages but the last return the columns of ``documents``.

Defined results of every stage: an empty table gives an empty one; repeated rows are treated alike, whether
they stay or go; very long texts are read as a whole; further columns of ``docs`` pass through, whatever their
names. What each stage does with nulls, empty texts and ties stands there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boxloom.llm import bpe, decontamination, jaccard_join, pii, quality
from boxloom.llm.common import Shelf, table, without, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base test or a learned rule rejects go.

    Null and empty texts have no words and go. Labels count by id: of several labels of an id the lowest, and
    rows without an id are judged like others, but never labelled.
    """
    rules = quality.learn(docs, table(spark, sf_dir, "labels"))
    return docs.where(quality.passes(F.col("text"), rules))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of linked documents the one with the least id stays.

    Rows with the same id count as one document and stay or go together; rows without an id stay, and may link
    others. Null and empty texts are like nothing and stay. Ids are all different or equal, so there are no ties.
    """
    found = jaccard_join.jaccard_join(docs)
    return without(docs, written(found.where("doc_id > component_id").select("doc_id").distinct()), "doc_id")


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap a benchmark item go.

    Null and empty texts and items overlap nothing; rows without an id stay; rows with the same id go together.
    Items too short for the masks count where they stand word for word.
    """
    found = decontamination.overlaps(docs, table(spark, sf_dir, "benchmark"), short_items=True)
    return without(docs, written(found.where("doc_id IS NOT NULL").select("doc_id").distinct()), "doc_id")


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in texts is replaced by its kind in brackets; n_chars, where there is one, follows the text.

    All rows stay. Null and empty texts stay as they are; where spans overlap, the one that begins first and, of
    those, ends first is replaced.
    """
    clean = pii.redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else clean


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each text, and digests of the ids and of what they decode to, in a row for each document.

    Null texts count as empty: no ids.
    """
    return bpe.digests(docs, with_ids=True)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("benchmark_leaks", benchmark_leaks),
    ("private_data", private_data),
    ("tokens", tokens),
]

#: SQL cannot express the learned stages; tests/llm/test_pipeline.py holds each stage against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``. What a stage has read is deleted once the next has been written."""
    docs = table(spark, sf_dir, "documents")
    shelf = Shelf(spark)
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = shelf.put(docs)
            shelf.clear(docs)
    return docs

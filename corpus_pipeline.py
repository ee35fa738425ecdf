"""The corpus pipeline: five of the training-data operators, one after another.

STAGES lists (name, function); each function takes (spark, docs, sf_dir) and returns the DataFrame that the
next one gets, written as Parquet and read again.  All but the last return whole rows of documents; the
last returns a row for each piece of a packed sequence.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docledger.llm import jaccard, mixing, packing, quality, rules
from docledger.llm.queries import read, tokenizer_path
from docledger.llm.shared import written


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; it learns from the labels of the documents it gets."""
    return quality.keep_good(docs, quality.quality_model(docs, read(spark, sf_dir, "labels")))


def rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weighed rules reject go."""
    return rules.keep_by_rules(docs)


def join_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return jaccard.keep_one(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's rate has it."""
    return mixing.mix(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens."""
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [
    ("quality classifier", quality_stage),
    ("quality rules", rules_stage),
    ("n-gram Jaccard join", join_stage),
    ("mixing sources to target weights", mixing_stage),
    ("best-fit packing", packing_stage),
]

#: A trained classifier and a tokenizer are no SQL; tests/llm holds the stages against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

"""From raw documents to token files: STAGES in order, each over all rows that the one before kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read again for the next one.
All but the last return the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from canvass.llm.common import table, written
from canvass.llm.decontaminate import clean_documents
from canvass.llm.frames import token_frames
from canvass.llm.jaccard import one_of_each
from canvass.llm.mixing import mixed_documents
from canvass.llm.quality import good_documents


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return good_documents(docs, table(spark, sf_dir, "labels"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: five-word shingles, similarity of 0.8 or more."""
    return one_of_each(docs, n=5, percent=80)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return clean_documents(docs, table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, cut to the words it takes."""
    return mixed_documents(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in seekable files; one row per document read back from them."""
    return token_frames(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("n-gram Jaccard join", near_copies),
    ("benchmark decontamination", benchmark_decontamination),
    ("mixing sources", source_mix),
    ("token output", token_output),
]

#: A trained classifier, alignment and tokenization have no SQL; tests/llm/test_pipeline.py computes the rows another way.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

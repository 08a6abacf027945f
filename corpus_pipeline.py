"""A corpus pipeline over the table documents: quality, exact and near duplicates, source mix, tokens.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next
stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from casemill.llm import exact_dedup, mixing, quality, queries, shingle_dedup
from casemill.llm.common import stored, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the pairwise ranking accepts. The ranking learns from the labelled rows of this very input."""
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id, once."""
    return exact_dedup.without_copies(docs, keep="largest")


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near duplicates, five-word shingles with a Jaccard similarity of 0.8 or more, the document with the smallest doc_id."""
    return shingle_dedup.one_of_each(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in training order, once for every epoch in which the mix starts them."""
    return mixing.laid_out(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of every document's token ids and of their decoding."""
    return queries.encoded(spark, docs)


STAGES = [
    ("quality", quality_stage),
    ("exact", exact_stage),
    ("near", near_stage),
    ("mixing", mixing_stage),
    ("tokens", token_stage),
]

#: Fingerprints, components, a trained model and token ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents, each result written out and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs

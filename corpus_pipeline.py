"""The corpus pipeline: toxic documents and copies go, sources are mixed, texts become ids.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
returns the next stage's documents, which are written as Parquet and read again in
between. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from newsloom.llm import exact_dedup, mixing, parity_join, prefix_table, toxicity
from newsloom.llm.common import stored, table
from newsloom.operators.store import discard


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored at or over the toxicity threshold go."""
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the smallest doc_id stays."""
    return exact_dedup.deduplicate(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by five-word shingles (Jaccard of 0.8 or more) the smallest doc_id stays."""
    return parity_join.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each copy that the mix takes."""
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixed documents as SentencePiece ids."""
    return prefix_table.digests(docs, prefix_table.vocabulary_path(prefix_table.MODEL))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("parity_join", drop_near_copies),
    ("mixing", mix_sources),
    ("sentencepiece", encode),
]

#: Learnt scores, similarity joins and subword ids are no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again; a stage's input goes once its output is written."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        before, docs = docs, stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
        discard(before)
    return STAGES[-1][1](spark, docs, sf_dir)

"""The corpus pipeline: from documents to token files, in stages that each write their result.

A stage takes (spark, docs, sf_dir), works on all its predecessor kept, and returns the columns of
``docs`` again, but for the last, which returns a row per document in the token files. Empty tables
pass through every stage; null texts stay unless a stage's operator says otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hexmosaic.llm import decontaminate, jaccard, mixing, token_file, toxicity
from hexmosaic.llm.common import stored, table


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go."""
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies one row stays, of the smallest id."""
    return jaccard.keep_first(docs, repeats=False)


def without_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; the one at a source's cut is shortened."""
    return mixing.apply_mix(docs, mixing.mix(docs))


#: Word tokens that workers remember, in characters: they outlive the stage beside the memory of others.
REMEMBER = 4_000_000


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of all documents, read back: doc_id, start, n_tokens, ids_crc32."""
    return token_file.encode_documents(docs, remember=REMEMBER)


STAGES = [
    ("toxicity", without_toxic),
    ("near copies", without_near_copies),
    ("decontamination", without_leaks),
    ("mixing", mixed),
    ("token files", token_files),
]
#: A trained model decides the first stage and a tokenizer fills the last, so SQL can't express it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages one after the other, from the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs

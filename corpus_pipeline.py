"""The cleaning pipeline over ``documents``: each stage works on what its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpuscope.llm import decontamination, language, line_dedup, sentencepiece, simhash
from corpuscope.llm.common import Scratch, read_file

PIECES = "/opt/tokenizers/piece_bpe_32k.model"


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of no known language, or that have no words, go."""
    return language.accepted_documents(docs, language.fit(docs, unknown=True))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that several documents hold stay in the first; ``n_chars`` follows the text."""
    return line_dedup.deduplicated(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest ``doc_id``."""
    return simhash.representatives(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontamination.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The columns of documents, and the text's ``ids`` in the piece vocabulary."""
    return sentencepiece.encode_table(docs, read_file(spark, PIECES)).select("row.*", "ids")


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("encode", encode),
]

# The first stage weighs language models and the last segments by piece scores: neither is SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another, each written to the shared folder and read by the next."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = scratch.keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

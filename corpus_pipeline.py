"""A corpus from raw documents to tokens: STAGES in order, each over all that its predecessor kept."""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import public_tokenizers  # noqa: E402
from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from meterwatch.llm import bpe, decontam, pii, simhash, toxicity  # noqa: E402
from meterwatch.llm.common import stored, table  # noqa: E402
from meterwatch.llm.queries import pieces  # noqa: E402


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: fingerprints over 3 words that differ in 2 bits or fewer."""
    return simhash.one_of_each(docs, shingle=3, max_bits=2)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten words in a row of a benchmark item go."""
    return decontam.remove(docs, table(spark, sf_dir, "benchmark"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data become their kind's name; n_chars follows the text."""
    columns = docs.columns
    return pii.redact(docs).selectExpr(*["char_length(text) * 1L AS n_chars" if c == "n_chars" else f"`{c}`" for c in columns])


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """ids of every document, with the digests of its ids and of the decoded bytes."""
    return bpe.digest(docs, pieces(), public_tokenizers.PATTERN, keep=("doc_id", "lang", "source"), with_ids=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("pii", redact),
    ("byte_bpe", tokenize),
]
#: Models and tokenizers have no SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

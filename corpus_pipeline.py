"""Training text from raw documents, stage by stage.

Each stage takes all rows the one before kept and calls one operator; what it decides takes
effect. The stages up to the last keep the columns of ``documents``.

Cases: rows, not ids, go or stay, so repeated and null ids are rows of their own; null texts and
texts without words fail the quality rules; long texts are read whole; further columns of the
documents are kept, whatever their names; empty tables give empty ones.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.llm.bpe_codec import bpe_digest
from starmill.llm.common import cut, read_table, share_library
from starmill.llm.decontamination import without_passages
from starmill.llm.near_copies import without_near_copies
from starmill.llm.perplexity import good_documents
from starmill.llm.pii import redact

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the plain rules or lie outside their language's perplexity band go."""
    share_library(spark)
    return good_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents whose SimHash fingerprints tell a similarity of 0.8 in shingles of
    five words, the one with the least id stays."""
    share_library(spark)
    return without_near_copies(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten words in a row of a benchmark item, or a shorter item, go."""
    return without_passages(docs, read_table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in texts gives way to its kind; ``n_chars`` follows the text."""
    share_library(spark)
    masked = redact(docs)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        masked = masked.withColumn("n_chars", F.char_length("text").cast(kind))
    return masked


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document its number of tokens and digests of the ids and of the text they decode to."""
    share_library(spark)
    return bpe_digest(docs, TOKENIZER)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("encoding", encoding),
]

# The perplexity bands, the spans a field adds and the token ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

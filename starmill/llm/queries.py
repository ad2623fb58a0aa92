"""Registered queries of the operators, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.llm import oracles
from starmill.llm.bpe_codec import bpe_digest
from starmill.llm.common import read_table, share_library
from starmill.llm.decontamination import contamination
from starmill.llm.filter_audit import filter_audit
from starmill.llm.html_text import extract
from starmill.llm.language import identify
from starmill.llm.licenses import license_notices
from starmill.llm.merkle import manifest, shown
from starmill.llm.perplexity import COUNTS, quality
from starmill.llm.pii import KINDS, find_spans
from starmill.llm.repeats import repeat_digests
from starmill.llm.simhash import hexadecimal, near_duplicates
from starmill.llm.token_counts import count_tokens
from starmill.llm.url_rules import judge

PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    share_library(spark)
    return read_table(spark, folder, "documents")


def op1_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = near_duplicates(documents(spark, folder))
    return found.select("doc_id", hexadecimal(F.col("fp")).alias("fingerprint"), "component_id")


def op2_language(spark: SparkSession, folder: str) -> DataFrame:
    return identify(documents(spark, folder), PIECE_BPE)


def op3_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    counted = count_tokens(documents(spark, folder), BYTE_BPE)
    return counted.withColumn("over_limit", F.col("n_tokens") > 1024)


def op4_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality(documents(spark, folder))
    return judged.select("doc_id", *COUNTS, "base_failed", "kept", "perplexity", "low", "high")


def op5_bpe_codec(spark: SparkSession, folder: str) -> DataFrame:
    return bpe_digest(documents(spark, folder), BYTE_BPE)


def op6_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = find_spans(documents(spark, folder))
    plain = F.split("plain", ",")
    number = lambda kind: F.size(F.filter(plain, lambda s: s.startswith(kind + ":")))
    return found.select(
        "doc_id",
        *[number(kind).cast("long").alias(f"n_{kind}") for kind in KINDS],
        F.sha2(F.col("plain").cast("binary"), 256).alias("base_sha256"),
        "spans",
    )


def op7_html_text(spark: SparkSession, folder: str) -> DataFrame:
    share_library(spark)
    texts = extract(read_table(spark, folder, "pages"))
    return texts.withColumn("n_chars", F.char_length("text").cast("long"))


def op8_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = contamination(documents(spark, folder), read_table(spark, folder, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op9_license_scans(spark: SparkSession, folder: str) -> DataFrame:
    found = license_notices(documents(spark, folder))
    best = F.try_element_at("notices", F.lit(1))
    listed = F.transform("notices", lambda n: F.concat_ws(":", n["name"], n["first"], n["end"]))
    return found.select(
        "doc_id",
        "n_words",
        best["name"].alias("license"),
        F.coalesce(best["coverage"], F.lit(0.0)).alias("coverage"),
        F.array_join(listed, ",").alias("notices"),
    )


# The rules the query judges by.
URL_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


def op10_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "verdict string, host string, path string")
    return judge(read_table(spark, folder, "pages"), rules)


def op11_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return filter_audit(documents(spark, folder), read_table(spark, folder, "labels"))


def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    found = manifest(documents(spark, folder))
    digests = ("leaf", "subroot", "root", "folded_root")
    return found.select(
        "doc_id",
        *[shown(F.col(c)).alias(c) for c in digests],
        F.sha2(shown(F.col("proof")).cast("binary"), 256).alias("proof_sha256"),
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def op13_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return repeat_digests(documents(spark, folder))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": op1_simhash,
    "op2_language": op2_language,
    "op3_token_counts": op3_token_counts,
    "op4_quality_rules": op4_quality_rules,
    "op5_bpe_codec": op5_bpe_codec,
    "op6_pii": op6_pii,
    "op7_html_text": op7_html_text,
    "op8_decontamination": op8_decontamination,
    "op9_license_scans": op9_license_scans,
    "op10_url_rules": op10_url_rules,
    "op11_filter_audit": op11_filter_audit,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_suffix_dedup": op13_suffix_dedup,
}

# SQL of the results, where SQL can express them.
ORACLES: dict[str, str] = {
    "op8_decontamination": oracles.DECONTAMINATION,
    "op10_url_rules": oracles.URL_RULES,
    "op11_filter_audit": oracles.FILTER_AUDIT,
    "op12_merkle_manifest": oracles.MERKLE_MANIFEST,
}

"""The named queries of this subpackage, each over its whole tables, and SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from samedays.llm import bpe, decontaminate, licenses, merkle, oracle, pages, pii, quality, secrets, simhash, sketches, substrings, urls, whitening
from samedays.llm.common import read_table


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(read_table(spark, sf_dir, "documents"))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), digests=True)


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash.near_duplicates(read_table(spark, sf_dir, "documents"))
    return rows.select("doc_id", simhash.hex_fingerprint("fp").alias("fingerprint"), "component_id")


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pii.find_pii(read_table(spark, sf_dir, "documents"))
    counts = [pii.count_of("base", kind).alias(f"n_{kind}") for kind in pii.KINDS]
    return rows.select("doc_id", *counts, F.sha2(pii.joined("base"), 256).alias("base_sha256"), pii.joined("spans").alias("spans"))


def op5_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = substrings.remove_repeats(read_table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read_table(spark, sf_dir, "documents"))


def op7_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extract(read_table(spark, sf_dir, "pages"))


def op8_quality_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality.ledger(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        quality.fails("base").alias("base_failed"),
        (~quality.fails("v1")).alias("kept"),
        F.col("failed").alias("failed_bits"),
    )


def op9_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = read_table(spark, sf_dir, "pages").select("page_id", "url")
    labels = read_table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("_labelled"), ((F.col("quality") == 1) & (F.col("toxic") == 0)).cast("int").alias("good")
    )
    outcomes = urls.split_url(listed).join(labels, F.col("page_id") == F.col("_labelled")).select("host", "good")
    judged = urls.judge_urls(listed, outcomes)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.tampered(read_table(spark, sf_dir, "documents"))


def op12_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketches.compare_neighbours(read_table(spark, sf_dir, "documents"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secrets": op1_secrets,
    "op2_bpe": op2_bpe,
    "op3_simhash": op3_simhash,
    "op4_pii": op4_pii,
    "op5_substrings": op5_substrings,
    "op6_licenses": op6_licenses,
    "op7_pages": op7_pages,
    "op8_quality_ledger": op8_quality_ledger,
    "op9_url_reputation": op9_url_reputation,
    "op10_decontaminate": op10_decontaminate,
    "op11_merkle": op11_merkle,
    "op12_sketches": op12_sketches,
    "op13_whitening": op13_whitening,
}

#: The others hash, learn or parse beyond SQL; tests hold them against brute force.
ORACLE_SQL: dict[str, str] = {
    "op8_quality_ledger": oracle.QUALITY,
    "op9_url_reputation": oracle.REPUTATION,
}

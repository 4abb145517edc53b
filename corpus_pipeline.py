"""A training-corpus pipeline over `documents`: quality, near-duplicates, decontamination, secrets, tokens.

Each stage takes what its predecessor kept, as the columns of `documents`, and applies one operator of `samedays.llm`.
Between stages the rows are written as Parquet in the shared folder and read again, so that a lost executor costs at
most one stage's tasks.

Near-duplicates keep the row with the least doc_id of a group (null last); among rows that share it, any one, chosen by
a hash of the whole row.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from samedays.llm import bpe, decontaminate, quality, secrets, simhash
from samedays.llm.common import Scratch, read_table

POLICY = "v1"


def _plain(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The rows with names that no operator uses, and those names by the columns' own."""
    names = {name: f"column_{i}" for i, name in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def _named(docs: DataFrame, names: dict[str, str]) -> DataFrame:
    return docs.select(*[F.col(plain).alias(name) for name, plain in names.items()])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the policy keeps."""
    plain, names = _plain(docs)
    return _named(quality.apply_policy(quality.ledger(plain, names["text"]), POLICY), names)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the least doc_id, null last."""
    plain, names = _plain(docs)
    # 96 bits of hashes of the whole row; rows that share them are the same in every column
    key = {"row_key": F.xxhash64(*plain.columns), "row_check": F.hash(*plain.columns)}
    keyed = plain.withColumns(key)
    carried = keyed.select(F.col(names["doc_id"]).alias("doc_id"), F.col(names["text"]).alias("text"), *key)
    groups = simhash.near_duplicates(carried, carry=list(key))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", *key)).alias("first")
    heads = groups.groupBy("root").agg(first).select("first.row_key", "first.row_check")
    # one row of those that are the same stays
    return _named(keyed.join(heads, list(key), "left_semi").dropDuplicates(list(key)), names)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.clean(docs, read_table(spark, sf_dir, "benchmark")).select(*docs.columns)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their secrets replaced and n_chars counted anew."""
    hidden = secrets.redact(docs)
    return hidden.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and digests of the ids and of the decoded text."""
    return bpe.encode(docs, public_tokenizers.path("word_bpe_49k.json"), digests=True)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("tokens", tokens),
]

#: Fingerprints, trained models and the tokenizer are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    rows = read_table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        rows = scratch.keep(stage(spark, rows, sf_dir))
        if number:
            # its rows are in the table of this stage now
            scratch.drop(number)
    return rows

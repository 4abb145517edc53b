"""Queries of the subpackage: against SQL where there is one, and the pipeline against its operators' brute force."""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from pathlib import Path

import duckdb
import pandas as pd
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from samedays.llm.queries import ORACLE_SQL, QUERIES

SF_DIR = "/root/testdata/sf0.001"
TABLES = ("documents", "pages", "labels", "benchmark")
pytestmark = pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="needs the given tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def normalized(frame: pd.DataFrame) -> list[str]:
    frame = frame[sorted(frame.columns)]
    plain = [[None if pd.isna(v) else v.item() if hasattr(v, "item") else v for v in row] for row in frame.to_numpy(object)]
    return sorted(map(repr, plain))


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, duck, name):
    got, expected = QUERIES[name](spark, SF_DIR).toPandas(), duck.sql(ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(expected.columns)
    assert len(got) == len(expected) > 0
    assert normalized(got) == normalized(expected)


def test_one_query_for_each_operator():
    assert [int(name.split("_")[0][2:]) for name in QUERIES] == list(range(1, 14))


def kept_by_quality(documents: list[dict]) -> list[dict]:
    def kept(text):
        found = re.findall(r"[^\x20\x09-\x0D]+", text)
        windows = [tuple(found[i : i + 3]) for i in range(len(found) - 2)]
        counts = Counter(windows)
        covered = len({i + k for i, g in enumerate(windows) if counts[g] > 1 for k in range(3)})
        lines = [line for line in text.split("\n") if line.strip(" \t\n\x0b\f\r")]
        letters, n = sum(map(len, found)), len(found)
        return not (
            n < 50
            or 100 * covered > 50 * n
            or 10 * len(re.findall(r"[#*$%&|<>]", text)) > 3 * n
            or 100 * (len(lines) - len(set(lines))) > 30 * len(lines)
            or not 2 * n <= letters <= 20 * n
            or 2 * len(re.findall("[A-Z]", text)) > letters
        )

    return [d for d in documents if kept(d["text"] or "")]


def test_pipeline(spark, duck):
    """Every stage by brute force on the smallest tables."""
    from test_operators import brute_components, brute_fingerprint
    from tokenizers import Tokenizer

    rows = kept_by_quality(duck.sql("FROM documents").df().to_dict("records"))
    ids, prints = [d["doc_id"] for d in rows], [brute_fingerprint(d["text"]) for d in rows]
    heads = set(brute_components(ids, prints, 4))
    rows = [d for d in rows if d["doc_id"] in heads]
    items = [t for (t,) in duck.sql("SELECT text FROM benchmark").fetchall()]
    rows = [d for d in rows if not any(t in d["text"] for t in items)]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = set()
    for d in rows:
        text = re.sub(r'(token = ")[0-9a-f]{40}(?=")', r"\1[SECRET]", d["text"])
        found = tokenizer.encode(text, add_special_tokens=False).ids
        packed = b"".join(n.to_bytes(4, "little") for n in found)
        decoded = tokenizer.decode(found, skip_special_tokens=False)
        expected.add((d["doc_id"], len(found), hashlib.sha256(packed).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    assert {tuple(r) for r in corpus_pipeline.run(spark, SF_DIR).collect()} == expected


def test_pipeline_stages_on_awkward_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, _key string, root string"
    text = " ".join(f"w{i} x{i}" for i in range(60))
    secret = text.replace("w5 ", 'token = "0cf1bbc67ab39b2ddebadc809bed189ed8c6ac4d" ')
    rows = [(1, text), (1, text), (2, text), (None, text), (None, None), (3, ""), (4, " ".join(reversed(text.split()))), (5, secret)]
    frame = spark.createDataFrame([(i, t, "en", "s", len(t or ""), "k", "r") for i, t in rows], schema)
    docs = frame.drop("_key", "root")
    kept = corpus_pipeline.quality_rules(spark, docs, SF_DIR)
    assert Counter(r.doc_id for r in kept.collect()) == {1: 2, 2: 1, None: 1, 4: 1, 5: 1}
    heads = corpus_pipeline.near_duplicates(spark, kept, SF_DIR).collect()
    assert Counter(r.doc_id for r in heads)[1] == 1 and {1, 4} <= {r.doc_id for r in heads} and None not in {r.doc_id for r in heads}
    nulls = corpus_pipeline.near_duplicates(spark, docs.filter("doc_id IS NULL"), SF_DIR).collect()
    assert Counter(r.text for r in nulls) == {text: 1, None: 1}
    hidden = {r.doc_id: r for r in corpus_pipeline.secret_scan(spark, docs.filter("doc_id > 2"), SF_DIR).collect()}
    assert "0cf1" not in hidden[5].text and 'token = "[SECRET]"' in hidden[5].text and hidden[5].n_chars == len(hidden[5].text)
    assert hidden[3].text == ""
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, docs.limit(0), SF_DIR)
        assert empty.count() == 0
        if stage is not corpus_pipeline.tokens:
            assert empty.columns == docs.columns


def test_stages_keep_columns_of_any_name(spark):
    """The columns of `documents` beside others that bear names of the operators' own."""
    plain = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(60)
    names = ("_key", "row_key", "failed", "n_words", "fp", "root", "column_0", "_secrets", "row")
    docs = plain.select("*", *[F.concat(F.lit(f"{name} "), F.col("doc_id").cast("string")).alias(name) for name in names])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, SF_DIR)
        assert kept.columns == docs.columns, name
        for row in kept.collect():
            assert all(row[n] == f"{n} {row.doc_id}" for n in names), name

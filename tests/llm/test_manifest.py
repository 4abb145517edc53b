"""The Merkle manifest against a plain build of the same trees."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from samedays.llm import merkle
from samedays.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row: dict) -> str:
    fields = [row[name] for name in ("doc_id", "source", "lang", "n_chars", "text")]
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields])


def levels_of(nodes: list[str]) -> list[list[str]]:
    made = [nodes]
    while len(made[-1]) > 1:
        made.append([digest(*made[-1][i : i + 8]) for i in range(0, len(made[-1]), 8)])
    return made


def path(levels: list[list[str]], at: int) -> list[tuple[list[str], list[str]]]:
    found = []
    for level in levels[:-1]:
        first = at // 8 * 8
        found.append((level[first:at], level[at + 1 : first + 8]))
        at //= 8
    return found


def brute_manifest(rows: list[dict]) -> list[tuple]:
    trees = defaultdict(list)
    for row in rows:
        trees[row["lang"]].append(row)
    names = sorted(trees, key=lambda lang: (lang is not None, (lang or "").encode()))
    for name in names:
        trees[name].sort(key=lambda row: (row["doc_id"] is not None, row["doc_id"] or 0, leaf(row)))
    built = {name: levels_of([leaf(row) for row in trees[name]]) for name in names}
    top = levels_of([built[name][-1][0] for name in names])
    out = []
    for number, name in enumerate(names):
        for at, row in enumerate(trees[name]):
            proof = path(built[name], at) + path(top, number)
            changed = row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 3 == 0 and row["text"] is not None
            text = "".join(c.lower() if "A" <= c <= "Z" else c for c in row["text"]) if changed else row["text"]
            folded = leaf(row | {"text": text})
            for left, right in proof:
                folded = digest(*left, folded, *right)
            siblings = digest(*[d for left, right in proof for d in left + right])
            root = top[-1][0]
            out.append((row["doc_id"], leaf(row), built[name][-1][0], root, siblings, folded, folded == root))
    return out


def made_rows(sizes: dict[str | None, int]) -> list[dict]:
    rng = random.Random(5)
    rows = []
    for lang, size in sizes.items():
        for _ in range(size):
            text = "".join(rng.choice("aB \né\U0001f600") for _ in range(rng.randrange(30)))
            rows.append({"doc_id": rng.randrange(10**12), "text": text, "lang": lang, "source": "s", "n_chars": len(text)})
    return rows


def got(spark, rows: list[dict], stride: int = merkle.STRIDE) -> list[tuple]:
    frame = spark.createDataFrame([tuple(r[c] for c in ("doc_id", "text", "lang", "source", "n_chars")) for r in rows], SCHEMA)
    made = merkle.manifest(frame, merkle.lower_ascii(F.col("text")), merkle.is_tampered(), stride)
    return [tuple(r) for r in made.collect()]


def in_order(rows: list[tuple]) -> list[tuple]:
    return sorted(rows, key=repr)


@pytest.mark.parametrize("stride", [1, 2, 3])
def test_trees_of_all_heights(spark, stride):
    rows = made_rows({"en": 600, "de": 1, "fr": 8, "es": 9, "it": 64, "pt": 65, None: 3, "": 2, "\U0001f600": 2, "～": 2})
    made = got(spark, rows, stride)
    assert in_order(made) == in_order(brute_manifest(rows))
    assert {r[6] for r in made} == {True, False}


def test_one_tree_and_one_leaf(spark):
    for sizes in ({"en": 70}, {"en": 1}, {None: 1}):
        rows = made_rows(sizes)
        assert in_order(got(spark, rows)) == in_order(brute_manifest(rows))


def test_nulls_ties_and_repeated_rows(spark):
    rows = made_rows({"en": 20, None: 4})
    rows += rows[:5] * 30
    rows += [{"doc_id": None, "text": t, "lang": lang, "source": None, "n_chars": None} for t in (None, "", "A") for lang in ("en", None)]
    rows += [rows[0] | {"text": "other"}, rows[1] | {"text": "word " * 200_000}, {"doc_id": 2**62 + 1, "text": "Z", "lang": "en", "source": "", "n_chars": 0}]
    assert in_order(got(spark, rows)) == in_order(brute_manifest(rows))


def test_empty_table_and_other_columns(spark):
    assert got(spark, []) == []
    names = ["tree", "place", "digest", "leaf", "root", "_row", "_range", "copy", "block"]
    rows = made_rows({"en": 20, "de": 3})
    frame = spark.createDataFrame([tuple(r[c] for c in ("doc_id", "text", "lang", "source", "n_chars")) for r in rows], SCHEMA)
    wide = frame.select("*", *[F.lit(i).alias(name) for i, name in enumerate(names)])
    assert in_order([tuple(r) for r in merkle.tampered(wide).collect()]) == in_order(brute_manifest(rows))


@pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="needs the given tables")
def test_query(spark):
    rows = [r.asDict() for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    assert in_order([tuple(r) for r in QUERIES["op11_merkle"](spark, SF_DIR).collect()]) == in_order(brute_manifest(rows))

"""Fingerprints of documents against sets of paragraphs, and sketches that are too small at first."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from samedays.llm import sketches
from samedays.llm.common import Scratch
from samedays.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def paragraphs(text: str) -> Counter:
    pieces = re.split(r"(?<=[.!?])[\x20\x09-\x0D]+|\n", text)
    return Counter(piece for piece in pieces if piece)


def likeness(left: str, right: str) -> tuple[float, int, int]:
    a, b = paragraphs(left), paragraphs(right)
    both = a.total() + b.total()
    common = (a & b).total()
    return 2 * common / both if both else 1.0, a.total() - common, b.total() - common


def brute(texts: list[str]) -> list[tuple]:
    """Expected results of texts in the order of their ids."""
    out = []
    for i, text in enumerate(texts):
        following = texts[(i + 1) % len(texts)]
        cut = len(text) // 4
        edited = text[: len(text) - cut] + following[:cut]
        near_edited, near_next = likeness(text, edited), likeness(text, following)
        out.append((len(text), hashlib.sha256(edited.encode()).hexdigest(), near_edited[0], near_next[0], *near_edited[1:], *near_next[1:]))
    return out


COLUMNS = ("n_chars", "edited_sha256", "near_edited", "near_next", "edited_removed", "edited_added", "next_removed", "next_added")


def compared(spark, rows: list[tuple]) -> list:
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    return sketches.compare_neighbours(frame).collect()


def made_texts(seed: int, many: int, pieces: int) -> list[str]:
    rng = random.Random(seed)
    pool = ["".join(rng.choice("abcé \U0001f600") for _ in range(rng.randrange(1, 25))) for _ in range(pieces * 2)]
    ends = [". ", "! ", "?\n", "\n", ".", "\n\n", " "]
    return ["".join(rng.choice(pool) + rng.choice(ends) for _ in range(rng.randrange(pieces))) for _ in range(many)]


@pytest.mark.parametrize("pieces", [3, 40, 400])
def test_against_sets_of_paragraphs(spark, pieces):
    texts = made_texts(pieces, 40, pieces)
    texts[5:8] = ["", texts[4], texts[4]]
    made = sorted(compared(spark, list(enumerate(texts))), key=lambda r: r.doc_id)
    assert [r.doc_id for r in made] == list(range(len(texts)))
    assert [tuple(r[c] for c in COLUMNS) for r in made] == brute(texts)
    same = {}
    for r, text in zip(made, texts, strict=True):
        assert same.setdefault(text, r.fingerprint) == r.fingerprint
        assert (r.fingerprint == r.edited_fingerprint) or r.near_edited < 1
    assert len(set(same.values())) == len({tuple(sorted(paragraphs(t).items())) for t in texts})


def test_nulls_repeated_rows_and_one_row(spark):
    texts = ["One. Two. Three. Four!", "One. Two.\nOther."]
    rows = [(None, None), (None, texts[0]), *[(3, texts[0])] * 4, (3, texts[1]), (9, "x. " * 5000), (10, None)]
    made = compared(spark, rows)
    assert Counter(r.doc_id for r in made) == Counter(doc_id for doc_id, _ in rows)
    assert sum(r.near_next == 1 and r.next_removed == 0 for r in made if r.doc_id == 3) >= 3
    empty = [r for r in made if r.n_chars == 0]
    assert len(empty) == 2 and all(r.fingerprint == "" and r.near_edited == 1 for r in empty)
    (alone,) = compared(spark, [(7, texts[0])])
    assert tuple(alone[c] for c in COLUMNS) == brute([texts[0]])[0] and alone.near_next == 1
    assert compared(spark, []) == []


def test_long_text_and_other_columns(spark):
    texts = [" ".join(f"w{i} and {i % 7}." for i in range(12_000)), "w1 and 1. " * 6_000, "short"]
    names = ["key", "check", "own", "need", "place", "a", "b", "c", "part", "found", "copy", "edited"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").select("*", *[F.lit(1).alias(n) for n in names])
    made = sorted(sketches.compare_neighbours(frame).collect(), key=lambda r: r.doc_id)
    assert [tuple(r[c] for c in COLUMNS) for r in made] == brute(texts)


def test_small_sketches_fail_and_larger_ones_recover(spark):
    """Parts far above their size, so that the first tries leave cells over."""
    rng = random.Random(3)
    rows = []
    for pair in range(30):
        left, right = ({rng.getrandbits(63) for _ in range(rng.randrange(1, 200))} for _ in "ab")
        common = [rng.getrandbits(63) for _ in range(50)]
        members = [(d, sign) for side, sign in ((left, 1), (right, -1)) for d in [*side, *common]]
        rows.append((pair, members, sorted([(d, 1) for d in left] + [(d, -1) for d in right])))
    plain = spark.createDataFrame([r[:2] for r in rows], "pair int, plain array<struct<digest:bigint,sign:int>>")
    frame = plain.selectExpr("pair", f"transform(plain, m -> struct(m.digest AS digest, m.sign AS sign, {sketches._mark('m.digest')} AS mark)) AS members")
    first = frame.select(F.expr(sketches._let("s", sketches.sketch("members"), f"size({sketches.peeled('s')}.cells)")).alias("left_over"))
    assert max(r.left_over for r in first.collect()) > 0
    found = {r.pair: sorted(map(tuple, r.found)) for r in frame.select("pair", F.expr(sketches.recovered("members")).alias("found")).collect()}
    assert found == {pair: wanted for pair, _, wanted in rows}


def test_pairs_that_the_first_try_does_not_list_whole(spark, monkeypatch):
    """Little room at first and tiny parts' sketches: most pairs are peeled, most parts more than once; the results are the same."""
    monkeypatch.setattr(sketches, "ROOM", 1)
    monkeypatch.setattr(sketches, "THIRD", 2)
    texts = made_texts(1, 40, 12)
    made = sorted(compared(spark, list(enumerate(texts))), key=lambda r: r.doc_id)
    assert [tuple(r[c] for c in COLUMNS) for r in made] == brute(texts)


def test_no_python_and_one_shuffle_of_texts(spark):
    frame = spark.createDataFrame([(i, "a. b.") for i in range(5)], "doc_id long, text string")
    texts = frame.withColumns({"key": F.xxhash64("doc_id", "text"), "check": F.hash("text", "doc_id")})
    requests = sketches._neighbours(texts, Scratch(spark, "plan"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plans = []
        for compared in (sketches._first_try, sketches._peeled):
            made = compared(texts.select("key", "check", "text").repartition(7, "key", "check").dropDuplicates(["key", "check"]), requests)
            made.collect()
            plans.append(made._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for plan in plans:
        assert "Python" not in plan and "MapInPandas" not in plan and "Arrow" not in plan
        # cells and parts are grouped where the documents lie
        assert not re.search(r"Exchange hashpartitioning\([^)]*(kind|part|cell|item)#", plan) and "ReusedExchange" in plan


@pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="needs the given tables")
def test_query(spark):
    rows = sorted((r.doc_id, r.text or "") for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect())
    made = sorted(QUERIES["op12_sketches"](spark, SF_DIR).collect(), key=lambda r: r.doc_id)
    assert [tuple(r[c] for c in COLUMNS) for r in made] == brute([text for _, text in rows])

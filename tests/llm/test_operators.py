"""Operators for training data against brute force, on texts with every awkward case."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from samedays.llm import bpe, decontaminate, licenses, pii, quality, simhash, substrings

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, lang string, fp string, row string, `key` string, spans string, failed string"


def corpus(seed: int = 1, n: int = 60) -> list[tuple[int | None, str | None]]:
    """Texts with copies, near copies, shared passages, odd white space, and the awkward cases."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdeéñß") for _ in range(rng.randint(1, 7))) for _ in range(300)]
    passage = " ".join(rng.choice(vocabulary) for _ in range(45))

    def text(k):
        return " ".join(rng.choice(vocabulary) for _ in range(k))

    rows: list[tuple[int | None, str | None]] = []
    for i in range(n):
        kind = i % 6
        if kind == 0:
            rows.append((i, text(rng.randint(1, 120)) + ". Done!"))
        elif kind == 1:
            rows.append((i, text(30) + "\n" + passage + " \t" + text(20)))
        elif kind == 2 and rows:
            rows.append((i, rows[rng.randrange(len(rows))][1]))
        elif kind == 3:
            found = (rows[rng.randrange(len(rows))][1] or "").split(" ")
            found[rng.randrange(len(found))] = "changed"
            rows.append((i, " ".join(found)))
        elif kind == 4:
            rows.append((i, "\n".join([text(6)] * rng.randint(2, 9))))
        else:
            rows.append((i, passage[: rng.randint(10, 200)].upper() + "\x0b" + text(rng.randint(0, 50))))
    rows += [(n, None), (None, None), (None, text(25)), (n + 1, ""), (n + 2, " \t\n\x0b\f\r "), (n + 3, "a " * 200), (n + 4, "a")]
    rows += [(n + 5, passage), (n + 5, passage), (n + 5, passage + " tail"), (n + 6, "x y  z\u0085w <|endoftext|> 'S it's ŁÓDŹ ﬁ ß İ")]
    rows += [(n + 7, text(9000)), (n + 8, "<|startoftext|>" * 3), (n + 9, "é ́e ퟿ 漢字 \U0001f600!!")]
    return rows


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def documents(spark, rows):
    return spark.createDataFrame([(i, t, "en", "f", "r", "k", "s", "x") for i, t in rows], SCHEMA)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def bag(found) -> Counter:
    return Counter(tuple(r) for r in found.collect())


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def test_bpe_equals_the_tokenizer(documents, rows, nothing):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(TOKENIZER)
    expected = Counter()
    for i, t in rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids
        packed = b"".join(n.to_bytes(4, "little") for n in ids)
        expected[i, len(ids), hashlib.sha256(packed).hexdigest(), sha(tokenizer.decode(ids, skip_special_tokens=False))] += 1
    for frequent in (0, 50, 200_000):  # all words by join, some, none
        assert bag(bpe.encode(documents, TOKENIZER, frequent=frequent, digests=True)) == expected
    assert bpe.encode(nothing, TOKENIZER, digests=True).count() == 0


def test_bpe_words_without_ids(spark):
    """White space beyond ASCII alone is a word here, and has no ids; it leaves no blank behind."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(TOKENIZER)
    signs = ["\u00a0", "\u2003", "\u2028", "\u3000", "\u0085"]
    texts = [*(f"a {s} b" for s in signs), " ".join(signs), f"\u00a0 start", "end \u3000", f"one{signs[0]}word {signs[1]}{signs[2]} x"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for frequent in (0, 100):
        made = {r.doc_id: r for r in bpe.encode(frame, TOKENIZER, frequent=frequent).collect()}
        for i, text in enumerate(texts):
            ids = tokenizer.encode(text, add_special_tokens=False).ids
            assert made[i].n_tokens == len(ids) and made[i].ids == b"".join(n.to_bytes(4, "little") for n in ids)
            assert made[i].decoded == tokenizer.decode(ids, skip_special_tokens=False)


def test_bpe_repeated_rows_ask_once(spark):
    """A text that stands there 2,000 times takes little more than as many texts with ids of their own."""
    from time import perf_counter

    text = " ".join(f"w{i}x{i * 7}" for i in range(300))

    def seconds(rows):
        started = perf_counter()
        made = bpe.encode(spark.createDataFrame(rows, "doc_id long, text string"), TOKENIZER, frequent=0, digests=True).collect()
        assert len(made) == len(rows) and len({r.ids_sha256 for r in made}) == 1
        return perf_counter() - started

    own = seconds([(i, text) for i in range(2000)])
    assert seconds([(None, text)] * 1000 + [(7, text)] * 1000) < 2 * own + 3


def test_bpe_answers_travel_as_plain_rows(spark):
    """Answers cross their exchange as (key, answer), before any list of them is made, and a key is 8 bytes."""
    frame = spark.createDataFrame([(i, f"rare{i} word{i % 7}") for i in range(50)], "doc_id long, text string")
    plan = bpe.encode(frame, TOKENIZER, frequent=1, digests=True)._jdf.queryExecution().executedPlan().toString()
    partial = plan.index("partial_collect_list(answer")
    assert "Exchange" in plan[partial:].split("MapInPandas")[0] and "check#" not in plan


def test_bpe_texts_that_share_a_key_get_another(spark):
    rows = [(i, f"text {i % 30}") for i in range(60)] + [(1, None), (None, "text 1")]
    source = spark.createDataFrame(rows, "doc_id long, text string").fillna("", ["text"])
    made = bpe.keyed_texts(source, lambda seed: F.xxhash64("doc_id", "text") % (5 if seed < 2 else 1 << 40))
    assert made.select("key", "text").distinct().groupBy("key").count().where("count > 1").isEmpty()
    assert made.count() == len(rows) and made.groupBy("key").count().count() > 5


def test_bpe_long_words_that_are_frequent_do_not_meet(spark):
    rule = "-" * 80
    rows = [(i, f"{rule} word{i} {rule} {'=' * 70_000 if i < 2 else ''}") for i in range(60)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    known = dict(bpe.frequent_words(frame, TOKENIZER, "text", 1000))
    assert rule in known and "=" * 70_000 not in known
    made = bpe.decode(bpe.encode(frame, TOKENIZER).select("doc_id", "ids", F.col("decoded").alias("want")), TOKENIZER)
    assert made.filter("want != decoded").count() == 0 and made.count() == 60


def test_bpe_round_trip(documents):
    made = bpe.encode(documents, TOKENIZER)
    again = bpe.decode(made.select("doc_id", "ids", F.col("decoded").alias("want")), TOKENIZER)
    assert again.filter("want != decoded").count() == 0


def brute_fingerprint(text: str | None) -> int:
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    found = WORD.findall(lowered)
    if not found:
        return 0
    shingles = [" ".join(found[i : i + 4]) for i in range(max(len(found) - 3, 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids: list, prints: list[int], radius: int) -> list:
    parent = list(range(len(ids)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                parent[root(i)] = root(j)
    least: dict[int, int] = {}
    for i, doc_id in enumerate(ids):
        if doc_id is not None:
            least[root(i)] = min(least.get(root(i), doc_id), doc_id)
    return [least.get(root(i)) for i in range(len(ids))]


@pytest.mark.parametrize("radius, max_shard", [(4, 2048), (4, 1), (12, 3)])
def test_simhash(documents, rows, nothing, radius, max_shard):
    prints = [brute_fingerprint(t) for _, t in rows]
    ids = [i for i, _ in rows]
    expected = Counter(zip(ids, [f"{p:016x}" for p in prints], brute_components(ids, prints, radius), strict=True))
    made = simhash.near_duplicates(documents, radius=radius, max_shard=max_shard)
    assert bag(made.select("doc_id", simhash.hex_fingerprint("fp"), "component_id")) == expected
    assert simhash.near_duplicates(nothing).count() == 0


def test_simhash_links_of_random_fingerprints():
    import numpy as np

    rng = np.random.default_rng(3)
    centre = rng.integers(0, 1 << 63, 6, dtype=np.uint64)
    near = centre[rng.integers(0, 6, 300)] ^ (np.uint64(1) << rng.integers(0, 64, 300, dtype=np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 300, dtype=np.uint64))
    fps = np.unique(np.concatenate([near, rng.integers(0, 1 << 63, 200, dtype=np.uint64)])).view(np.int64)
    a, b = simhash.shard_links(np.zeros(len(fps), np.int64), fps)
    found = brute_components(fps.tolist(), [int(x) & (1 << 64) - 1 for x in fps], 4)
    linked = dict(zip(a.tolist(), b.tolist(), strict=True))
    assert [linked.get(x, x) for x in fps.tolist()] == found


def brute_removed(documents, window: int = 20) -> Counter:
    """Rows of one id are in the order of a hash of id and text; equal rows are the same document."""
    known = F.coalesce("doc_id", F.lit(substrings.NO_ID))
    hashed = documents.select("doc_id", "text", known.alias("at"), F.xxhash64(known, F.coalesce("text", F.lit(""))).alias("row")).collect()
    split = [WORD.findall(r.text or "") for r in hashed]
    first: dict[tuple, tuple] = {}
    for r, found in zip(hashed, split, strict=True):
        for p in range(len(found) - window + 1):
            run, place = tuple(found[p : p + window]), (r.at, r.row, p)
            first[run] = min(first.get(run, place), place)
    out = Counter()
    for r, found in zip(hashed, split, strict=True):
        gone = set()
        for p in range(len(found) - window + 1):
            if first[tuple(found[p : p + window])] < (r.at, r.row, p):
                gone.update(range(p, p + window))
        out[r.doc_id, len(found), len(gone), " ".join(w for p, w in enumerate(found) if p not in gone)] += 1
    return out


@pytest.mark.parametrize("hot", [1000, 1])
def test_substrings(documents, nothing, monkeypatch, hot):
    monkeypatch.setattr(substrings, "HOT", hot)
    assert bag(substrings.remove_repeats(documents)) == brute_removed(documents)
    assert substrings.remove_repeats(nothing).count() == 0


def test_substrings_few_words(spark):
    """Texts over three words, so that windows, anchors and contexts repeat in every way."""
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice("xy") + ("z" if rng.random() < 0.02 else "") for _ in range(rng.randint(15, 300)))) for i in range(25)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert bag(substrings.remove_repeats(frame)) == brute_removed(frame)


def test_suffix_automaton_statistics():
    rng = random.Random(7)
    texts = [[rng.choice("ab") for _ in range(rng.randint(1, 30))] for _ in range(12)]
    automaton = substrings.SuffixAutomaton()
    for k, text in enumerate(texts):
        runs = {tuple(t[i:j]) for t in texts[:k] for i in range(len(t)) for j in range(i + 1, len(t) + 1)}
        want = [max((n for n in range(1, e + 2) if tuple(text[e + 1 - n : e + 1]) in runs), default=0) for e in range(len(text))]
        assert automaton.statistics(text) == want
        automaton.add(text)


def brute_pii(text: str | None) -> list[tuple[int, int, int]]:
    text, out = text or "", []
    for kind, pattern in enumerate((pii.EMAIL, pii.IP, pii.CARD, pii.PHONE)):
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m.group())
            doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
            passes = (
                True,
                kind == 1 and all(int(p) <= 255 for p in m.group().split(".")),
                14 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in doubled) % 10 == 0,
                10 <= len(digits) <= 15,
            )[kind]
            if passes:
                out.append((m.start(), kind, m.end()))
    return sorted(out)


PII_TEXTS = [
    "mail a.b@c.de, x@y and ö@z.org; a@b.c_d@e.f",
    "1.2.3.4 256.1.1.1 00001.2.3.0255 1.2.3.4.5.6.7.8 9.9.9",
    "4111 1111 1111 1111 and 4111-1111-1111-1112 or 4111111111111111 5500 0000 0000 0004 1",
    "+1 (017) 555-7713 +49.30.1234567x +12 + 1 +1234567890123456",
    "phone: 555-010-7777, e-mail carla(at)example.org",
    "",
    "digits " + "9" * 6000 + " end",
]


def test_pii(spark):
    rows = [*enumerate(PII_TEXTS), (None, None), (0, PII_TEXTS[0])]
    made = pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(made) == len(rows)
    for row in made:
        text = PII_TEXTS[row.doc_id] if row.doc_id is not None else None
        base = [(s.start, pii.KINDS.index(s.kind), s.end) for s in row.base]
        spans = [(s.start, pii.KINDS.index(s.kind), s.end) for s in row.spans]
        assert base == brute_pii(text)
        assert spans == sorted(spans) and set(base) <= set(spans)
        if row.doc_id == 4:
            assert {(text[s:e], pii.KINDS[k]) for s, k, e in spans} == {("555-010-7777", "phone"), ("carla(at)example.org", "email")}


def test_pii_patterns_are_linear_and_the_same():
    """Long runs that never become a match, and random texts of the patterns' own characters."""
    from time import perf_counter

    for run in ("a" * 1_000_000 + " @", "1" * 1_000_000 + " .", "1." * 300_000, "a@" * 300_000, "%" * 500_000 + "@", "1" * 500_000 + ".1.1", "+" + "1 " * 400_000):
        started = perf_counter()
        pii.base_spans(run)
        assert perf_counter() - started < 1, run[:5]
    rng = random.Random(8)
    for signs in ("a.@-_", "12.", "1.2@a", "a@b.c_d@e.f +(1) 9"):
        for _ in range(3000):
            text = "".join(rng.choice(signs) for _ in range(rng.randrange(24)))
            assert pii.base_spans(text) == brute_pii(text), text


def test_pii_words_of_the_labelled_table_are_the_decoders(spark):
    for (words, labels), line in zip(pii._labelled_lines(), pii.LABELLED.strip().splitlines(), strict=True):
        plain = re.sub(r"\[(email|ip|card|phone) ((?:\[at\]|[^\]])*)\]", r"\2", line)
        assert words == pii._TOKEN.findall(plain) and any(labels) == (plain != line)
    frame = spark.createDataFrame([(1, "call 555-010-2299 , please", 5)], "doc_id long, text string, spans int").withColumn("base", F.lit(1))
    assert pii.find_pii(frame.limit(0)).count() == 0 and len(pii.find_pii(frame).first().spans) == 1


def test_pii_field_on_held_out_lines():
    field = pii.train()
    held_out = {
        "Call 555-010-2299 before noon .": "555-010-2299",
        "Tel: (555) 010-7711": "(555) 010-7711",
        "email frank(at)example.com please": "frank(at)example.com",
        "It cost 1,499.00 in 2021 , that is 3 more .": None,
        "Chapter 14 , pages 12-19 .": None,
    }
    right = 0
    for line, want in held_out.items():
        spans = pii.added_spans([(0, line)], field)[0]
        right += [line[s:e] for s, _, e in spans] == ([want] if want else [])
    assert right >= 4


def test_pii_leaves_out_no_line_with_a_label(spark):
    field = pii.train()
    kept = pii.Filter(field)
    rng = random.Random(2)
    labelled = [" ".join(words) for words, _ in pii._labelled_lines()]
    pieces = sorted({w for line in labelled for w in line.split()} | {"bob(AT)example.org", "[AT]", "At", "x", "…", "é"})
    lines = [*labelled, *(" ".join(rng.choice(pieces) for _ in range(rng.randint(0, 9))) for _ in range(3000)), "", " \t "]
    passed = dict(kept.suspects(lines))
    every = pii.added_spans([(0, line) for line in lines], field)
    assert {i for i, spans in enumerate(every) if spans} <= set(passed)
    assert {i for i, (_, labels) in enumerate(pii._labelled_lines()) if any(labels)} <= set(passed)
    some = sorted(passed)
    assert pii.added_spans([(0, lines[i]) for i in some], field, [passed[i] for i in some]) == [every[i] for i in some]
    texts = ["Write to anna.smith at example.com for details .", "Mail: bob(AT)example.org please ."]
    made = pii.find_pii(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {texts[r.doc_id][s.start : s.end] for r in made for s in r.spans} == {"anna.smith at example.com", "bob(AT)example.org"}


@pytest.mark.parametrize("bound", ["WORDS", "SETS"])
def test_pii_filter_forgets_words_with_their_numbers(monkeypatch, bound):
    """Words read after others were let go of have the same emissions, however few are kept."""
    field = pii.train()
    rng = random.Random(5)
    pieces = sorted({w for words, _ in pii._labelled_lines() for w in words} | {"(1)", "..."})
    # a word too long to be kept, of a shape of its own, on every line
    long = lambda: "".join(rng.choice("aA9_") for _ in range(300))
    batches = [[" ".join([long(), *(rng.choice(pieces) for _ in range(rng.randint(0, 8)))]) for _ in range(20)] for _ in range(30)]
    want = [dict(pii.Filter(field).suspects(lines)) for lines in batches]
    monkeypatch.setattr(pii.Filter, bound, 5, raising=False)
    kept = pii.Filter(field)
    for lines, passed in zip(batches, want, strict=True):
        got = dict(kept.suspects(lines))
        assert {i: scores.tolist() for i, scores in got.items()} == {i: scores.tolist() for i, scores in passed.items()}
        # at most the bound before a batch, and its words
        assert len(kept if bound == "WORDS" else kept.kinds) <= 5 + 20 * 9 + 1


def test_viterbi_equals_all_paths():
    from itertools import product

    import numpy as np

    rng = np.random.default_rng(4)
    field = pii.Field({}, np.zeros((0, 5)), rng.normal(size=(5, 5)))
    lines = [rng.normal(size=(n, 5)) for n in (3, 1, 4, 0, 2)]
    for emissions, labels in zip(lines, field.viterbi(lines), strict=True):
        n = len(emissions)
        score = lambda p, e=emissions: sum(e[i, x] for i, x in enumerate(p)) + sum(field.moves[a, b] for a, b in zip(p, p[1:], strict=False))
        assert tuple(labels) == max(product(range(5), repeat=n), key=score)


LICENCE_TEXTS = [
    "Released under the MIT License.",
    "mit license MIT  LICENSE mit-license; apache license, version 2.0. General public license",
    "Licensed under the Apache License, Version 2.0.",
    "license mit no licence here",
    "é mit license MIT_License the mit licenses",
    "",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the Software), to deal in the Software without restriction, including without limitation",
]


def test_licenses(spark):
    filler = [(100 + i, "some words that say nothing of interest here") for i in range(40)]
    rows = [*enumerate(LICENCE_TEXTS), (None, None), *filler]
    made = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(made) == len(rows)
    texts = dict(rows)
    for row in made:
        found = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), texts[row.doc_id] or ""))
        places = []
        for phrase, label in licenses.BASE_PHRASES:
            parts = phrase.split()
            places += [(i, label) for i in range(len(found)) if found[i : i + len(parts)] == parts]
        starts = [i for i, _ in places]
        base = sorted({label for _, label in places})
        assert (row.n_words, row.n_base, row.first_word, row.last_word) == (len(found), len(places), min(starts, default=None), max(starts, default=None))
        assert row.base_labels == ",".join(base) and set(base) <= set(row.labels.split(",")) | {""} and 0 <= row.score <= 1
    by_id = {row.doc_id: row for row in made}
    assert "mit-notice" in by_id[0].labels and by_id[0].score == 1
    assert "apache-2.0-notice" in by_id[2].labels and "mit-text" in by_id[6].labels
    assert by_id[3].labels == by_id[5].labels == "" and by_id[5].score == 0


def test_licence_in_a_third_of_the_files(spark):
    for label, body, _ in licenses.TEMPLATES:
        rows = [(i, "some words that say nothing" + (" " + body if i % 3 == 0 else "")) for i in range(30)]
        made = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
        assert {row.doc_id for row in made if label in row.labels.split(",")} == set(range(0, 30, 3)), label


def test_file_with_every_licence(spark):
    """Rarer words of other licences, by chance or in a notice file, take no vote away."""
    bodies = [body for _, body, _ in licenses.TEMPLATES]
    rows = [(-1, "\n".join(bodies)), *enumerate(body for body in bodies for _ in range(40)), *((10_000 + i, "plain words") for i in range(3000))]
    made = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).filter("doc_id = -1").collect()
    assert {label for label, _, _ in licenses.TEMPLATES} <= set(made[0].labels.split(","))


def test_quality_measures(documents, rows, nothing):
    expected = Counter()
    for doc_id, t in rows:
        t = t or ""
        found = WORD.findall(t)
        windows = [tuple(found[i : i + 3]) for i in range(len(found) - 2)]
        counts = Counter(windows)
        covered = {i + k for i, g in enumerate(windows) if counts[g] > 1 for k in range(3)}
        lines = [line for line in t.split("\n") if WORD.search(line)]
        expected[doc_id, len(found), sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered)] += 1
    made = quality.ledger(documents)
    assert bag(made.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == expected
    base = made.filter(quality.fails("base") != ((F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))))
    assert base.count() == 0
    assert quality.ledger(nothing).count() == 0


def test_quality_ablations(documents):
    made = quality.ledger(documents)
    bits = [r.failed & quality.policy_mask("v1") for r in made.collect()]
    want = {(name, sum(b & quality.RULES[name] != 0 for b in bits), sum(b == quality.RULES[name] for b in bits)) for name in quality.POLICIES["v1"]}
    assert {tuple(r) for r in quality.ablations(made).collect()} == want
    assert quality.apply_policy(made).count() == bits.count(0)


def test_lcs():
    rng = random.Random(2)
    for _ in range(200):
        a, b = ([rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randint(0, 12))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert decontaminate.lcs_length(a, b) == table[-1][-1]


def test_decontamination_equals_the_check_on_every_passage(spark):
    """Short items, an item in a third of the documents, paraphrases with 55% of the words, and items with gaps."""
    rng = random.Random(12)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6))) for _ in range(700)]
    common = ["the", "of", "and", "to"]

    def text(k):
        return [rng.choice(common) if rng.random() < 0.4 else rng.choice(vocabulary) for _ in range(k)]

    items = [*(text(rng.randint(8, 12)) for _ in range(25)), text(16), *(text(rng.randint(20, 45)) for _ in range(15))]
    docs = []
    for i in range(240):
        own = text(rng.randint(0, 150))
        copy = list(items[25] if i % 3 == 0 else items[i % len(items)])
        if i % 3 == 1:  # other words for 45% of its words, the answer kept
            for k in rng.sample(range(len(copy) - decontaminate.ANSWER), min(int(0.45 * len(copy)), len(copy) - decontaminate.ANSWER)):
                copy[k] = rng.choice(vocabulary)
        elif i % 3 == 2 and i % 2:  # words between its words
            copy = [w for word in copy for w in (word, *text(rng.randint(0, 2)))]
        docs.append((i, " ".join([*own, *copy, *text(rng.randint(0, 150))])))
    benchmark = [(i, " ".join(words)) for i, words in enumerate(items)]
    want = set()
    for i, body in docs:
        found = decontaminate.plain_words(body)
        for j, item_text in benchmark:
            item = decontaminate.Item(j, item_text, None)
            size = len(item.words)
            starts = range(0, max(len(found) - decontaminate.PASSAGE, 0) + decontaminate.STRIDE, decontaminate.STRIDE)
            around = (found[max(s - size, 0) : s + decontaminate.PASSAGE + decontaminate.STRIDE + size] for s in starts)
            if any(item.check(near)[2] for near in around):
                want.add((i, j))
    left = spark.createDataFrame(docs, "doc_id long, text string")
    made = decontaminate.contaminated(left, spark.createDataFrame(benchmark, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in made} == want and len(made) == len(want)


def test_recall_of_the_cosine_stage(spark):
    """How many of the contaminated pairs the latent search alone would have made candidates; the lookup finds the rest."""
    rng = random.Random(21)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(1500)]
    common = ["the", "of", "and", "to"]

    def text(k):
        return [rng.choice(common) if rng.random() < 0.4 else rng.choice(vocabulary) for _ in range(k)]

    items = [text(rng.randint(15, 45)) for _ in range(60)]
    docs = []
    for i in range(360):
        copy = list(items[i % 60])
        if i % 3:  # up to a fifth of its words replaced
            for k in rng.sample(range(len(copy) - decontaminate.ANSWER), len(copy) // 5):
                copy[k] = rng.choice(vocabulary)
        docs.append((i, " ".join([*text(rng.randint(0, 120)), *copy, *text(rng.randint(0, 120))])))
    left = spark.createDataFrame(docs, "doc_id long, text string")
    right = spark.createDataFrame([(i, " ".join(words)) for i, words in enumerate(items)], "item_id long, text string")
    made = {(r.doc_id, r.item_id): r.cosine for r in decontaminate.contaminated(left, right).collect()}
    assert all((i, i % 60) in made for i in range(360))
    recall = sum(made[i, i % 60] >= decontaminate.COSINE for i in range(360)) / 360
    print(f"recall of the cosine stage: {recall:.3f}")
    assert recall >= 0.9


def test_short_items_are_searched_like_others(spark):
    """A copy of six words with one between them, and one with a word changed; the same words far apart are nothing."""
    item = "seven purple otters juggle warm lanterns"
    docs = [(1, "we saw seven purple otters quietly juggle warm lanterns there"), (2, "seven purple otters juggle cold lanterns"), (3, "seven purple " + "x " * 90 + "otters " + "x " * 90 + "juggle")]
    left = spark.createDataFrame(docs, "doc_id long, text string")
    right = spark.createDataFrame([(4, item), (5, "one")], "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontaminate.contaminated(left, right).collect()} == {(1, 4), (2, 4)}


def test_clean_keeps_columns_of_any_name(spark):
    frame = spark.createDataFrame([(1, "nothing here", 7, "k"), (2, "three short words", 8, "r")], "doc_id long, text string, `key` int, `row` string")
    benchmark = spark.createDataFrame([(1, "three short words")], "item_id long, text string")
    kept = decontaminate.clean(frame, benchmark)
    assert kept.columns == frame.columns and [tuple(r) for r in kept.collect()] == [(1, "nothing here", 7, "k")]


def test_decontamination_by_a_given_answer(spark):
    """A paraphrase whose answer stands beside it and has words that no item has."""
    item, answer = "which of the two rivers that leave the northern lake is the longer one", "the zembra"
    text = "of the two rivers that leave a lake up there some say one is longer and it is the zembra that wins"
    left = spark.createDataFrame([(1, text), (2, text.replace("zembra", "other"))], "doc_id long, text string")
    made = decontaminate.contaminated(left, spark.createDataFrame([(7, item, answer)], "item_id long, text string, answer string")).collect()
    assert [(r.doc_id, r.item_id, r.answered) for r in made] == [(1, 7, True)]


def test_decontamination(spark):
    rng = random.Random(9)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(900)]
    common = ["the", "of", "and", "to"]

    def text(k):
        return [rng.choice(common) if rng.random() < 0.4 else rng.choice(vocabulary) for _ in range(k)]

    items = [text(rng.randint(15, 60)) for _ in range(25)]
    docs: list[tuple[int | None, str | None]] = [(i, " ".join(text(rng.randint(1, 500)))) for i in range(150)]
    leaked = {}
    for i in range(25):  # copied whole, at any place; every other with a sixth of its words replaced, the answer kept
        copy = list(items[i])
        if i % 2:
            for _ in range(len(copy) // 6):
                copy[rng.randrange(len(copy) - decontaminate.ANSWER)] = "altered"
        docs.append((1000 + i, " ".join([*text(rng.randint(0, 90)), *copy, *text(rng.randint(0, 90))])))
        leaked[1000 + i] = i
    docs += [(2000, None), (None, ""), (2001, " ")]
    benchmark = [*((i, " ".join(words)) for i, words in enumerate(items)), (90, None), (91, ""), (92, "one short item")]
    docs += [(2002, "here is one short item, you see"), (None, " ".join(items[0]))]
    left = spark.createDataFrame([(i, t, "k") for i, t in docs], "doc_id long, text string, item_id string")
    right = spark.createDataFrame(benchmark, "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(left, right).collect()}
    assert found == {*leaked.items(), (2002, 92), (None, 0)}
    assert {r.doc_id for r in decontaminate.clean(left, right).collect()} == {i for i, _ in docs} - {*leaked, 2002}
    assert decontaminate.contaminated(left.limit(0), right).count() == 0
    assert decontaminate.clean(left, right.limit(0)).count() == len(docs)

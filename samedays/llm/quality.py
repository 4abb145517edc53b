"""Quality rules as a bitmask ledger: every rule is evaluated once, its failure is one bit of `failed`.

A ledger row holds the measurements and the bits of all rules. A policy is a named, versioned mask of rules;
applying one is a bitwise AND over the stored bits, never a second look at the texts. Ablations (how many
documents would come back if one rule were dropped) are counts over the distinct masks.

Everything is a DataFrame expression. No step shuffles texts: a ledger row is made where its document is read.

Defined results: a null or blank text has no words and fails `few_words`. Repeated rows give repeated rows.
Columns of the input that clash with a ledger column are replaced in the output of `ledger`; the others stay.
Repeated windows are found by 64-bit hashes of three words within one document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from samedays.llm.common import UPPER, WHITE, made_once, words

SYMBOLS = "#*$%&|<>"
WINDOW = 3

#: Bits of the rules. A rule keeps its bit for ever, so that stored ledgers stay readable.
RULES = {
    "few_words": 1 << 0,
    "repeat_windows": 1 << 1,
    "symbols": 1 << 2,
    "dup_lines": 1 << 3,
    "word_length": 1 << 4,
    "shouting": 1 << 5,
}

#: Policies: names of the rules that reject a document. A changed policy gets a new version.
POLICIES = {
    "base": ("few_words", "repeat_windows"),
    "v1": ("few_words", "repeat_windows", "symbols", "dup_lines", "word_length", "shouting"),
}

MEASURES = ("n_words", "word_chars", "n_symbols", "n_upper", "n_lines", "n_dup_lines", "n_repeat_words")


def policy_mask(policy: str) -> int:
    return sum(RULES[rule] for rule in POLICIES[policy])


def _with_repeat_words(rows: DataFrame) -> DataFrame:
    """`n_repeat_words` from `_hashes`, the hash of every window of three words in order.

    Windows sorted by (hash, place) have their equals next to them. The places found, in order again, each add
    the words up to the next place, three at most. Each array is a column of its own, so that it is made once.
    """
    none = F.array().cast("array<struct<h:bigint,i:int>>")
    repeats = F.size(F.array_distinct("_hashes")) < F.size("_hashes")
    placed = F.sort_array(F.transform("_hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    rows = made_once(rows, _placed=F.when(repeats, placed).otherwise(none))
    pairs = F.zip_with(
        F.col("_placed"),
        F.slice("_placed", 2, F.greatest(F.size("_placed"), F.lit(1))),
        lambda a, b: F.when(a.h == b.h, F.array(a.i, b.i)),
    )
    rows = made_once(rows, _places=F.sort_array(F.array_distinct(F.flatten(F.filter(pairs, lambda pair: pair.isNotNull())))))
    steps = F.zip_with(
        F.col("_places"), F.slice("_places", 2, F.greatest(F.size("_places"), F.lit(1))), lambda a, b: F.least(b - a, F.lit(WINDOW))
    )
    covered = F.aggregate(steps, F.lit(0), lambda total, step: total + F.coalesce(step, F.lit(WINDOW)))
    return made_once(rows, n_repeat_words=covered.cast("long")).drop("_placed", "_places")


def ledger(documents: DataFrame, text: str = "text") -> DataFrame:
    """The documents with the measurements and `failed`, the bits of all rules that a document fails."""
    source = F.coalesce(F.col(text), F.lit(""))
    bare = F.translate(source, WHITE, "")
    lines = F.filter(F.split(source, "\n"), lambda line: F.translate(line, WHITE, "") != "")
    measured = made_once(documents.drop(*MEASURES, "failed"), _words=words(F.col(text)), _lines=lines)
    shorter = F.size("_words") - (WINDOW - 1)
    windows = F.transform(F.slice("_words", 1, shorter), lambda w, i: F.xxhash64(w, F.get("_words", i + 1), F.get("_words", i + 2)))
    measured = made_once(
        measured,
        _hashes=F.when(shorter > 0, windows).otherwise(F.array().cast("array<bigint>")),
        n_words=F.size("_words").cast("long"),
        word_chars=F.length(bare).cast("long"),
        n_symbols=(F.length(source) - F.length(F.translate(source, SYMBOLS, ""))).cast("long"),
        n_upper=(F.length(source) - F.length(F.translate(source, UPPER, ""))).cast("long"),
        n_lines=F.size("_lines").cast("long"),
        n_dup_lines=(F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
    )
    measured = _with_repeat_words(measured).drop("_words", "_lines", "_hashes")
    checks = {
        "few_words": F.col("n_words") < 50,
        "repeat_windows": 100 * F.col("n_repeat_words") > 50 * F.col("n_words"),
        "symbols": 10 * F.col("n_symbols") > 3 * F.col("n_words"),
        "dup_lines": 100 * F.col("n_dup_lines") > 30 * F.col("n_lines"),
        "word_length": (F.col("word_chars") < 2 * F.col("n_words")) | (F.col("word_chars") > 20 * F.col("n_words")),
        "shouting": 2 * F.col("n_upper") > F.col("word_chars"),
    }
    bits = F.lit(0).cast("long")
    for rule, failing in checks.items():
        bits = bits.bitwiseOR(F.when(failing, F.lit(RULES[rule])).otherwise(F.lit(0)).cast("long"))
    return measured.withColumn("failed", bits)


def fails(policy: str) -> Column:
    """Whether a ledger row fails a policy."""
    return F.col("failed").bitwiseAND(F.lit(policy_mask(policy))) != 0


def apply_policy(ledger_rows: DataFrame, policy: str = "v1") -> DataFrame:
    """The ledger rows that a policy keeps."""
    return ledger_rows.filter(~fails(policy))


def ablations(ledger_rows: DataFrame, policy: str = "v1") -> DataFrame:
    """For each rule of a policy: documents that fail it, and those that fail nothing else (kept without the rule).

    The rows are counted once per distinct mask, of which there are at most two to the number of rules; one row
    per rule is made from those few counts. An empty ledger gives zeros.
    """
    masks = (
        ledger_rows.select(F.col("failed").bitwiseAND(F.lit(policy_mask(policy))).alias("mask")).groupBy("mask").agg(F.count("*").alias("n"))
    )
    sums = []
    for rule in POLICIES[policy]:
        bit = F.lit(RULES[rule]).cast("long")
        failing = F.sum(F.when(F.col("mask").bitwiseAND(bit) != 0, F.col("n")))
        alone = F.sum(F.when(F.col("mask") == bit, F.col("n")))
        sums.append(
            F.struct(
                F.lit(rule).alias("rule"), F.coalesce(failing, F.lit(0)).alias("n_failed"), F.coalesce(alone, F.lit(0)).alias("n_only")
            )
        )
    return masks.agg(F.array(*sums).alias("rules")).select(F.inline("rules"))

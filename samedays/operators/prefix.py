"""Prefix filtering: candidates from the rarest days of each cell, counted on their bits.

Two cells that share at least t days share one among their rarest: a cell of n days
may leave out its t - 1 most frequent days and keeps n - t + 1 (the prefix filter of
set-similarity joins: Chaudhuri, Ganti and Kaushik, ICDE 2006). Pairs are listed on
the kept days only, and a hot day, which is the most frequent of all, is listed
for cells of few days at most.

Days are not sorted. They fall in ``CLASSES`` classes of rarity, the same for all
cells, and a cell keeps whole classes, the rarest first, until it has enough days: a
superset of the exact prefix, so nothing is lost, and no cell's days are gathered.

Beyond the kept classes a cell has at most t - 1 days. A pair seen on c kept days can
reach t only if c and what the cell with fewer classes has left make t; the others go
before their days are counted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from samedays.operators.pairing import BLOCK, count_pairs, enumerate_pairs, listed_days

CLASSES = 64

# Precision of the class bounds; any bounds are right, equal ones save most.
_ACCURACY = 10_000


def day_classes(days: DataFrame) -> DataFrame:
    """(date, rarity) from rows (date, cell): about as many days in each class, 0 the rarest."""
    counted = days.groupBy("date").agg(F.count("*").alias("n"))
    # days of equal frequency are dealt to classes by a hash, the same way for all cells
    key = F.col("n") + F.pmod(F.xxhash64("date"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    keyed = counted.select("date", key.alias("key"))
    shares = F.array(*[F.lit(i / CLASSES) for i in range(1, CLASSES)])
    bounds = keyed.agg(F.percentile_approx("key", shares, F.lit(_ACCURACY)).alias("bounds"))
    below = F.filter("bounds", lambda bound: bound < F.col("key"))
    # the bounds are one row
    return keyed.join(F.broadcast(bounds)).select("date", F.size(below).alias("rarity"))


def prefixes(rows: DataFrame, floor: Column | int) -> tuple[DataFrame, DataFrame]:
    """Of rows (span, cell, days): (date, cell) on the days a cell keeps, and (cell, last, left) of every cell.

    ``last`` is the last class a cell keeps, ``left`` the number of its days beyond. Cells with fewer than
    ``floor`` days have no part in a pair that counts and keep none.
    """
    days = listed_days(rows)
    posted = days.join(day_classes(days), "date")
    classes = posted.groupBy("cell", "rarity").agg(F.count("*").alias("n"))
    cell = Window.partitionBy("cell")
    summed = classes.select(
        "cell", "rarity", F.sum("n").over(cell.orderBy("rarity")).alias("so_far"), F.sum("n").over(cell).alias("n")
    )
    enough = summed.where((F.col("n") >= floor) & (F.col("so_far") >= F.col("n") - floor + 1))
    # the first class with enough is the last one kept, and has the most days beyond it
    cuts = enough.groupBy("cell").agg(F.min("rarity").alias("last"), F.max(F.col("n") - F.col("so_far")).alias("left"))
    return posted.join(cuts, "cell").where("rarity <= last").select("date", "cell"), cuts


def candidate_pairs(rows: DataFrame, floor: Column | int, block: int = BLOCK, multiplier: int | None = None) -> DataFrame:
    """(a, b) of every pair that may be together on ``floor`` days or more."""
    kept, cuts = prefixes(rows, floor)
    seen = count_pairs(enumerate_pairs(kept, "blocked", block, multiplier))

    def of(cell: str) -> DataFrame:
        return cuts.select(*[F.col(name).alias(f"{cell}_{name}" if name != "cell" else cell) for name in cuts.columns])

    beyond = F.expr("CASE WHEN a_last < b_last THEN a_left WHEN b_last < a_last THEN b_left ELSE least(a_left, b_left) END")
    described = seen.join(of("a"), "a").join(of("b"), "b")
    return described.where(F.col("n_days") + beyond >= floor).select("a", "b")


def prefix_counts(rows: DataFrame, floor: Column | int, block: int = BLOCK, multiplier: int | None = None) -> DataFrame:
    """(a, b, n_days) of the pairs that are together on ``floor`` days or more."""
    candidates = candidate_pairs(rows, floor, block, multiplier)
    left = rows.select(F.col("cell").alias("a"), "span", F.col("days").alias("a_days"))
    right = rows.select(F.col("cell").alias("b"), "span", F.col("days").alias("b_days"))
    # the bits of both cells meet span by span; the second join is on (cell, span), so a cell of many pairs is spread
    met = candidates.join(left, "a").join(right, ["b", "span"])
    together = met.groupBy("a", "b").agg(F.sum(F.bit_count(F.col("a_days").bitwiseAND(F.col("b_days")))).alias("n_days"))
    return together.where(F.col("n_days") >= floor)

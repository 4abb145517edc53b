"""Exact pruning before the quadratic step.

A pair is together on at most as many days as its rarer cell has (Agrawal and
Srikant, VLDB 1994). The k-th best pair among a few very active cells gives a
floor that the k best pairs of all reach; cells with fewer days than that cannot
be in any of them. Cells at the floor are kept, so ties survive.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from samedays.operators.pairing import BLOCK, active_cells, count_pairs, enumerate_span_pairs

SEED_CELLS = 64


def seed_cells(k: int) -> int:
    """As many of the busiest cells as have k pairs among them, and never fewer than SEED_CELLS."""
    return max(SEED_CELLS, isqrt(2 * k) + 2)


def kth_best(counts: DataFrame, k: int) -> DataFrame:
    """One row, one column ``floor``: days of the k-th best of rows (a, b, n_days), 1 where there are fewer.

    From the number of pairs of each count, so nothing is sorted but at most as many rows as there are days.
    """
    if k == 1:
        return counts.agg(F.coalesce(F.max("n_days"), F.lit(1)).alias("floor"))
    sizes = counts.groupBy("n_days").agg(F.count("*").alias("n"))
    so_far = sizes.select("n_days", F.sum("n").over(Window.orderBy(F.desc("n_days"))).alias("so_far"))
    return so_far.where(F.col("so_far") >= k).agg(F.coalesce(F.max("n_days"), F.lit(1)).alias("floor"))


def support_floor(rows: DataFrame, k: int, block: int = BLOCK, multiplier: int | None = None) -> DataFrame:
    """One row, one column: days that each of the k best pairs has at least.

    Any choice of seeds gives a valid floor; with too few pairs among them it is 1.
    Seeds are paired in the same bounded units as all cells, whatever their number.
    """
    busiest = rows.groupBy("cell").agg(F.sum(F.bit_count("days")).alias("n")).orderBy(F.desc("n"), "cell")
    seeds = busiest.limit(seed_cells(k)).select("cell")
    rows_of_seeds = rows.join(seeds, "cell", "left_semi")
    counts = count_pairs(enumerate_span_pairs(rows_of_seeds, block, multiplier, cells=seed_cells(k)))
    return kth_best(counts, k)


def frequent_cells(rows: DataFrame, k: int, block: int = BLOCK, multiplier: int | None = None) -> DataFrame:
    """The rows (span, cell, days) whose cell may be in one of the k best pairs."""
    return active_cells(rows, support_floor(rows, k, block, multiplier).scalar())

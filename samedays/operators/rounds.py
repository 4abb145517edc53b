"""The strongest pairs with a floor that rises while pairing.

Cells are taken by falling number of days. A round pairs the busiest ones so far;
its k-th best pair is a floor that the k best of all reach, so cells with fewer days
leave before the next, larger round. The search ends when a round holds every cell
that reaches its floor: with skewed activity after few of them, at the latest when
all cells are in.

Each round knows what it is about to list, before it does: pairs of cells by span, or by
day on the days that prefixes keep. It takes the shorter way.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from samedays.functions.shared import kept
from samedays.operators.pairing import BLOCK, count_pairs, enumerate_span_pairs, listed_days
from samedays.operators.prefix import prefix_counts, prefixes
from samedays.operators.pruning import kth_best, seed_cells

# Cells of a round, in cells of the one before.
GROWTH = 4

# Candidates are looked up again, so a prefix must list this much less to be worth it.
LOOKUP = 3


@dataclass(frozen=True)
class Round:
    """What a round did: its cells, the pairs it listed and by which way, and the floor after it."""

    cells: int
    listed: int
    way: str
    floor: int


def listed_by_span(rows: DataFrame) -> int:
    """Pairs that pairing by span lists for rows (span, cell, days): the meetings of two cells in a span."""
    sizes = rows.groupBy("span").agg(F.count("*").cast("decimal(38,0)").alias("n"))
    return int(sizes.agg(F.coalesce(F.sum(F.expr("n * (n - 1) / 2")), F.lit(0))).first()[0])


def listed_by_day(cells: DataFrame) -> int:
    """Pairs that pairing by day lists for rows (date, cell)."""
    sizes = cells.groupBy("date").agg(F.count("*").cast("decimal(38,0)").alias("n"))
    return int(sizes.agg(F.coalesce(F.sum(F.expr("n * (n - 1) / 2")), F.lit(0))).first()[0])


def counts_in_rounds(
    rows: DataFrame, k: int, block: int = BLOCK, multiplier: int | None = None, first: int | None = None
) -> tuple[DataFrame, list[Round]]:
    """(a, b, n_days) of pairs among which are the k best with all their ties, and the rounds it took.

    ``rows`` is a stored table (span, cell, days): every round reads it.
    """
    support = kept(rows.groupBy("cell").agg(F.sum(F.bit_count("days")).alias("n")))
    size, floor, rounds = first or seed_cells(k), 1, []
    while True:
        reach = support.where(F.col("n") >= floor)
        cells = reach.count()
        whole = cells <= size
        chosen = reach if whole else reach.orderBy(F.desc("n"), "cell").limit(size)
        part = kept(rows.join(chosen.select("cell"), "cell", "left_semi"))
        # a span whose cells have few days is paired by day
        by_span = min(listed_by_span(part), listed_by_day(listed_days(part)))
        by_prefix = listed_by_day(prefixes(part, floor)[0]) if rounds and by_span else by_span
        if by_prefix * LOOKUP < by_span:
            counts, listed, way = prefix_counts(part, floor, block, multiplier), by_prefix, "prefix"
        else:
            counts, listed, way = count_pairs(enumerate_span_pairs(part, block, multiplier)), by_span, "span"
        counts = kept(counts.where(F.col("n_days") >= floor))
        floor = max(floor, kth_best(counts, k).first()[0])
        rounds.append(Round(min(cells, size), listed, way, floor))
        if whole or support.where(F.col("n") >= floor).count() <= size:
            return counts, rounds
        size *= GROWTH

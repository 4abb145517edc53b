"""The strongest pairs: top k, and all ties at the top."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from samedays.functions import grid, spans
from samedays.functions.shared import kept
from samedays.operators.numbering import numbered
from samedays.operators.observations import cell_spans
from samedays.operators.pairing import (
    BLOCK,
    STRATEGIES as PAIRING,
    active_cells,
    check_strategy,
    count_pairs,
    enumerate_pairs,
    enumerate_span_pairs,
    listed_days,
)
from samedays.operators.prefix import prefix_counts
from samedays.operators.pruning import kth_best, support_floor
from samedays.operators.rounds import counts_in_rounds

STRATEGIES = (*PAIRING, "prefix", "rounds")


def _counted(
    obs: DataFrame, k: int, strategy: str, block: int, multiplier: int | None
) -> tuple[DataFrame, DataFrame]:
    """Pair counts, and the rows (span, cell, days) they come from.

    Every strategy pairs only cells that may be in one of the k best pairs. Groups are
    cut by their size before pruning: an upper bound, and a smaller plan.
    """
    check_strategy(strategy, STRATEGIES)
    rows = cell_spans(obs)
    if strategy == "rounds":
        stored = kept(rows)
        return counts_in_rounds(stored, k, block, multiplier)[0], stored
    floor = support_floor(rows, k, block, multiplier).scalar()
    frequent = active_cells(rows, floor)
    if strategy == "prefix":
        return prefix_counts(frequent, floor, block, multiplier), rows
    if strategy == "count_first":
        return count_pairs(enumerate_span_pairs(frequent, block, multiplier, sized=rows)), rows
    return count_pairs(enumerate_pairs(listed_days(frequent), strategy, block, multiplier)), rows


def _best_first() -> list:
    return [F.desc("n_days"), F.asc("a"), F.asc("b")]


def _with_days(winners: DataFrame, rows: DataFrame, *others: str) -> DataFrame:
    """Winners (a, b, others) with ``times``, their sorted days, from rows (span, cell, days)."""
    members = winners.select("a", "b", *others, F.explode(F.array("a", "b")).alias("cell"))
    # Both cells' days of a span meet as bits; only days in common are spelled out.
    together = (
        rows.join(members, "cell")
        .groupBy("a", "b", *others, "span")
        .agg(F.count("*").alias("present"), F.bit_and("days").alias("days"))
        .where((F.col("present") == 2) & (F.col("days") != 0))
        .select("a", "b", *others, spans.dates("span", "days").alias("dates"))
    )
    return together.groupBy("a", "b", *others).agg(F.array_sort(F.flatten(F.collect_list("dates"))).alias("times"))


def _check_k(k: int) -> None:
    if k < 1:
        raise ValueError(f"k must be positive, found {k}")


def top_pairs(
    obs: DataFrame,
    k: int = 1,
    strategy: str = "count_first",
    block: int = BLOCK,
    multiplier: int | None = None,
) -> DataFrame:
    """The k pairs with most days, best first: lon1, lat1, lon2, lat2, n_days, times.

    Equal counts are ordered by (lon1, lat1, lon2, lat2). Without any pair the
    result is empty. Pairs are counted without their days; the days are fetched
    afterwards, for the k winners only. The k rows meet in one task: for a k
    beyond some ten thousands use ``ranked_pairs``.
    """
    _check_k(k)
    counts, rows = _counted(obs, k, strategy, block, multiplier)
    winners = counts.orderBy(*_best_first()).limit(k)
    ranked = _with_days(winners, rows).withColumn("n_days", F.size("times").cast("bigint"))
    return ranked.orderBy(*_best_first()).limit(k).select(*grid.pair_columns(), "n_days", "times")


def ranked_pairs(
    obs: DataFrame,
    k: int,
    strategy: str = "count_first",
    block: int = BLOCK,
    multiplier: int | None = None,
) -> DataFrame:
    """``top_pairs`` for any k, in no order, with ``rank`` from 1.

    The rows are ranked by ranges and counts (``numbered``): no task sorts or holds
    more of them than its range, and no window runs over them.
    """
    _check_k(k)
    counts, rows = _counted(obs, k, strategy, block, multiplier)
    few = counts.where(F.col("n_days") >= kth_best(counts, k).scalar())
    placed = numbered(few, _best_first()).where(F.col("place") < k)
    winners = placed.select("a", "b", "n_days", (F.col("place") + 1).alias("rank"))
    ranked = _with_days(winners, rows, "n_days", "rank")
    return ranked.select(*grid.pair_columns(), "n_days", "times", "rank")


def rank_pairs(top: DataFrame) -> DataFrame:
    """``top_pairs`` with its rank, 1 first. For a short top list; ``ranked_pairs`` ranks any number of rows."""
    order = [F.desc("n_days"), "lon1", "lat1", "lon2", "lat2"]
    return top.withColumn("rank", F.row_number().over(Window.orderBy(*order)).cast("bigint"))


def tied_winners(
    obs: DataFrame,
    strategy: str = "count_first",
    block: int = BLOCK,
    multiplier: int | None = None,
) -> DataFrame:
    """Every pair with the greatest number of days: lon1, lat1, lon2, lat2, n_days."""
    counts, _ = _counted(obs, 1, strategy, block, multiplier)
    # One-row side; both sides read the same shuffle of pair counts.
    most = counts.agg(F.max("n_days").alias("n_days"))
    tied = counts.join(most, "n_days")
    return tied.select(*grid.pair_columns(), "n_days")

"""The text report of one run."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from samedays.functions import text


def solution_report(top: DataFrame) -> DataFrame:
    """(pair_line, times_line) of every row of a top list."""
    pair = text.pair_text(F.col("lon1"), F.col("lat1"), F.col("lon2"), F.col("lat2"))
    return top.select(
        F.concat(F.lit("Pair:    "), pair).alias("pair_line"),
        F.concat(F.lit("Times:   "), text.times_text(F.col("times"))).alias("times_line"),
    )


def report_name(solver: str, cluster: str, multiplier: int, at: datetime | None = None) -> str:
    """A name of its own for every run, down to the second."""
    stamp = (at or datetime.now()).strftime("%Y%m%d_%H%M%S")
    return f"{solver}_{cluster}_coeff{multiplier}_{stamp}.txt"


def write_report(
    top: DataFrame, path: str, solver: str, cluster: str, multiplier: int, elapsed: float
) -> None:
    """Six lines for the one solution in ``top``, as text under the directory ``path``."""
    # The six labels.
    lines = F.array(
        F.lit(f"Solver:  {solver}"),
        F.lit(f"Cluster: {cluster}"),
        F.lit(f"Coeff:   {multiplier}"),
        F.col("pair_line"),
        F.col("times_line"),
        F.lit(f"Elapsed: {elapsed:.3f} seconds"),
    )
    report = solution_report(top).select(F.explode(lines).alias("value"))
    report.coalesce(1).write.mode("overwrite").text(path)

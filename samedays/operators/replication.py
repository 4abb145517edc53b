"""Workload replication for weak-scaling runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from samedays.functions import grid
from samedays.functions.text import REPLICA_FORMAT

# Workers of the baseline run, shift of one replica in degrees.
BASE_WORKERS = 2
REPLICA_SHIFT = 1000.0


def replica_factor(workers: int, base_workers: int = BASE_WORKERS) -> int:
    if workers < base_workers:
        raise ValueError(f"weak scaling needs at least {base_workers} workers, found {workers}")
    if workers % base_workers:
        raise ValueError(f"weak scaling needs a multiple of {base_workers} workers, found {workers}")
    return workers // base_workers


def replicate(obs: DataFrame, workers: int, base_workers: int = BASE_WORKERS) -> DataFrame:
    """``workers / base_workers`` copies, each with days and locations of its own.

    Replica r moves both coordinates by r x 1000 degrees; with more than one
    copy every day, that of replica 0 too, carries its replica number. A place that
    leaves the grid by its shift fails the job.
    """
    factor = replica_factor(workers, base_workers)
    if factor == 1:
        return obs
    copies = obs.select("*", F.explode(F.sequence(F.lit(0), F.lit(factor - 1))).alias("replica"))
    shift = F.col("replica") * F.lit(REPLICA_SHIFT)
    moved = copies.select(
        F.format_string(REPLICA_FORMAT, F.col("date"), F.col("replica")).alias("date"),
        (F.col("lon") + shift).alias("lon"),
        (F.col("lat") + shift).alias("lat"),
    )
    complaint = F.concat(F.lit("replica beyond the grid: "), F.to_json(F.struct("date", "lon", "lat")))
    missing = F.col("lon").isNull() | F.col("lat").isNull()
    inside = F.when(missing | (grid.on_grid("lon") & grid.on_grid("lat")), F.lit(True))
    return moved.where(inside.otherwise(F.raise_error(complaint)))

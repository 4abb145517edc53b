"""One run from event table to report: read, replicate, find the strongest pair, write it."""

from __future__ import annotations

from dataclasses import dataclass
from time import perf_counter

from pyspark.sql import DataFrame, Row, SparkSession

from samedays.functions.text import ELAPSED_MARK
from samedays.operators.observations import spread
from samedays.operators.ranking import top_pairs
from samedays.operators.replication import replicate
from samedays.sources.events import read_observations
from samedays.sources.report import report_name, write_report


@dataclass(frozen=True)
class Run:
    strategy: str = "count_first"
    cluster: str = "local"
    multiplier: int = 4
    workers: int = 2
    weak_scaling: bool = False
    spread_input: bool = False


@dataclass(frozen=True)
class Outcome:
    solution: Row | None
    elapsed: float
    report: str | None


def plan_run(spark: SparkSession, path: str, run: Run = Run(), fmt: str = "csv") -> DataFrame:
    """The one-row (or, without any pair, empty) result of a run, not yet computed."""
    if run.workers <= 0:
        raise ValueError(f"invalid worker count: {run.workers}")
    obs, _ = read_observations(spark, path, "strict", fmt)
    if run.weak_scaling:
        obs = replicate(obs, run.workers)
    if run.spread_input:
        obs = spread(obs, run.multiplier)
    return top_pairs(obs, 1, run.strategy, multiplier=run.multiplier)


def execute_run(
    spark: SparkSession, path: str, run: Run = Run(), fmt: str = "csv", report_dir: str | None = None
) -> Outcome:
    """Compute, time and report a run; its one solution row is all that reaches the driver."""
    planned = plan_run(spark, path, run, fmt)
    started = perf_counter()
    rows = planned.collect()
    elapsed = perf_counter() - started
    print(f"{ELAPSED_MARK} {elapsed:.3f} seconds", flush=True)
    report = None
    if report_dir and rows:
        report = f"{report_dir}/{report_name(run.strategy, run.cluster, run.multiplier)}"
        solution = spark.createDataFrame(rows, planned.schema)
        write_report(solution, report, run.strategy, run.cluster, run.multiplier, elapsed)
    return Outcome(rows[0] if rows else None, elapsed, report)

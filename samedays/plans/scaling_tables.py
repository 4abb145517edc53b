"""From timing tables to the derived scaling tables on disk."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from samedays.operators.scaling import (
    metrics_long,
    metrics_summary,
    speedup,
    strong_efficiency,
    weak_efficiency,
    weak_missing_baseline,
)
from samedays.sources.metrics import read_metrics, write_metric_tables, write_weak_table


def summarize(metrics: DataFrame) -> DataFrame:
    return metrics_summary(metrics_long(metrics))


def write_scaling_tables(
    spark: SparkSession, metrics_path: str, directory: str, weak_path: str | None = None
) -> DataFrame | None:
    """Write speedup and strong efficiency, and with ``weak_path`` weak efficiency too.

    Returns the weak series that had to be left out for want of a baseline.
    """
    speedups = speedup(summarize(read_metrics(spark, metrics_path)))
    write_metric_tables(speedups, strong_efficiency(speedups), directory)
    if weak_path is None:
        return None
    weak = summarize(read_metrics(spark, weak_path))
    write_weak_table(weak_efficiency(weak), directory)
    return weak_missing_baseline(weak)

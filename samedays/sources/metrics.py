"""Benchmark tables: wide timings, result rows, derived tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from samedays.operators.results import results_upsert
from samedays.operators.scaling import KEYS, METRICS
from samedays.sources.versions import read_current, replace_current

_ORDER = ("solver", "partition_multiplier", "workers")

# Columns of the derived tables, in order.
SPEEDUP_COLUMNS = (*_ORDER, "speedup")
STRONG_COLUMNS = (*_ORDER, "efficiency")
WEAK_COLUMNS = (*_ORDER, "workload_scale", "efficiency")


def typed_metrics(table: DataFrame) -> DataFrame:
    """Check and cast a timing table whose columns are text; blank and NaN times are missing."""
    missing = sorted({*KEYS, *METRICS} - set(table.columns))
    if missing:
        raise ValueError(f"a timing table needs {missing} besides its columns {table.columns}")
    times = [F.nullif(F.col(name).cast("double"), F.lit(float("nan"))).alias(name) for name in METRICS]
    return table.select(
        F.col("workers").cast("int").alias("workers"),
        F.col("run").cast("bigint").alias("run"),
        "solver",
        *times,
    )


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return typed_metrics(spark.read.option("header", "true").csv(path))


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """Result rows as text: solver and its times, blank or with three decimals."""
    return spark.read.option("header", "true").csv(path)


def write_results(results: DataFrame, path: str) -> None:
    results.write.mode("overwrite").option("header", "true").csv(path)


def upsert_results(new: DataFrame, path: str) -> DataFrame:
    """Write the rows of ``new`` over those of the versioned result table at ``path``, and return what it now holds.

    The table is read and replaced in place. If the job fails at any point, the table is as it was. Without a
    table yet, the new rows become it.
    """
    spark = new.sparkSession
    old = read_current(spark, path)
    replace_current(new if old is None else results_upsert(old, new), path)
    return read_current(spark, path)


def _write_table(table: DataFrame, columns: tuple[str, ...], path: str) -> None:
    ordered = table.select(*columns).orderBy(*_ORDER)
    ordered.write.mode("overwrite").option("header", "true").csv(path)


def write_metric_tables(speedups: DataFrame, strong: DataFrame, directory: str) -> None:
    _write_table(speedups, SPEEDUP_COLUMNS, f"{directory}/speedup.csv")
    _write_table(strong, STRONG_COLUMNS, f"{directory}/strong.csv")


def write_weak_table(weak: DataFrame, directory: str) -> None:
    _write_table(weak, WEAK_COLUMNS, f"{directory}/weak.csv")

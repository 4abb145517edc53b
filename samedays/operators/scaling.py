"""Benchmark timings to mean, deviation, speedup and scaling efficiency."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from samedays.operators.replication import BASE_WORKERS

# The columns of the wide timing table.
METRICS = ("time_p2x", "time_p3x", "time_p4x")
KEYS = ("workers", "run", "solver")

_SERIES = ("solver", "partition_multiplier")


def _ratio(numerator: Column, denominator: Column) -> Column:
    """Floating-point division that gives infinity or NaN by zero, ANSI mode or not."""
    by_zero = F.when(numerator == 0, F.lit(float("nan"))).otherwise(F.lit(float("inf")))
    quotient = numerator / F.nullif(denominator, F.lit(0.0))
    return F.when((denominator == 0) & numerator.isNotNull(), by_zero).otherwise(quotient)


def metrics_long(metrics: DataFrame) -> DataFrame:
    """Unpivot: one row per run and partition multiplier; missing times stay as nulls."""
    long = metrics.unpivot(list(KEYS), list(METRICS), "metric", "time")
    multiplier = F.regexp_extract("metric", r"^time_p(\d+x)$", 1)
    return long.withColumn("partition_multiplier", multiplier)


def metrics_summary(long: DataFrame) -> DataFrame:
    """Mean and sample deviation per configuration; a single time has no deviation."""
    return long.groupBy("workers", *_SERIES).agg(
        F.avg("time").alias("mean_time"), F.stddev_samp("time").alias("std_time")
    )


def timing_moments(long: DataFrame) -> DataFrame:
    """(workers, solver, partition_multiplier, n, mean, squares): a state of each configuration that merges with others.

    ``squares`` is the sum of squared deviations from the mean. Missing times do not count; a configuration that has
    no time at all has n = 0 and a null mean, and stays.
    """
    time = F.col("time")
    return long.groupBy("workers", *_SERIES).agg(
        F.count(time).alias("n"),
        F.avg(time).alias("mean"),
        F.coalesce(F.var_pop(time) * F.count(time), F.lit(0.0)).alias("squares"),
    )


def merge_moments(*states: DataFrame) -> DataFrame:
    """The state of all runs from the states of some of them, in any order and grouping.

    Means are merged first; each state then adds its own squares and those of its mean against the common one, so no
    large squares cancel each other (Chan, Golub and LeVeque, 1979). States of a configuration are as many as are given.
    """
    every = states[0]
    for state in states[1:]:
        every = every.unionByName(state)
    same = Window.partitionBy("workers", *_SERIES)
    total = F.sum("n").over(same)
    weighed = F.sum(F.col("n") * F.col("mean")).over(same) / F.nullif(total, F.lit(0))
    with_mean = every.withColumn("common", weighed)
    apart = F.col("n") * F.pow(F.col("mean") - F.col("common"), 2)
    return with_mean.groupBy("workers", *_SERIES).agg(
        F.sum("n").alias("n"), F.max("common").alias("mean"), F.sum(F.col("squares") + F.coalesce(apart, F.lit(0.0))).alias("squares")
    )


def moments_summary(states: DataFrame) -> DataFrame:
    """``metrics_summary`` of all runs that went into merged states."""
    deviation = F.sqrt(F.col("squares") / (F.col("n") - 1))
    return states.select(
        "workers", *_SERIES, F.col("mean").alias("mean_time"), F.when(F.col("n") > 1, deviation).alias("std_time")
    )


def _with_baseline(summary: DataFrame) -> DataFrame:
    # A window instead of a self-join: the summary is computed and shuffled once.
    # Its rows per series are one per worker count.
    of_baseline = F.when(F.col("workers") == BASE_WORKERS, F.col("mean_time"))
    series = Window.partitionBy(*_SERIES)
    return summary.withColumn("baseline_mean_time", F.max(of_baseline).over(series))


def _workers_ratio() -> Column:
    return F.col("workers") / F.lit(float(BASE_WORKERS))


def speedup(summary: DataFrame) -> DataFrame:
    """Baseline time over time, for all but the baseline; null without a baseline."""
    compared = _with_baseline(summary).where(F.col("workers") != BASE_WORKERS)
    return compared.withColumn("speedup", _ratio(F.col("baseline_mean_time"), F.col("mean_time")))


def strong_efficiency(speedups: DataFrame) -> DataFrame:
    """Speedup over ideal speedup, the growth in workers."""
    return speedups.withColumn("efficiency", F.col("speedup") / _workers_ratio())


def weak_efficiency(summary: DataFrame) -> DataFrame:
    """Baseline time over time with the workload grown like the workers, baseline included.

    Series without a baseline are left out; ``weak_missing_baseline`` lists them.
    """
    return (
        _with_baseline(summary)
        .where(F.col("baseline_mean_time").isNotNull())
        .select(
            *_SERIES,
            "workers",
            _workers_ratio().alias("workload_scale"),
            _ratio(F.col("baseline_mean_time"), F.col("mean_time")).alias("efficiency"),
        )
    )


def weak_missing_baseline(summary: DataFrame) -> DataFrame:
    """The series (solver, partition_multiplier) that have no baseline time."""
    return _with_baseline(summary).where(F.col("baseline_mean_time").isNull()).select(*_SERIES).distinct()


def peak_efficiency(efficiencies: DataFrame) -> DataFrame:
    """One row: the greatest efficiency."""
    return efficiencies.agg(F.max("efficiency").alias("max_efficiency"))


def best_config(summary: DataFrame) -> DataFrame:
    """The configuration with the least mean time, the first by key among equals."""
    timed = summary.where(F.col("mean_time").isNotNull())
    return timed.orderBy("mean_time", "workers", *_SERIES).limit(1)


def metrics_dimensions(metrics: DataFrame) -> DataFrame:
    """The distinct worker counts and solvers, as (dimension, value), in order."""
    values = F.array(
        F.struct(F.lit("solver").alias("dimension"), F.col("solver").alias("value")),
        F.struct(F.lit("workers").alias("dimension"), F.col("workers").cast("string").alias("value")),
    )
    return metrics.select(F.inline(values)).distinct().orderBy("dimension", "value")

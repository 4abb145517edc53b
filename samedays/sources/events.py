"""Event tables: CSV with a header, or Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from samedays.operators.observations import observations, split_rejects, store_split

REQUIRED = ("date", "latitude", "longitude")


def read_events(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """The three event columns, found by name, from any path Spark can read.

    CSV is read without a schema, as strings: a given schema would match columns
    by position. Extra columns are pruned from the scan.
    """
    if fmt == "csv":
        table = spark.read.option("header", "true").csv(path)
    elif fmt == "parquet":
        table = spark.read.parquet(path)
    else:
        raise ValueError(f"unknown event format {fmt!r}, expected 'csv' or 'parquet'")
    present = {name.lower() for name in table.columns}
    missing = [name for name in REQUIRED if name not in present]
    if missing:
        raise ValueError(f"missing event columns: {missing}")
    return table.select(*REQUIRED)


def dataset_path(bucket: str, scheme: str = "gs", name: str = "dataset.csv") -> str:
    """Where the event table of a bucket lies by convention."""
    return f"{scheme}://{bucket}/{name}"


def read_observations(
    spark: SparkSession, path: str, mode: str = "strict", fmt: str = "csv", stored: str | None = None
) -> tuple[DataFrame, DataFrame | None]:
    """(observations, rejects).

    ``strict``: an unusable event fails the job; there are no rejects (None).
    ``permissive``: unusable events come back as the second table. With ``stored``, both are written there
    in one scan of the source, and read from there; without, each scans the source when it is used.
    """
    events = read_events(spark, path, fmt)
    if mode == "strict":
        return observations(events), None
    if mode == "permissive":
        return split_rejects(events) if stored is None else store_split(events, stored)
    raise ValueError(f"unknown mode {mode!r}, expected 'strict' or 'permissive'")

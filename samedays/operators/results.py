"""Keyed upsert of benchmark result rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def results_upsert(old: DataFrame, new: DataFrame, key: str = "solver") -> DataFrame:
    """``old`` with the rows of ``new`` written over it, matched by ``key``.

    A key of ``new`` replaces every column that ``new`` has, also with a blank
    (null) time of a failed run; columns that ``new`` lacks keep their old value.
    Keys of ``old`` alone stay, keys of ``new`` alone are added. Spark cannot overwrite
    what it is reading: ``sources.metrics.upsert_results`` replaces a table in place.

    Column names match whatever their case; the result spells them as ``old`` does.
    """
    spelled = {name.lower(): name for name in old.columns}
    if key.lower() not in spelled:
        raise ValueError(f"the old rows have no column {key!r}, only {old.columns}")
    if len(spelled) < len(old.columns) or len({name.lower() for name in new.columns}) < len(new.columns):
        raise ValueError(f"columns that differ by case only: {old.columns}, {new.columns}")
    unknown = sorted(name for name in new.columns if name.lower() not in spelled)
    if unknown:
        raise ValueError(f"the old rows have no columns {unknown}, only {old.columns}")
    if key.lower() not in {name.lower() for name in new.columns}:
        raise ValueError(f"the new rows have no column {key!r}, only {new.columns}")
    key = spelled[key.lower()]
    renamed = new.toDF(*[spelled[name.lower()] for name in new.columns])
    update = renamed.withColumn("is_new", F.lit(True)).alias("new")
    joined = old.alias("old").join(update, F.col(f"old.{key}") == F.col(f"new.{key}"), "full_outer")

    def merged(name: str) -> Column:
        if name == key:
            value = F.coalesce(F.col(f"new.{name}"), F.col(f"old.{name}"))
        elif name in renamed.columns:
            value = F.when(F.col("is_new"), F.col(f"new.{name}")).otherwise(F.col(f"old.{name}"))
        else:
            value = F.col(f"old.{name}")
        return value.alias(name)

    return joined.select(*[merged(name) for name in old.columns])

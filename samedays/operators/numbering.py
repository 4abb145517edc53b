"""Positions of rows in a total order, without ever sorting them in one task."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from samedays.functions.shared import kept

# Row numbers inside a partition, the lower bits of monotonically_increasing_id.
_ROW_BITS = (1 << 33) - 1


def numbered(
    rows: DataFrame,
    order: Sequence[Column | str],
    within: Sequence[str] = (),
    keep: Callable[[DataFrame], DataFrame] = kept,
) -> DataFrame:
    """The rows with ``place``, from 0 in the order of their group, and ``group_size``.

    Rows are range partitioned and sorted by group and order, and written once with their partition
    and their row number in it: a sampled range is only the same for two readers if both read one table. The rows of
    each group in each partition are counted; sums of the counts before give every partition its offset. A group of
    any size is spread over as many partitions as its share of the rows, and the only window is over the counts, at
    most one row per group and partition.

    Rows that are equal in the whole order are numbered in any order; give a last column that tells them apart, if
    there may be many. Null is a group like any other.
    """
    keys = [F.col(name) for name in within]
    ranged = rows.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    row = F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_BITS))
    stored = keep(ranged.select("*", F.spark_partition_id().alias("_range"), row.alias("_row")))
    counted = stored.groupBy(*within, "_range").agg(F.count("*").alias("_n"), F.min("_row").alias("_first"))
    group = Window.partitionBy(*within)
    before = F.sum("_n").over(group.orderBy("_range")) - F.col("_n")
    offsets = counted.select(
        *[F.col(name).alias(f"_group_{i}") for i, name in enumerate(within)],
        F.col("_range").alias("_of"),
        (before - F.col("_first")).alias("_offset"),
        F.sum("_n").over(group).alias("group_size"),
    )
    same = [stored[name].eqNullSafe(offsets[f"_group_{i}"]) for i, name in enumerate(within)]
    met = stored.join(offsets, reduce(Column.__and__, same, stored["_range"] == offsets["_of"]))
    return met.select(*rows.columns, (F.col("_row") + F.col("_offset")).alias("place"), "group_size")

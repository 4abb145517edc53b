"""Elapsed times from a directory of job logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from samedays.functions import text


def _plain_path(path: Column) -> Column:
    """A file's path as people write it: the metadata column is percent-encoded."""
    # url_decode would turn a plus into a blank
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def log_elapsed(spark: SparkSession, path: str, expected: DataFrame | None = None) -> DataFrame:
    """One row per log file: file, solver, multiplier, stamp, elapsed.

    ``elapsed`` comes from the first line with the mark, null without one. Logs
    are read by line and may be large: only marked lines leave the scan, and
    each task keeps the first one per file. The file list comes from a scan that
    reads no content, so a log without the mark has its row too.

    Spark's file sources skip files of zero bytes, and a log may be missing
    altogether. ``expected``, a table of runs (solver, multiplier, stamp), gives
    each of its runs a row as well; ``file`` and ``elapsed`` are null without a log.
    """
    encoded = F.col("_metadata.file_path").alias("file")
    files = spark.read.format("binaryFile").load(path).select(encoded)
    # Split offset, then row number within the split: the order of lines in a file.
    position = F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
    marked = (
        spark.read.text(path)
        .where(F.col("value").contains(text.ELAPSED_MARK))
        .select(encoded, "value", position.alias("position"))
    )
    first = marked.groupBy("file").agg(F.min_by("value", "position").alias("line"))
    found = files.join(first, "file", "left").withColumn("file", _plain_path(F.col("file")))
    name = F.col("file")
    runs = found.select(
        "file",
        text.log_solver(name).alias("solver"),
        text.log_multiplier(name).alias("multiplier"),
        text.log_stamp(name).alias("stamp"),
        text.elapsed(F.col("line")).alias("elapsed"),
    )
    if expected is None:
        return runs
    keys = ["solver", "multiplier", "stamp"]
    wanted = expected.select("solver", F.col("multiplier").cast("int").alias("multiplier"), "stamp").distinct()
    return wanted.join(runs, keys, "full_outer").select(*runs.columns)

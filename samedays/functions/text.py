"""Text formats of the report, the job log and the result table."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The formats that report readers, log scans and result tables agree on.
ELAPSED_MARK = "Elapsed time:"
ELAPSED_PATTERN = r"Elapsed time:[ \t]*(\S+)"
LOG_NAME_PATTERN = r"([^/]+)_p(\d+)x_(\d{8}_\d{6})\.log$"
STAMP_FORMAT = "yyyyMMdd_HHmmss"
REPLICA_FORMAT = "%s-replica-%02d"
TIME_FORMAT = "%.3f"


def place(lon: Column, lat: Column) -> Column:
    return F.format_string("(lon=%.1f, lat=%.1f)", lon, lat)


def pair_text(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    return F.concat(place(lon1, lat1), F.lit(" -> "), place(lon2, lat2))


def times_text(times: Column) -> Column:
    return F.array_join(times, ", ")


def elapsed(line: Column) -> Column:
    """Seconds after the first elapsed mark of a text; null without a mark or a number."""
    return F.regexp_extract(line, ELAPSED_PATTERN, 1).try_cast("double")


def log_solver(name: Column) -> Column:
    return F.nullif(F.regexp_extract(name, LOG_NAME_PATTERN, 1), F.lit(""))


def log_multiplier(name: Column) -> Column:
    return F.regexp_extract(name, LOG_NAME_PATTERN, 2).try_cast("int")


def log_stamp(name: Column) -> Column:
    return F.nullif(F.regexp_extract(name, LOG_NAME_PATTERN, 3), F.lit(""))


def result_time(seconds: Column) -> Column:
    """Three decimals; a failed run (no time, or a time of zero) is blank."""
    return F.when(seconds != 0, F.format_string(TIME_FORMAT, seconds))

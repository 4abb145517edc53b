"""The 0.1-degree grid, and the packed code of a grid cell.

A cell is (longitude, latitude), both counted in tenths of a degree. Its code is
one bigint: longitude tenths in the upper 32 bits, latitude tenths plus 2^31 in
the lower 32. Codes therefore sort like (longitude, latitude), join and group on
eight bytes, and need no floating-point equality.

The functions take column names (or SQL text) and give columns.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Cells per degree, length of a day key.
CELLS_PER_DEGREE = 10
DAY_LENGTH = 10

_HALF_RANGE = 1 << 31
_LOW_WORD = (1 << 32) - 1


def _tenths(degrees: str) -> str:
    # Not round (half away from zero) and not bround (half to even): a half goes up.
    return f"floor({degrees} * {CELLS_PER_DEGREE}D + 0.5D)"


def _lon_tenths(cell: str) -> str:
    return f"shiftright({cell}, 32)"


def _lat_tenths(cell: str) -> str:
    return f"(({cell} & {_LOW_WORD}L) - {_HALF_RANGE}L)"


def _lon(cell: str) -> str:
    return f"{_lon_tenths(cell)} / {CELLS_PER_DEGREE}D"


def _lat(cell: str) -> str:
    return f"{_lat_tenths(cell)} / {CELLS_PER_DEGREE}D"


def _on_grid(degrees: str) -> str:
    limit = float(_HALF_RANGE - 1) / CELLS_PER_DEGREE
    return f"coalesce({degrees} BETWEEN -{limit}D AND {limit}D, false)"


def day_key(date: str) -> Column:
    """The first ten characters; a shorter string stays as it is, nothing is parsed."""
    return F.expr(f"substring({date}, 1, {DAY_LENGTH})")


def snap(degrees: str) -> Column:
    """Degrees to the grid; never negative zero, as it passes through an integer."""
    return F.expr(f"{_tenths(degrees)} / {CELLS_PER_DEGREE}D")


def on_grid(degrees: str) -> Column:
    """True for a number that has a cell: not null, NaN or infinite, and its tenths fit an int."""
    return F.expr(_on_grid(degrees))


def pack(lon: str, lat: str) -> Column:
    """The code of a cell; null for a null coordinate, and an error for one that has no cell."""
    code = f"shiftleft({_tenths(lon)}, 32) + ({_tenths(lat)} + {_HALF_RANGE}L)"
    missing = f"{lon} IS NULL OR {lat} IS NULL"
    complaint = f"concat('no cell for longitude ', {lon}, ' and latitude ', {lat})"
    inside = f"{_on_grid(lon)} AND {_on_grid(lat)}"
    return F.expr(f"CASE WHEN {missing} THEN NULL WHEN {inside} THEN {code} ELSE raise_error({complaint}) END")


def lon_tenths(cell: str) -> Column:
    return F.expr(_lon_tenths(cell))


def lat_tenths(cell: str) -> Column:
    return F.expr(_lat_tenths(cell))


def cell_lon(cell: str) -> Column:
    return F.expr(_lon(cell))


def cell_lat(cell: str) -> Column:
    return F.expr(_lat(cell))


def pair_columns(a: str = "a", b: str = "b") -> list[Column]:
    """The four output columns of a pair of packed cells."""
    named = {"lon1": _lon(a), "lat1": _lat(a), "lon2": _lon(b), "lat2": _lat(b)}
    return [F.expr(f"{value} AS {name}") for name, value in named.items()]


def canonical(x: str, y: str) -> list[Column]:
    """A ready pair of packed cells as (a, b), smaller (longitude, latitude) first."""
    return [F.expr(f"least({x}, {y}) AS a"), F.expr(f"greatest({x}, {y}) AS b")]

from __future__ import annotations

import random
import sys
from collections import Counter, defaultdict
from itertools import combinations
from math import floor
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from samedays.session import local_session  # noqa: E402

# The hand-worked event table: date, latitude, longitude.
MICRO = [
    ("2024-03-01T01:00:00.000Z", "37.52", "15.14"),
    ("2024-03-01 23:59:59", "38.16", "13.38"),
    ("2024-03-01", "37.48", "15.06"),
    ("2024-03-02", "38.21", "13.41"),
    ("2024-03-02", "37.5", "15.1"),
    ("2024-03-02", "-12.25", "-70.55"),
    ("2024-03-03", "-12.25", "-70.55"),
    ("2024-03-03", "37.5", "15.1"),
    ("2024-03-04", "37.5", "15.1"),
    ("2024-03-04", "38.2", "13.4"),
]


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "tests", **{"spark.sql.shuffle.partitions": "4"})
    yield session
    session.stop()


@pytest.fixture
def events(spark):
    def make(rows):
        return spark.createDataFrame(rows, "date string, latitude string, longitude string")

    return make


@pytest.fixture
def obs_of(spark):
    def make(rows):
        return spark.createDataFrame(rows, "date string, lon double, lat double")

    return make


def snapped(x: float) -> float:
    return floor(x * 10 + 0.5) / 10


def brute_stats(rows) -> dict:
    """(lon1, lat1, lon2, lat2) -> sorted days, from (date, lon, lat) rows."""
    by_day = defaultdict(set)
    for date, lon, lat in rows:
        by_day[date].add((lon, lat))
    days = defaultdict(list)
    for date in sorted(by_day):
        for a, b in combinations(sorted(by_day[date]), 2):
            days[(*a, *b)].append(date)
    return dict(days)


def brute_top(rows, k: int) -> list[tuple]:
    stats = brute_stats(rows)
    ranked = sorted(stats.items(), key=lambda item: (-len(item[1]), item[0]))
    return [(*pair, len(days), days) for pair, days in ranked[:k]]


def random_rows(seed: int, days: int, places: int, rows: int, hot_share: float = 0.0):
    """Random observations; a share of them on one hot day and, as much, at one hot place."""
    rng = random.Random(seed)
    out = []
    for _ in range(rows):
        day, place = rng.randrange(days), int(places * rng.random() ** 2)
        draw = rng.random()
        if draw < hot_share:
            day = 0
        elif draw < 2 * hot_share:
            place = 0
        out.append((f"2024-{day // 28 + 1:02d}-{day % 28 + 1:02d}", (place % 13 - 6) / 10, (place // 13 - 10) / 10))
    return out


def as_tuples(df) -> list[tuple]:
    return [tuple(row) for row in df.collect()]


def pair_total(rows) -> int:
    sizes = Counter(date for date, _, _ in set(rows))
    return sum(n * (n - 1) // 2 for n in sizes.values())

from __future__ import annotations

import pytest
from conftest import MICRO, as_tuples, snapped
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from samedays import daily_locations, observations, read_observations, split_rejects
from samedays.functions import grid
from samedays.operators.observations import daily_location_counts, spread
from samedays.sources.events import dataset_path, read_events

HEADER = "id,Place,longitude,date,latitude,depth\n"


def test_rounding_goes_up_at_the_half(spark):
    values = [-12.25, 0.05, -0.05, 12.25, 15.14, -70.55, -0.04, 179.95, 0.25, -0.25]
    df = spark.createDataFrame([(v,) for v in values], "x double").select("x", grid.snap("x"))
    got = as_tuples(df)
    assert got == [(x, snapped(x)) for x, _ in got]
    assert dict(got)[-12.25] == -12.2
    assert dict(got)[0.05] == 0.1
    assert str(dict(got)[-0.05]) == "0.0"


def test_packed_code_round_trip_and_order(spark):
    places = [(lon / 10, lat / 10) for lon in (-1800, -1, 0, 3, 1799, 99999) for lat in (-900, -1, 0, 899, 10899)]
    code = grid.pack("lon", "lat")
    df = spark.createDataFrame(places, "lon double, lat double").withColumn("c", code)
    back = df.select("lon", "lat", grid.cell_lon("c"), grid.cell_lat("c"), "c").collect()
    assert all(r[0] == r[2] and r[1] == r[3] for r in back)
    assert [(r[0], r[1]) for r in sorted(back, key=lambda r: r[4])] == sorted(places)


def test_micro_table(events):
    got = as_tuples(observations(events(MICRO)))
    assert got[0] == ("2024-03-01", 15.1, 37.5)
    assert got[1] == ("2024-03-01", 13.4, 38.2)
    assert got[5] == ("2024-03-02", -70.5, -12.2)
    assert len(got) == 10


def test_location_counts_once_per_day(events):
    obs = observations(events(MICRO))
    assert sorted(as_tuples(daily_location_counts(obs))) == [
        ("2024-03-01", 2),
        ("2024-03-02", 3),
        ("2024-03-03", 2),
        ("2024-03-04", 2),
    ]
    assert daily_locations(obs).count() == 9


def test_short_dates_are_kept(events):
    assert as_tuples(observations(events([("2024", "1", "2")]))) == [("2024", 2.0, 1.0)]


@pytest.mark.parametrize(
    "bad",
    [
        (None, "1", "2"),
        ("2024-01-01", None, "2"),
        ("2024-01-01", "1", "abc"),
        ("2024-01-01", "NaN", "2"),
        ("2024-01-01", "1", "Infinity"),
        ("2024-01-01", "1", "1e30"),
    ],
)
@pytest.mark.parametrize("ansi", ["true", "false"])
def test_unusable_events(spark, events, bad, ansi):
    table = events([("2024-01-01", " 1.5 ", "2"), bad])
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(PySparkException, match="event without usable"):
            observations(table).collect()
        with pytest.raises(PySparkException, match="event without usable"):
            observations(table).agg(F.count("*")).collect()
        kept, rejects = split_rejects(table)
        assert as_tuples(kept) == [("2024-01-01", 2.0, 1.5)]
        assert as_tuples(rejects) == [bad]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_coordinates_beyond_the_globe_are_accepted(events):
    assert as_tuples(observations(events([("d", "1090.04", "-2000.06")]))) == [("d", -2000.1, 1090.0)]


def test_csv_by_name_any_order_other_columns_ignored(spark, tmp_path):
    path = tmp_path / "dataset.csv"
    path.write_text(
        HEADER
        + "1,a,15.14,2024-03-01T01:00:00.000Z,37.52,7\n"
        + "2,b,13.38,2024-03-01,38.16,7,extra\n"
        + "3,c,,2024-03-01,38.16,7\n"
        + "4,d,1.0\n"
        + "5,e, 1.5 ,2024-03-02,NaN,1\n"
        + "6,f, 1.5 ,2024-03-02,2.0,1\n"
        + "7,g,1.0,,2.0,1\n"
    )
    kept, rejects = read_observations(spark, str(path), "permissive")
    assert sorted(as_tuples(kept)) == [
        ("2024-03-01", 13.4, 38.2),
        ("2024-03-01", 15.1, 37.5),
        ("2024-03-02", 1.5, 2.0),
    ]
    assert rejects.count() == 4
    obs, none = read_observations(spark, str(path))
    assert none is None
    with pytest.raises(PySparkException):
        obs.collect()
    plan = read_events(spark, str(path))._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<longitude:string,date:string,latitude:string>" in plan


def test_parquet_events_and_bad_arguments(spark, events, tmp_path):
    path = str(tmp_path / "events.parquet")
    events(MICRO).write.parquet(path)
    obs, _ = read_observations(spark, path, fmt="parquet")
    assert obs.count() == 10
    with pytest.raises(ValueError, match="mode"):
        read_observations(spark, path, "loose", "parquet")
    with pytest.raises(ValueError, match="format"):
        read_events(spark, path, "xml")
    spark.range(1).write.parquet(str(tmp_path / "other"))
    with pytest.raises(ValueError, match="missing event columns"):
        read_events(spark, str(tmp_path / "other"), "parquet")


def test_dataset_path():
    assert dataset_path("bucket") == "gs://bucket/dataset.csv"
    assert dataset_path("bucket", "s3a") == "s3a://bucket/dataset.csv"


def test_spread_partitions(spark, events):
    obs = observations(events(MICRO))
    assert spread(obs, 3).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism * 3
    with pytest.raises(ValueError):
        spread(obs, 0)

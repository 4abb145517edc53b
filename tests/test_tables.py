"""Tables replaced in place, events split in one scan, and states that merge."""

from __future__ import annotations

import math
import random
import re
from statistics import mean, stdev

import pytest
from pyspark.sql import functions as F

from samedays.operators.observations import split_rejects
from samedays.operators.scaling import merge_moments, metrics_long, metrics_summary, moments_summary, timing_moments
from samedays.sources.events import read_observations
from samedays.sources.metrics import upsert_results
from samedays.sources.versions import Versions, read_current, replace_current

RESULT = "Solver string, time_p2x string, time_p3x string, time_p4x string"


def rows_of(df) -> list[tuple]:
    return sorted(map(tuple, df.collect()))


def test_upsert_in_place(spark, tmp_path):
    path = str(tmp_path / "results")
    assert read_current(spark, path) is None
    first = spark.createDataFrame([("A", "1.000", "2.000", None), ("B", "3.000", None, "4.000")], RESULT)
    assert rows_of(upsert_results(first, path)) == rows_of(first)
    new = spark.createDataFrame([("B", None, "7.000"), ("C", "5.000", "6.000")], "solver string, time_p2x string, time_p3x string")
    wanted = [("A", "1.000", "2.000", None), ("B", None, "7.000", "4.000"), ("C", "5.000", "6.000", None)]
    assert rows_of(upsert_results(new, path)) == wanted
    assert rows_of(upsert_results(new, path)) == wanted
    # the version read last stays for its readers, the ones before are gone
    assert len([p for p in (tmp_path / "results").iterdir() if p.name.startswith("version-")]) == 2


def test_a_failed_upsert_leaves_the_table_as_it_was(spark, tmp_path):
    path = str(tmp_path / "results")
    upsert_results(spark.createDataFrame([(f"S{i}", "1.000", None, None) for i in range(20)], RESULT), path)
    before, version = rows_of(read_current(spark, path)), Versions(spark, path).current()
    late = F.when(F.col("id") == 19, F.raise_error(F.lit("lost midway")).cast("string")).otherwise(F.lit("9.000"))
    failing = spark.range(20, numPartitions=4).select(F.format_string("S%d", "id").alias("solver"), late.alias("time_p2x"))
    with pytest.raises(Exception, match="lost midway"):
        upsert_results(failing, path)
    assert Versions(spark, path).current() == version and rows_of(read_current(spark, path)) == before
    # a writer that dies after its table and before the pointer: nothing is named
    with pytest.raises(KeyboardInterrupt):
        versions = Versions(spark, path)
        versions._point = lambda name: (_ for _ in ()).throw(KeyboardInterrupt())
        versions.replace(lambda to: failing.where("id < 5").write.csv(to))
    assert rows_of(read_current(spark, path)) == before
    # the next write clears up what the failed ones left
    replace_current(read_current(spark, path), path)
    assert rows_of(read_current(spark, path)) == before
    assert len([p for p in (tmp_path / "results").iterdir() if p.name.startswith("version-")]) == 2


EVENTS = [("2024-01-01T00:00", "1.5", "2"), (None, "1", "2"), ("2024-01-02", "x", "2"), ("2024-01-02", "1", "NaN"), ("d", "1", "1e300"), ("2024-01-03", " 7 ", "8")]


@pytest.mark.parametrize("rows", [EVENTS, EVENTS[:1], EVENTS[1:2], []])
def test_rejects_in_one_scan(spark, tmp_path, rows):
    source = str(tmp_path / "events")
    spark.createDataFrame(rows, "date string, latitude string, longitude string").write.option("header", True).csv(source)
    events = spark.createDataFrame(rows, "date string, latitude string, longitude string")
    if rows:
        obs, rejects = read_observations(spark, source, "permissive", stored=str(tmp_path / "split"))
        wanted = split_rejects(events)
        assert rows_of(obs) == rows_of(wanted[0]) and sorted(map(repr, rejects.collect())) == sorted(map(repr, wanted[1].collect()))
        for table in (obs, rejects):
            plan = table._jdf.queryExecution().executedPlan().toString()
            assert "events" not in plan and len(re.findall("FileScan", plan)) == 1
        assert "try_cast" not in obs._jdf.queryExecution().executedPlan().toString()
    else:
        from samedays.operators.observations import store_split

        obs, rejects = store_split(events, str(tmp_path / "split"))
        assert obs.collect() == [] and rejects.collect() == []
        assert obs.columns == ["date", "lon", "lat"] and rejects.columns == ["date", "latitude", "longitude"]


TIMES = "workers int, run bigint, solver string, time_p2x double, time_p3x double, time_p4x double"


@pytest.mark.parametrize("offset", [0.0, 1e9])
def test_merged_moments(spark, offset):
    rng = random.Random(4)
    rows = [(2 + i % 2, i, f"S{i % 3}", offset + rng.random(), None if i % 4 else 3.0, None) for i in range(90)] + [(9, 99, "one", 1.5, None, None)]
    batches = [rows[:1], rows[1:7], rows[7:], []]
    states = [timing_moments(metrics_long(spark.createDataFrame(batch, TIMES))) for batch in batches]
    # merged in two ways: all at once, and one after the other
    step = states[0]
    for state in states[1:]:
        step = merge_moments(step, state)
    whole = {tuple(r[:3]): r for r in metrics_summary(metrics_long(spark.createDataFrame(rows, TIMES))).collect()}
    for merged in (merge_moments(*states), step):
        made = {(r.workers, r.solver, r.partition_multiplier): r for r in moments_summary(merged).collect()}
        assert set(made) == set(whole)
        for key, row in made.items():
            times = [t for r in rows if (r[0], r[2]) == key[:2] and (t := r[3 + ["2x", "3x", "4x"].index(key[2])]) is not None]
            assert row.mean_time == (pytest.approx(mean(times), rel=1e-12) if times else None)
            assert (row.std_time is None) == (len(times) < 2) == (whole[key].std_time is None)
            if len(times) > 1:
                assert math.isclose(row.std_time, stdev(times), rel_tol=1e-6, abs_tol=1e-12)

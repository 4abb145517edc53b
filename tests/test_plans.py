from __future__ import annotations

import re

import pytest
from conftest import random_rows

from samedays import pair_stats, tied_winners, top_pairs
from samedays.operators.observations import observations
from samedays.operators.pairing import STRATEGIES


def final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def static_plan(spark, df) -> str:
    return df._jdf.queryExecution().sparkPlan().toString()


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_no_python_and_no_cartesian_product(obs_of, strategy):
    plan = final_plan(top_pairs(obs_of(random_rows(1, 10, 20, 100)), 1, strategy))
    assert "Python" not in plan and "Pandas" not in plan
    assert "Cartesian" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_pairs_are_shuffled_without_their_day(obs_of, strategy):
    plan = final_plan(top_pairs(obs_of(random_rows(1, 10, 20, 100)), 1, strategy))
    partial = r"HashAggregate\(keys=\[a#\d+L, b#\d+L\], functions=\[partial_(?:count|sum)\([^\]]*\], output=\[([^\]]*)\]"
    counted = re.findall(partial, plan)
    assert counted
    assert {re.sub(r"#\d+L?", "", columns) for columns in counted} <= {"a, b, count", "a, b, sum"}


def test_only_limited_sides_are_broadcast(spark, tmp_path):
    """On an input that looks large, the only broadcasts are of limited sides: seeds and winners."""
    rows = random_rows(2, 20, 50, 400)
    spark.createDataFrame(rows, "date string, longitude double, latitude double").write.parquet(str(tmp_path / "e"))
    spark.conf.set("spark.sql.sources.fileCompressionFactor", "1e9")
    try:
        obs = observations(spark.read.parquet(str(tmp_path / "e")))
        plan = static_plan(spark, top_pairs(obs))
    finally:
        spark.conf.unset("spark.sql.sources.fileCompressionFactor")
    broadcast = [line for line in plan.splitlines() if "BroadcastHashJoin" in line]
    assert broadcast
    assert all("BuildRight" in line for line in broadcast)
    # lists of groups and of cells grow with the data, so they are joined by key
    assert "SortMergeJoin [span#" in plan and "SortMergeJoin [cell#" in plan


def test_ties_count_pairs_once(obs_of):
    plan = final_plan(tied_winners(obs_of(random_rows(3, 20, 30, 300)))).split("== Initial Plan ==")
    assert any(re.search(r"ReusedExchange \[a#\d+L, b#\d+L, sum", part) for part in plan)


def test_observations_are_parsed_once_per_row(events):
    rows = [("2024-01-01", "1", "2"), ("2024-01-01", "1", "3")]
    plan = static_plan(None, pair_stats(observations(events(rows))))
    assert "inline(array(struct" in plan
    assert "try_cast" not in "".join(line for line in plan.splitlines() if "Filter" in line)

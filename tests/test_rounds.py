"""Prefix filter, rounds with a rising floor, and ranks of any number of pairs."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from conftest import MICRO, as_tuples, brute_stats, brute_top, random_rows
from pyspark.sql import functions as F

from samedays import observations, tied_winners, top_pairs
from samedays.functions.shared import kept, shared_folder
from samedays.operators.numbering import numbered
from samedays.operators.observations import cell_spans
from samedays.operators.pairing import coarse_blocks, count_pairs, enumerate_span_pairs, listed_days, unit_places
from samedays.operators.prefix import candidate_pairs, prefix_counts, prefixes
from samedays.operators.pruning import kth_best
from samedays.operators.ranking import ranked_pairs
from samedays.operators.rounds import counts_in_rounds, listed_by_day, listed_by_span

NEW = ("prefix", "rounds")


def hot_day_rows(places: int, days: int, seed: int) -> list[tuple]:
    """One day on which every place is active, few days each beside it, and some places that go together."""
    rng = random.Random(seed)
    rows = [("2024-06-15", p % 90 / 10, p // 90 / 10) for p in range(places)]
    rows += [(f"2024-{1 + rng.randrange(12):02d}-{1 + rng.randrange(28):02d}", p % 90 / 10, p // 90 / 10) for p in range(places) for _ in range(2)]
    rows += [(f"2023-{1 + d % 12:02d}-{1 + d % 28:02d}", p / 10, 0.0) for p in range(9) for d in range(days) if rng.random() < 0.8]
    return rows


@pytest.mark.parametrize("strategy", NEW)
def test_micro(events, strategy):
    top = as_tuples(top_pairs(observations(events(MICRO)), 1, strategy))
    assert top == [(13.4, 38.2, 15.1, 37.5, 3, ["2024-03-01", "2024-03-02", "2024-03-04"])]
    tied = sorted(as_tuples(tied_winners(observations(events(MICRO[:8])), strategy)))
    assert tied == [(-70.5, -12.2, 15.1, 37.5, 2), (13.4, 38.2, 15.1, 37.5, 2)]


@pytest.mark.parametrize("strategy", NEW)
@pytest.mark.parametrize("rows", [[], [MICRO[0], MICRO[3]]])
def test_without_a_pair_the_result_is_empty(events, strategy, rows):
    assert as_tuples(top_pairs(observations(events(rows)), 1, strategy)) == []


@pytest.mark.parametrize("strategy", NEW)
@pytest.mark.parametrize("k, rows", [(1, random_rows(1, 25, 90, 900)), (7, random_rows(2, 25, 90, 900, hot_share=0.3)), (60, hot_day_rows(150, 60, 3))])
def test_top_k_on_flat_and_skewed_data(obs_of, strategy, k, rows):
    assert as_tuples(top_pairs(obs_of(rows), k, strategy, block=10)) == brute_top(rows, k)


@pytest.mark.parametrize("floor, rows", [(1, random_rows(1, 40, 80, 1500, hot_share=0.2)), (4, random_rows(4, 40, 80, 1500)), (9, hot_day_rows(120, 40, 9))])
def test_prefix_counts_are_all_pairs_that_reach_the_floor(obs_of, floor, rows):
    counted = as_tuples(prefix_counts(cell_spans(obs_of(rows)), floor, block=16))
    assert Counter(n for *_, n in counted) == Counter(len(days) for days in brute_stats(rows).values() if len(days) >= floor)


def test_prefix_lists_little_of_a_hot_day(obs_of):
    rows = hot_day_rows(600, 120, 5)
    spans = kept(cell_spans(obs_of(rows)))
    every = listed_by_day(listed_days(spans))
    best = brute_top(rows, 1)[0][4]
    assert best > 20
    kept_days, cuts = prefixes(spans, best)
    assert listed_by_day(kept_days) < every / 100
    assert candidate_pairs(spans, best).count() < 100
    assert cuts.agg(F.max("left")).first()[0] < best


@pytest.mark.parametrize("k", [1, 200])
def test_rounds_report_what_they_did(obs_of, k):
    rows = hot_day_rows(700, 80, k)
    spans = kept(cell_spans(obs_of(rows)))
    counts, rounds = counts_in_rounds(spans, k, first=16)
    best = brute_top(rows, k)
    assert rounds[-1].floor == best[-1][4]
    assert [r.floor for r in rounds] == sorted(r.floor for r in rounds)
    reached = {pair: len(days) for pair, days in brute_stats(rows).items() if len(days) >= rounds[-1].floor}
    found = counts.where(F.col("n_days") >= rounds[-1].floor)
    assert Counter(r.n_days for r in found.collect()) == Counter(reached.values())
    if k == 1:
        assert sum(r.listed for r in rounds) < min(listed_by_span(spans), listed_by_day(listed_days(spans))) / 20


def test_flat_data_ends_with_a_round_of_all_cells(obs_of):
    rows = [(f"2024-01-{d + 1:02d}", p / 10, 0.0) for d in range(25) for p in range(100) if (p + d) % 5]
    _, rounds = counts_in_rounds(kept(cell_spans(obs_of(rows))), 1, first=10)
    assert [r.cells for r in rounds] == [10, 40, 100]


@pytest.mark.parametrize("k", [1, 50, 10_000])
def test_kth_best(obs_of, k):
    rows = random_rows(k, 20, 40, 400)
    counts = count_pairs(enumerate_span_pairs(cell_spans(obs_of(rows))))
    ranked = sorted((len(days) for days in brute_stats(rows).values()), reverse=True)
    assert kth_best(counts, k).first()[0] == (ranked[k - 1] if k <= len(ranked) else 1)


@pytest.mark.parametrize("strategy, k", [("count_first", 1), ("count_first", 5000), ("rounds", 30)])
def test_ranked_pairs(obs_of, strategy, k):
    rows = random_rows(9, 20, 60, 700)
    ranked = sorted(as_tuples(ranked_pairs(obs_of(rows), k, strategy)), key=lambda r: r[-1])
    best = brute_top(rows, k)
    assert [r[:-1] for r in ranked] == best and [r[-1] for r in ranked] == list(range(1, len(best) + 1))


def test_a_million_ranks_in_many_tasks(spark):
    """Ties everywhere: ranks are right, no range holds much more than its share, no window runs over the rows."""
    many = 1_000_000
    rows = spark.range(many).selectExpr("id % 7 AS n", "(id * 7919) % 1000003 AS a")
    ranked = numbered(rows, [F.desc("n"), "a"])
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan and "_n" in plan
    held = ranked.withColumn("task", F.spark_partition_id()).groupBy("task").count().collect()
    assert len(held) >= 4 and max(r["count"] for r in held) < many / 2
    wanted = rows.toPandas().sort_values(["n", "a"], ascending=[False, True]).reset_index(drop=True)
    made = ranked.toPandas().sort_values("place")
    assert (made["place"].to_numpy() == range(many)).all() and set(made["group_size"]) == {many}
    assert (made[["n", "a"]].to_numpy() == wanted[["n", "a"]].to_numpy()).all()


@pytest.mark.parametrize("partitions", [1, 3, 16, 64, 500])
def test_units_are_dealt_by_cost(partitions):
    """Every unit has a task, and the tasks differ by no more than the work of one unit."""
    coarse = coarse_blocks(partitions)
    places = unit_places(coarse, partitions)
    assert len(places) == coarse * (coarse + 1) // 2
    work = [0] * partitions
    for hi in range(coarse):
        for lo in range(hi + 1):
            work[places[hi * (hi + 1) // 2 + lo]] += 1 if lo == hi else 2
    assert max(work) - min(work) <= 2 and max(work) <= 1.2 * sum(work) / partitions


def test_a_cluster_must_name_the_shared_folder(spark, monkeypatch):
    class Context:
        master = "spark://somewhere:7077"

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda name, default: default)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Session())


def test_places_within_groups(spark):
    rows = [("x", 5), ("x", 1), (None, 3), (None, 3), ("", 9), ("x", 5), (None, None)]
    made = sorted(map(tuple, numbered(spark.createDataFrame(rows, "g string, v int"), ["v"], within=["g"]).collect()), key=repr)
    wanted = [("x", 1, 0, 3), ("x", 5, 1, 3), ("x", 5, 2, 3), (None, None, 0, 3), (None, 3, 1, 3), (None, 3, 2, 3), ("", 9, 0, 1)]
    assert made == sorted(wanted, key=repr)
    assert numbered(spark.createDataFrame([], "g string, v int"), ["v"]).collect() == []

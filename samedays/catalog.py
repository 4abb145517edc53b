"""Named queries on the given tables, and the SQL that says what each must return.

The tables hold no dated places and no benchmark runs, so both are derived from
them: events with a place from ``lineitem``, timings from ``events``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from samedays.functions import grid, text
from samedays.functions.shared import fresh_path
from samedays.operators.observations import cell_spans, daily_location_counts, daily_locations, observations, store_split
from samedays.operators.pairing import count_pairs, enumerate_span_pairs, pair_days_by_date, pair_stats
from samedays.operators.ranking import rank_pairs, ranked_pairs, tied_winners, top_pairs
from samedays.operators.replication import replicate
from samedays.operators.results import results_upsert
from samedays.operators.scaling import (
    METRICS,
    best_config,
    merge_moments,
    metrics_dimensions,
    metrics_long,
    moments_summary,
    peak_efficiency,
    speedup,
    strong_efficiency,
    timing_moments,
    weak_efficiency,
    weak_missing_baseline,
)
from samedays.plans.scaling_tables import summarize
from samedays.sources.metrics import upsert_results
from samedays.sources.report import solution_report

Query = Callable[[SparkSession, str], DataFrame]

WEAK_WORKERS = 4
TOP_K = 20
RANKED_K = 2_000
RUN_BATCHES = 3


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---- derived inputs ---------------------------------------------------------------------


def place_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dated places from lineitem; the jitter by line number makes rounding do real work."""
    return _table(spark, sf_dir, "lineitem").select(
        F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss").alias("date"),
        F.expr("double((l_suppkey * 104729) % 1800) / 10 - 90").alias("latitude"),
        F.expr("double((l_suppkey * 7919) % 3600) / 10 - 180 + double(l_linenumber - 4) / 100").alias(
            "longitude"
        ),
    )


def place_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observations(place_events(spark, sf_dir))


def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "events").select(
        F.expr("2 + user_id % 3").alias("workers"),
        F.col("event_id").alias("run"),
        F.expr("concat('Solver', 1 + user_id % 5)").alias("solver"),
        *[(F.col("value") + i).alias(name) for i, name in enumerate(METRICS, start=1)],
    )


def weak_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without the baseline runs of one solver."""
    lost = (F.col("solver") == "Solver5") & (F.col("workers") == 2)
    return run_metrics(spark, sf_dir).where(~lost)


def _result_rows(metrics: DataFrame, solvers: list[str], pick: Callable) -> DataFrame:
    times = [text.result_time(pick(name)).alias(name) for name in METRICS]
    return metrics.where(F.col("solver").isin(solvers)).groupBy("solver").agg(*times)


# ---- queries ----------------------------------------------------------------------------


def _joined_times(df: DataFrame) -> DataFrame:
    return df.withColumn("times", text.times_text(F.col("times")))


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.round(name, 6) for name in names})


def _top(strategy: str, k: int = 1, weak: bool = False) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        obs = place_observations(spark, sf_dir)
        if weak:
            obs = replicate(obs, WEAK_WORKERS)
        return _joined_times(top_pairs(obs, k, strategy))

    return query


def day_key_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = place_events(spark, sf_dir).select(grid.day_key("date").alias("date"))
    return days.groupBy("date").agg(F.count("*").alias("n"))


def grid_round_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    discounts = _table(spark, sf_dir, "lineitem").select((F.lit(0.0) - F.col("l_discount")).alias("x"))
    values = _table(spark, sf_dir, "events").select(F.col("value").alias("x"))
    return discounts.unionAll(values).select("x", grid.snap("x").alias("x_rounded"))


def canonical_pairs_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each pair of a span once with its days, every other one turned round by a hash, brought into one order and counted."""
    pairs = enumerate_span_pairs(cell_spans(place_observations(spark, sf_dir)))
    turned = F.pmod(F.xxhash64("span", "a", "b"), F.lit(2)) == 1
    x, y = F.when(turned, F.col("b")).otherwise(F.col("a")), F.when(turned, F.col("a")).otherwise(F.col("b"))
    ready = pairs.select(x.alias("x"), y.alias("y"), "days")
    counted = count_pairs(ready.select(*grid.canonical("x", "y"), "days"))
    return counted.select(*grid.pair_columns(), F.col("n_days").alias("n"))


def summary_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summarize(run_metrics(spark, sf_dir))


def speedup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = speedup(summary_of(spark, sf_dir)).select("solver", "partition_multiplier", "workers", "speedup")
    return _rounded(columns, "speedup")


def strong_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    strong = strong_efficiency(speedup(summary_of(spark, sf_dir)))
    return _rounded(strong.select("solver", "partition_multiplier", "workers", "efficiency"), "efficiency")


def weak_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(weak_efficiency(summarize(weak_metrics(spark, sf_dir))), "efficiency")


def log_elapsed_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = F.format_string("run %d\nElapsed time: %s seconds\n", "event_id", F.col("value").cast("string"))
    events = _table(spark, sf_dir, "events")
    return events.select("event_id", text.elapsed(log).alias("elapsed"))


def log_keys_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamp = F.date_format("ts", text.STAMP_FORMAT)
    name = F.format_string("logs/Solver%d_p%dx_%s.log", F.expr("1 + user_id % 5"), F.expr("2 + event_id % 3"), stamp)
    named = _table(spark, sf_dir, "events").select("event_id", name.alias("name"))
    column = F.col("name")
    return named.select(
        "event_id",
        text.log_solver(column).alias("solver"),
        text.log_multiplier(column).alias("multiplier"),
        text.log_stamp(column).alias("stamp"),
    )


def _old_and_new_results(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    metrics = run_metrics(spark, sf_dir)
    old = _result_rows(metrics, ["Solver1", "Solver2", "Solver3", "Solver4"], F.min)
    new = _result_rows(metrics, ["Solver2", "Solver3", "Solver4", "Solver5"], F.max)
    failed = F.when(F.col("solver") != "Solver3", F.col("time_p3x"))
    return old, new.withColumn("time_p3x", failed)


def upsert_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return results_upsert(*_old_and_new_results(spark, sf_dir))


def upsert_in_place_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same through a table on disk that the second write replaces."""
    path = fresh_path(spark, "results")
    old, new = _old_and_new_results(spark, sf_dir)
    upsert_results(old, path)
    return upsert_results(new, path)


def rejects_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of which some have no date and some a coordinate that is no number, split in one scan and counted by day."""
    events = place_events(spark, sf_dir).select(
        F.expr("CASE WHEN latitude <> 12.5 THEN date END").alias("date"),
        F.col("latitude").cast("string").alias("latitude"),
        F.expr("if(longitude > 170, 'east', cast(longitude AS string))").alias("longitude"),
    )
    usable, rejected = store_split(events, fresh_path(spark, "events"))
    days = usable.select("date", F.lit("usable").alias("status")).unionAll(rejected.select(grid.day_key("date"), F.lit("rejected")))
    return days.groupBy("date", "status").agg(F.count("*").alias("n"))


def merged_summary_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary of all runs from the states of batches of them, each made without the others."""
    metrics = run_metrics(spark, sf_dir)
    batches = [metrics.where(F.pmod("run", F.lit(RUN_BATCHES)) == batch) for batch in range(RUN_BATCHES)]
    states = [timing_moments(metrics_long(batch)) for batch in batches]
    return _rounded(moments_summary(merge_moments(*states)), "mean_time", "std_time")


QUERIES: dict[str, Query] = {
    "day_key": day_key_query,
    "grid_round": grid_round_query,
    "observations": place_observations,
    "daily_locations": lambda s, d: daily_location_counts(place_observations(s, d)),
    "location_days": lambda s, d: daily_locations(place_observations(s, d)),
    "canonical_pairs": canonical_pairs_query,
    "pair_days": lambda s, d: pair_days_by_date(place_observations(s, d)),
    "pair_stats": lambda s, d: _joined_times(pair_stats(place_observations(s, d))),
    "top_pair": _top("count_first"),
    "top_pair_join": _top("join"),
    "top_pair_array": _top("array"),
    "top_pair_blocked": _top("blocked"),
    "top_pair_prefix": _top("prefix"),
    "top_pair_rounds": _top("rounds"),
    "ranked_pairs": lambda s, d: _joined_times(ranked_pairs(place_observations(s, d), RANKED_K)),
    "top_k_pairs": lambda s, d: _joined_times(rank_pairs(top_pairs(place_observations(s, d), TOP_K))),
    "tied_winners": lambda s, d: tied_winners(place_observations(s, d)),
    "replicate_weak": lambda s, d: replicate(place_observations(s, d), WEAK_WORKERS),
    "top_pair_weak": _top("count_first", weak=True),
    "solution_report": lambda s, d: solution_report(top_pairs(place_observations(s, d))),
    "metrics_long": lambda s, d: metrics_long(run_metrics(s, d)),
    "metrics_dimensions": lambda s, d: metrics_dimensions(run_metrics(s, d)),
    "metrics_summary": lambda s, d: _rounded(summary_of(s, d), "mean_time", "std_time"),
    "metrics_merged": merged_summary_query,
    "speedup": speedup_query,
    "strong_efficiency": strong_query,
    "weak_efficiency": weak_query,
    "weak_missing_baseline": lambda s, d: weak_missing_baseline(summarize(weak_metrics(s, d))),
    "weak_peak": lambda s, d: peak_efficiency(weak_query(s, d)),
    "best_config": lambda s, d: _rounded(best_config(summary_of(s, d)), "mean_time", "std_time"),
    "log_elapsed": log_elapsed_query,
    "log_run_keys": log_keys_query,
    "results_upsert": upsert_query,
    "results_in_place": upsert_in_place_query,
    "event_rejects": rejects_query,
}


# ---- the same in SQL --------------------------------------------------------------------

_EVENTS = """quakes AS (
  SELECT strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S') AS date,
         cast((l_suppkey * 7919) % 3600 AS double) / 10 - 180
           + cast(l_linenumber - 4 AS double) / 100 AS longitude,
         cast((l_suppkey * 104729) % 1800 AS double) / 10 - 90 AS latitude
  FROM lineitem)"""

_PLACED = f"""{_EVENTS}, placed AS (
  SELECT substring(date, 1, 10) AS date,
         floor(longitude * 10 + 0.5) / 10 AS lon, floor(latitude * 10 + 0.5) / 10 AS lat
  FROM quakes)"""

_REPLICAS = f"""SELECT date || '-replica-' || lpad(cast(r AS varchar), 2, '0') AS date,
         lon + cast(r * 1000 AS double) AS lon, lat + cast(r * 1000 AS double) AS lat
  FROM placed CROSS JOIN range({WEAK_WORKERS // 2}) t(r)"""


def _with_pairs(source: str = "SELECT * FROM placed") -> str:
    return f"""WITH {_PLACED}, obs AS (SELECT DISTINCT date, lon, lat FROM ({source})), pairs AS (
  SELECT a.date, a.lon AS lon1, a.lat AS lat1, b.lon AS lon2, b.lat AS lat2
  FROM obs a JOIN obs b ON a.date = b.date AND (a.lon < b.lon OR (a.lon = b.lon AND a.lat < b.lat)))"""


def _stats_sql(source: str = "SELECT * FROM placed") -> str:
    return f"""{_with_pairs(source)}
SELECT lon1, lat1, lon2, lat2, count(*) AS n_days, string_agg(date, ', ' ORDER BY date) AS times
FROM pairs GROUP BY lon1, lat1, lon2, lat2"""


_TENTHS_SQL = ", ".join(
    f"cast(sum(cast(round({name} * 10) AS bigint)) AS bigint) AS {name}_tenths" for name in ("lon1", "lat1", "lon2", "lat2")
)
_BEST_FIRST = "ORDER BY n_days DESC, lon1, lat1, lon2, lat2"
_TOP_SQL = f"{_stats_sql()} {_BEST_FIRST} LIMIT 1"


def _metrics_sql(weak: bool = False) -> str:
    kept = "WHERE NOT (solver = 'Solver5' AND workers = 2)" if weak else ""
    parts = " UNION ALL ".join(
        f"SELECT workers, run, solver, '{name}' AS metric, {name} AS time, '{name[6:]}' AS partition_multiplier FROM metrics"
        for name in METRICS
    )
    return f"""WITH metrics AS (
  SELECT * FROM (
    SELECT 2 + user_id % 3 AS workers, event_id AS run, 'Solver' || cast(1 + user_id % 5 AS varchar) AS solver,
           value + 1 AS time_p2x, value + 2 AS time_p3x, value + 3 AS time_p4x FROM events) {kept}),
long AS ({parts}),
summary AS (
  SELECT workers, solver, partition_multiplier, avg(time) AS mean_time, stddev_samp(time) AS std_time
  FROM long GROUP BY workers, solver, partition_multiplier),
based AS (
  SELECT s.*, b.mean_time AS baseline FROM summary s LEFT JOIN summary b
    ON b.workers = 2 AND b.solver = s.solver AND b.partition_multiplier = s.partition_multiplier)"""


def _upsert_sql() -> str:
    def rows(pick: str, first: int, last: int) -> str:
        wanted = ", ".join(f"'Solver{i}'" for i in range(first, last + 1))
        times = ", ".join(f"printf('%.3f', {pick}({name})) AS {name}" for name in METRICS)
        return f"SELECT solver, {times} FROM metrics WHERE solver IN ({wanted}) GROUP BY solver"

    merged = ", ".join(
        f"CASE WHEN n.solver IS NOT NULL THEN n.{name} ELSE o.{name} END AS {name}" for name in METRICS
    )
    return f"""{_metrics_sql()}, old_rows AS ({rows('min', 1, 4)}), new_all AS ({rows('max', 2, 5)}),
new_rows AS (SELECT solver, time_p2x, CASE WHEN solver <> 'Solver3' THEN time_p3x END AS time_p3x, time_p4x FROM new_all)
SELECT coalesce(n.solver, o.solver) AS solver, {merged}
FROM old_rows o FULL JOIN new_rows n ON o.solver = n.solver"""


_SERIES = "solver, partition_multiplier, workers"

ORACLE_SQL: dict[str, str] = {
    "day_key": f"WITH {_EVENTS} SELECT substr(date, 1, 10) AS date, count(*) AS n FROM quakes GROUP BY 1",
    "grid_round": """SELECT x, floor(x * 10 + 0.5) / 10 AS x_rounded FROM (
  SELECT cast(0 AS double) - l_discount AS x FROM lineitem UNION ALL SELECT value AS x FROM events)""",
    "observations": f"WITH {_PLACED} SELECT date, lon, lat FROM placed",
    "daily_locations": f"""WITH {_PLACED}
SELECT date, count(DISTINCT (lon, lat)) AS n_locations FROM placed GROUP BY date""",
    "location_days": f"WITH {_PLACED} SELECT DISTINCT date, lon, lat FROM placed",
    "canonical_pairs": f"""WITH {_PLACED}, obs AS (SELECT DISTINCT date, lon, lat FROM placed), both_orders AS (
  SELECT a.lon < b.lon OR (a.lon = b.lon AND a.lat < b.lat) AS sorted,
         a.lon AS alon, a.lat AS alat, b.lon AS blon, b.lat AS blat
  FROM obs a JOIN obs b ON a.date = b.date AND (a.lon <> b.lon OR a.lat <> b.lat))
SELECT CASE WHEN sorted THEN alon ELSE blon END AS lon1, CASE WHEN sorted THEN alat ELSE blat END AS lat1,
       CASE WHEN sorted THEN blon ELSE alon END AS lon2, CASE WHEN sorted THEN blat ELSE alat END AS lat2,
       count(*) // 2 AS n
FROM both_orders GROUP BY 1, 2, 3, 4""",
    "pair_days": f"""{_with_pairs()}
SELECT date, count(*) AS n_pairs, {_TENTHS_SQL}
FROM pairs GROUP BY date""",
    "pair_stats": _stats_sql(),
    "top_pair": _TOP_SQL,
    "top_pair_join": _TOP_SQL,
    "top_pair_array": _TOP_SQL,
    "top_pair_blocked": _TOP_SQL,
    "top_pair_prefix": _TOP_SQL,
    "top_pair_rounds": _TOP_SQL,
    "ranked_pairs": f"""SELECT *, row_number() OVER ({_BEST_FIRST}) AS rank
FROM ({_stats_sql()} {_BEST_FIRST} LIMIT {RANKED_K})""",
    "top_k_pairs": f"""SELECT *, row_number() OVER ({_BEST_FIRST}) AS rank
FROM ({_stats_sql()} {_BEST_FIRST} LIMIT {TOP_K})""",
    "tied_winners": f"""WITH stats AS ({_stats_sql()})
SELECT lon1, lat1, lon2, lat2, n_days FROM stats WHERE n_days = (SELECT max(n_days) FROM stats)""",
    "replicate_weak": f"WITH {_PLACED} {_REPLICAS}",
    "top_pair_weak": f"{_stats_sql(_REPLICAS)} {_BEST_FIRST} LIMIT 1",
    "solution_report": f"""WITH best AS ({_TOP_SQL})
SELECT printf('Pair:    (lon=%.1f, lat=%.1f) -> (lon=%.1f, lat=%.1f)', lon1, lat1, lon2, lat2) AS pair_line,
       'Times:   ' || times AS times_line FROM best""",
    "metrics_long": f"{_metrics_sql()} SELECT * FROM long",
    "metrics_dimensions": f"""{_metrics_sql()} SELECT DISTINCT 'solver' AS dimension, solver AS value FROM metrics
UNION ALL SELECT DISTINCT 'workers', cast(workers AS varchar) FROM metrics""",
    "metrics_summary": f"""{_metrics_sql()} SELECT workers, solver, partition_multiplier,
  round(mean_time, 6) AS mean_time, round(std_time, 6) AS std_time FROM summary""",
    "metrics_merged": f"""{_metrics_sql()} SELECT workers, solver, partition_multiplier,
  round(mean_time, 6) AS mean_time, round(std_time, 6) AS std_time FROM summary""",
    "speedup": f"""{_metrics_sql()} SELECT {_SERIES}, round(baseline / mean_time, 6) AS speedup
FROM based WHERE workers <> 2""",
    "strong_efficiency": f"""{_metrics_sql()}
SELECT {_SERIES}, round(baseline / mean_time / (workers / cast(2 AS double)), 6) AS efficiency
FROM based WHERE workers <> 2""",
    "weak_efficiency": f"""{_metrics_sql(weak=True)}
SELECT {_SERIES}, workers / cast(2 AS double) AS workload_scale, round(baseline / mean_time, 6) AS efficiency
FROM based WHERE baseline IS NOT NULL""",
    "weak_missing_baseline": f"""{_metrics_sql(weak=True)}
SELECT DISTINCT solver, partition_multiplier FROM based WHERE baseline IS NULL""",
    "weak_peak": f"""{_metrics_sql(weak=True)}
SELECT max(round(baseline / mean_time, 6)) AS max_efficiency FROM based WHERE baseline IS NOT NULL""",
    "best_config": f"""{_metrics_sql()} SELECT workers, solver, partition_multiplier,
  round(mean_time, 6) AS mean_time, round(std_time, 6) AS std_time
FROM (SELECT * FROM summary ORDER BY mean_time, workers, solver, partition_multiplier LIMIT 1)""",
    "log_elapsed": r"""SELECT event_id, try_cast(regexp_extract(
  'run ' || event_id || chr(10) || 'Elapsed time: ' || value || ' seconds' || chr(10),
  'Elapsed time:[ \t]*(\S+)', 1) AS double) AS elapsed FROM events""",
    "log_run_keys": """SELECT event_id, 'Solver' || cast(1 + user_id % 5 AS varchar) AS solver,
  cast(2 + event_id % 3 AS integer) AS multiplier, strftime(ts, '%Y%m%d_%H%M%S') AS stamp FROM events""",
    "results_upsert": _upsert_sql(),
    "results_in_place": _upsert_sql(),
    "event_rejects": f"""WITH {_EVENTS}, checked AS (
  SELECT CASE WHEN latitude <> 12.5 THEN substring(date, 1, 10) END AS date,
         CASE WHEN latitude = 12.5 OR longitude > 170 THEN 'rejected' ELSE 'usable' END AS status FROM quakes)
SELECT date, status, count(*) AS n FROM checked GROUP BY date, status""",
}

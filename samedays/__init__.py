"""Which two places are active on the same day most often?

Everything takes and returns Spark DataFrames; nothing here collects data.
"""

from samedays.operators.observations import daily_locations, observations, split_rejects
from samedays.operators.pairing import pair_days, pair_stats
from samedays.operators.ranking import rank_pairs, tied_winners, top_pairs
from samedays.operators.replication import replicate
from samedays.operators.results import results_upsert
from samedays.operators.scaling import (
    best_config,
    metrics_dimensions,
    metrics_long,
    metrics_summary,
    speedup,
    strong_efficiency,
    weak_efficiency,
    weak_missing_baseline,
)
from samedays.sources.events import read_events, read_observations
from samedays.sources.logs import log_elapsed
from samedays.sources.metrics import read_metrics, read_results

__all__ = [
    "best_config",
    "daily_locations",
    "log_elapsed",
    "metrics_dimensions",
    "metrics_long",
    "metrics_summary",
    "observations",
    "pair_days",
    "pair_stats",
    "rank_pairs",
    "read_events",
    "read_metrics",
    "read_observations",
    "read_results",
    "replicate",
    "results_upsert",
    "speedup",
    "split_rejects",
    "strong_efficiency",
    "tied_winners",
    "top_pairs",
    "weak_efficiency",
    "weak_missing_baseline",
]

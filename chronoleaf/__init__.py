"""chronoleaf: point-in-time feature engineering on Spark.

Rolling time-range features, keyed feature tables, point-in-time (as-of)
training sets, streaming upserts, latest-value snapshots, on-demand distance
features and distributed model training/scoring, all as DataFrame,
Structured Streaming and Spark ML plans.
"""

from chronoleaf.operators.asof import asof_join
from chronoleaf.operators.latest import latest_per_key
from chronoleaf.operators.lookup import online_lookup, static_lookup
from chronoleaf.operators.rolling import Rolling, rolling_aggregate, rolling_count, rolling_sum
from chronoleaf.operators.split import hash_split, time_split
from chronoleaf.operators.stats import accuracy, duplicate_keys, exact_medians, fill_median
from chronoleaf.plans.catalog import FeatureCatalog
from chronoleaf.plans.model import ModelRegistry, OnDemandModel, threshold_predictions
from chronoleaf.plans.ondemand import add_distance
from chronoleaf.plans.training import Lookup, TrainingSet, create_training_set

__version__ = "0.1.0"

__all__ = [
    "FeatureCatalog", "Lookup", "ModelRegistry", "OnDemandModel", "Rolling", "TrainingSet",
    "accuracy", "add_distance", "asof_join", "create_training_set", "duplicate_keys",
    "exact_medians", "fill_median", "hash_split", "latest_per_key", "online_lookup",
    "rolling_aggregate", "rolling_count", "rolling_sum", "static_lookup", "threshold_predictions",
    "time_split",
]

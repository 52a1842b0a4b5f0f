"""Settings of the trip analysis, passed explicitly to every job."""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict, dataclass

# --- fixed values: column lists, feature sets, search grids -----------------
KEEP_COLUMNS = (
    "VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime", "passenger_count",
    "trip_distance", "RatecodeID", "PULocationID", "DOLocationID", "fare_amount",
    "extra", "mta_tax", "improvement_surcharge", "congestion_surcharge", "cbd_congestion_fee",
)
FEE_COLUMNS = ("extra", "mta_tax", "improvement_surcharge", "congestion_surcharge", "cbd_congestion_fee")
TARGET = "fare_amount"

FEATURE_SETS = {
    "FULL": {
        "features": ("trip_distance", "hour", "day of week", "is weekend", "passenger_count",
                     "PU_fare_avg", "DO_fare_avg", "route_avg_speed", "pickup_cluster",
                     "route_popularity", "is_night_fare", "is_rush_hour", "is_holiday"),
        "log": ("trip_distance",),
        "cyclic": (("hour", 24), ("day of week", 7)),
        "passthrough": ("passenger_count", "is weekend", "PU_fare_avg", "DO_fare_avg", "route_avg_speed",
                        "pickup_cluster", "route_popularity", "is_night_fare", "is_rush_hour", "is_holiday"),
    },
    "XGB_95": {
        "features": ("trip_distance", "hour", "PU_fare_avg", "DO_fare_avg", "route_avg_speed",
                     "pickup_cluster", "route_popularity", "is_night_fare", "is weekend", "is_holiday"),
        "log": ("trip_distance",),
        "cyclic": (("hour", 24),),
        "passthrough": ("is weekend", "PU_fare_avg", "DO_fare_avg", "route_avg_speed",
                        "pickup_cluster", "route_popularity", "is_night_fare", "is_holiday"),
    },
    "RF_95": {
        "features": ("trip_distance", "route_popularity", "route_avg_speed"),
        "log": ("trip_distance",),
        "cyclic": (),
        "passthrough": ("route_avg_speed", "route_popularity"),
    },
}

# Search grids under Spark's parameter names. Two knobs of the usual grids have
# no Spark counterpart and are left out: the least number of rows to split a
# node of a forest, and the L2 penalty on the leaves of boosted trees.
FOREST_GRID = {
    "numTrees": (200, 300, 500),
    "maxDepth": (10, 15, 20),
    "minInstancesPerNode": (1, 2, 4),
    "featureSubsetStrategy": ("1", "0.8"),  # "1" = one feature, "0.8" = a fraction
}
BOOST_GRID = {
    "maxIter": (200, 400, 600),
    "maxDepth": (4, 6, 8),
    "stepSize": (0.03, 0.05, 0.1),
    "subsamplingRate": (0.7, 0.8, 1.0),
    "featureSubsetStrategy": ("0.7", "0.8", "all"),
}
# Shallow grids of the first comparison.
FOREST_QUICK_GRID = {"maxDepth": (10, 15), "minInstancesPerNode": (5, 10)}
BOOST_QUICK_GRID = {"maxDepth": (6, 8), "stepSize": (0.05, 0.1)}
# --- end of fixed values ------------------------------------------------------


@dataclass(frozen=True)
class Config:
    """What one analysis run depends on; hashed into the key of cached tables."""

    keep_columns: tuple = KEEP_COLUMNS
    fee_columns: tuple = FEE_COLUMNS
    optional_fees: tuple = ()
    home_borough: str | None = "Manhattan"
    max_fare: float = 50.0
    target: str = TARGET
    feature_mode: str = "RF_95"
    test_percent: int = 20
    holdout_percent: int = 15
    folds: int = 5
    seed: int = 42
    contamination: float = 0.01
    outlier_fit_on: str = "all"      # or "train"
    zone_clusters: int = 15
    cluster_rounds: int = 20
    balance: bool = True
    balance_target: int = 30_000
    legacy_folds: bool = False
    approx_medians: bool = False

    def __post_init__(self):
        if self.feature_mode not in FEATURE_SETS:
            raise ValueError(f"feature_mode must be one of {sorted(FEATURE_SETS)}, not {self.feature_mode!r}")
        if self.outlier_fit_on not in ("all", "train"):
            raise ValueError("outlier_fit_on must be 'all' or 'train'")

    @property
    def features(self) -> tuple:
        return FEATURE_SETS[self.feature_mode]["features"]

    @property
    def log_features(self) -> tuple:
        return FEATURE_SETS[self.feature_mode]["log"]

    @property
    def cyclic_features(self) -> tuple:
        return FEATURE_SETS[self.feature_mode]["cyclic"]

    @property
    def passthrough_features(self) -> tuple:
        return FEATURE_SETS[self.feature_mode]["passthrough"]

    @property
    def required_columns(self) -> tuple:
        return tuple(c for c in self.keep_columns if c not in self.optional_fees)

    def key(self) -> str:
        """Short digest that changes with any setting."""
        text = json.dumps(asdict(self), sort_keys=True, default=str)
        return hashlib.md5(text.encode()).hexdigest()[:16]

"""Exploration of the trips: data behind every figure and statistic."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ride_analytics.config import Config
from ride_analytics.functions import columns as X
from ride_analytics.functions.bins import DISTANCE_BINS, BinSpec
from ride_analytics.operators import histograms as H
from ride_analytics.operators import screening as SC
from ride_analytics.operators import summaries as S
from ride_analytics.operators.cleaning import clean_trips, in_borough
from ride_analytics.operators.isolation_forest import fit_outliers
from ride_analytics.operators.quantiles import describe
from ride_analytics.operators.sampling import paired_outlier_sample
from ride_analytics.sources.storage import written

# Columns tested for being (nearly) constant.
SCREENED = ("passenger_count", "trip_distance", "hour", "day of week", "is weekend", "is_night_fare", "is_rush_hour",
            "is_holiday", "extra", "mta_tax", "improvement_surcharge", "congestion_surcharge", "cbd_congestion_fee")


@dataclass
class Exploration:
    """One written table with flags; the stages are filters on it."""

    trips: DataFrame
    zones: DataFrame
    cfg: Config

    @property
    def city(self) -> DataFrame:
        return self.trips

    @property
    def borough(self) -> DataFrame:
        return self.trips.where("in_borough")

    @property
    def clean(self) -> DataFrame:
        return self.trips.where(F.col("in_borough") & ~F.col("is outlier"))


def explore(trips: DataFrame, zones: DataFrame, holidays: DataFrame, cfg: Config, spec: BinSpec = DISTANCE_BINS,
            path: str | None = None) -> Exploration:
    """Clean trips of all boroughs with duration, borough flag, outlier flag (by a
    forest grown on the borough), distance range, fare per mile and zone fare."""
    everywhere = Config(**{**cfg.__dict__, "home_borough": None})
    home = F.lit(True) if cfg.home_borough is None else F.coalesce(in_borough(cfg.home_borough), F.lit(False))
    staged = (clean_trips(trips, zones, holidays, everywhere)
              .withColumn("trip_duration_min", X.duration_minutes("tpep_pickup_datetime", "tpep_dropoff_datetime"))
              .withColumn("in_borough", home))
    staged = written(staged, "staged-trips")      # the forest, its cut-off and the flags read it; the joins run once
    forest = fit_outliers(staged.where("in_borough"), cfg.contamination, cfg.seed)
    flagged = forest.transform_repeated(staged).withColumn("is outlier", F.col("in_borough") & F.col("is outlier")).drop("outlier score")
    stored = written(S.with_distance_bin(flagged, spec).withColumn(
        "fare per mile", X.ratio(F.col("fare_amount"), F.col("trip_distance"))), "explored", path)
    kept = stored.where(F.col("in_borough") & ~F.col("is outlier"))
    zone_fare = written(S.mean_fare_by_zone(kept, "PULocationID", "PU_fare_avg"), "zone-fare")
    return Exploration(stored.join(zone_fare, "PULocationID", "left"), zones, cfg)


def figures(e: Exploration, sample: int = 50_000, spec: BinSpec = DISTANCE_BINS) -> dict[str, DataFrame]:
    """The data set behind every figure."""
    clean = e.clean
    return {
        "pickup_volume": S.location_volume(e.city, "PULocationID"),
        "dropoff_volume": S.location_volume(e.city, "DOLocationID"),
        "borough_volume": S.borough_volume(e.city),
        "zone_demand": S.zone_demand(clean, e.zones, e.cfg.home_borough),
        "outliers_before": outlier_scatter(e, sample),
        "fare_range": S.value_range(clean, "fare_amount"),
        "fare_histogram": H.histogram(clean, "fare_amount"),
        "fare_density": H.density_curve(clean, "fare_amount"),
        "fare_per_mile": S.fare_per_mile_by_distance(clean, spec),
        "fare_heatmap": S.fare_heatmap(clean),
        "distance_counts": S.distance_bin_counts(clean, spec),
        "fee_incidence": S.fee_incidence(clean, e.cfg.fee_columns),
        "fare_boxes": S.fare_boxes_by_distance(clean, spec),
        "hourly_volume": S.hourly_volume(clean),
        "zone_map": S.zone_map_table(clean, e.zones, e.cfg.home_borough),
    }


def outlier_scatter(e: Exploration, sample: int = 50_000, low: float = 1.0, high: float = 20.0) -> DataFrame:
    """Inliers and one hundredth as many outliers, with the clipped fare per mile."""
    return paired_outlier_sample(e.borough, sample).select(
        "row_key", "trip_duration_min", "fare_amount", "is outlier",
        X.clip(F.col("fare per mile"), low, high).alias("fare per mile"))


def statistics(e: Exploration, spec: BinSpec = DISTANCE_BINS) -> dict[str, DataFrame]:
    """Row counts by stage, descriptions, and shares."""
    stages = e.trips.agg(F.count(F.lit(1)).alias("integrity"), F.count_if("in_borough").alias("borough"),
                         F.count_if(F.col("in_borough") & ~F.col("is outlier")).alias("outliers removed"))
    return {
        "funnel": stages.unpivot([], [f"`{c}`" for c in stages.columns], "step", "n")
                        .withColumn("step", F.replace("step", F.lit("`"), F.lit(""))),
        "description": describe(e.clean, ["fare_amount", "trip_duration_min"]),
        "distance_shares": S.distance_bin_share(e.clean, spec),
        "borough_shares": S.borough_share(e.city),
    }


def screen(e: Exploration, threshold: float = 0.95, candidates=SCREENED) -> dict[str, DataFrame]:
    """Constancy scan, then correlations and components of what it keeps."""
    scan = SC.quasi_constant_scan(e.clean, candidates, threshold)
    active = SC.active_features(scan, candidates, always=["PU_fare_avg"])
    model = SC.fit_components(e.clean, active)
    return {
        "scan": scan,
        "correlations": SC.correlation_matrix(e.clean, active, display=True),
        "components": SC.component_shares(e.clean, active, 0.99, model),
        "loadings": SC.component_loadings(e.clean, active, model),
        "scores": SC.component_scores(e.clean, active, model=model),
    }

"""How models of one period do on a later one."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from ride_analytics.config import Config
from ride_analytics.operators import diagnostics as D
from ride_analytics.operators import histograms as H
from ride_analytics.operators.cleaning import clean_trips
from ride_analytics.operators.feature_tables import FeatureTables, apply_feature_tables
from ride_analytics.operators.metrics import compare_runs, to_long
from ride_analytics.plans.prepare import model_columns, model_rows, without_outliers
from ride_analytics.plans.training import evaluate
from ride_analytics.sources.storage import written


def later_period(trips: DataFrame, zones: DataFrame, holidays: DataFrame, tables: FeatureTables, cfg: Config) -> DataFrame:
    """Later trips, cleaned with a forest of their own, with the features of the
    period the models were trained on."""
    clean = written(model_rows(clean_trips(trips, zones, holidays, cfg), cfg), "later-trips")     # the forest and the flags read it
    kept, _ = without_outliers(clean, cfg)
    return written(model_columns(apply_feature_tables(kept, tables), cfg), "later-features")


def drift_test(later: DataFrame, models: dict[str, PipelineModel], baseline: DataFrame, cfg: Config) -> dict:
    """Metrics against the baseline run (long form), and per model the density of
    predictions, the residual trend and the error by hour and weekday."""
    new = to_long(written(evaluate(models, later, cfg), "drift-metrics"))
    out = {"comparison": compare_runs(new, baseline)}
    for name, model in models.items():
        scored = written(model.transform(later).select(*later.columns, "prediction"), "later-scored")
        out[name] = {"actual_vs_predicted": H.hexagons(scored, cfg.target, "prediction", 60),
                     "trend": D.residual_trend(scored, cfg.target),
                     "error_heatmap": D.error_heatmap_hour_weekday(scored, cfg.target)}
    return out

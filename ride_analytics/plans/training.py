"""Compare, tune, evaluate and diagnose models."""

from __future__ import annotations

from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ride_analytics.config import BOOST_GRID, FOREST_GRID, Config
from ride_analytics.functions.columns import residual
from ride_analytics.models import estimators, importance, tuning
from ride_analytics.operators import diagnostics as D
from ride_analytics.operators import histograms as H
from ride_analytics.operators.metrics import regression_metrics, to_long
from ride_analytics.operators.sampling import sample_rows
from ride_analytics.plans.prepare import Prepared
from ride_analytics.sources.storage import append_metrics, load_or_tune, written


def evaluate(models: dict[str, PipelineModel], test: DataFrame, cfg: Config) -> DataFrame:
    """One metrics row per model on the same rows."""
    rows = [regression_metrics(written(m.transform(test).select(cfg.target, "prediction"), "predictions"), cfg.target, model=name)
            for name, m in models.items()]
    return reduce(DataFrame.unionByName, rows)


def train_and_evaluate(data: Prepared, cfg: Config, root: str, run: str = "baseline", models: dict | None = None,
                       forest_grid: dict = FOREST_GRID, boost_grid: dict = BOOST_GRID, forest_rows: int = 150_000,
                       quick_rows: int = 20_000, **boost) -> tuple[dict, dict[str, PipelineModel]]:
    """Quick comparison, deep tuning of forest and boosted trees (or their saved
    models), metrics of both on the test part, in the metrics table.

    The forest's grid is searched on ``forest_rows`` rows; the best point is
    then fitted on all rows.
    """
    spark = data.train.sparkSession
    shoot_out = tuning.quick_comparison(models or estimators.default_models(cfg), data.train, cfg, quick_rows)
    seen = (cfg.key(), data.root)

    def tune_forest():
        part = written(sample_rows(data.train, forest_rows).repartition(spark.sparkContext.defaultParallelism), "forest-rows")
        _, best = tuning.tune_forest(estimators.random_forest(cfg), forest_grid, part, cfg)
        return estimators.fit_stored(tuning.with_params(estimators.random_forest(cfg), best), data.train), best

    forest, forest_params = load_or_tune(spark, root, "random_forest", tune_forest, (*seen, forest_grid, forest_rows))
    boosted, boost_params = load_or_tune(
        spark, root, "boosted_trees",
        lambda: tuning.tune_boosting(estimators.boosted_trees(cfg), boost_grid, data.train, cfg, **boost), (*seen, boost_grid, boost))
    fitted = {"Random Forest": forest, "Boosted Trees": boosted}
    metrics = written(evaluate(fitted, data.test, cfg), "metrics")
    append_metrics(to_long(metrics), f"{root}/metrics", run)
    return {"quick_comparison": shoot_out, "metrics": metrics,
            "params": {"Random Forest": forest_params, "Boosted Trees": boost_params}}, fitted


def diagnose(models: dict[str, PipelineModel], data: Prepared, cfg: Config) -> dict[str, dict[str, DataFrame]]:
    """Per model: densities, residual ranges, worst trips, error maps, zones."""
    out = {}
    for name, model in models.items():
        scored = written(model.transform(data.test).select(*data.test.columns, "prediction"), "scored")
        part = scored.withColumn("residual", residual(cfg.target, "prediction"))
        out[name] = {
            "actual_vs_predicted": H.hexagons(part, cfg.target, "prediction", 60),
            "residual_histogram": H.histogram(part, "residual"),
            "residual_density": H.density_curve(part, "residual"),
            "predicted_vs_residual": H.hexagons(part, "prediction", "residual", 50),
            "residual_boxes": D.residual_boxes_by_fare(scored, cfg.target),
            "accuracy_by_fare": D.accuracy_by_fare_class(scored, cfg.target),
            "worst_trips": D.worst_predictions(scored, label=cfg.target),
            "error_heatmap": D.error_heatmap_distance_hour(scored, cfg.target),
            "error_by_distance": D.error_by_distance_bin(scored, label=cfg.target),
            **zone_error_report(scored, cfg),
        }
    return out


def explain(linear: PipelineModel, trees: dict[str, PipelineModel], data: Prepared, cfg: Config) -> dict[str, DataFrame]:
    """Importances of all models on one scale and the features that suffice."""
    spark = data.test.sparkSession
    tables = [importance.linear_importances(linear, data.test, cfg)]
    tables += [importance.native_importances(spark, m, cfg, name) for name, m in trees.items()]
    both = importance.combined_importances(tables)
    return {"importances": both,
            "sufficient": importance.sufficient_features(both.where(F.col("Model") != "Linear Baseline"))}


def zone_error_report(scored: DataFrame, cfg: Config, top: int = 15, least: int = 500) -> dict[str, DataFrame]:
    """Zone summary with its rankings, and errors by fare range."""
    summary = written(D.zone_error_summary(scored, cfg.target), "zone-errors")
    return {
        "zone_summary": summary,
        "top_mae_zones": D.top_zones(summary, "mae", top),
        "top_underpredicted_zones": D.top_zones(summary, "under", top),
        "top_overpredicted_zones": D.top_zones(summary, "over", top),
        "supported_zones": D.supported_zones(summary, least),
        "support_groups": D.support_group_counts(summary),
        "mae_by_fare_bin": D.error_by_fare_bin(scored, label=cfg.target),
    }

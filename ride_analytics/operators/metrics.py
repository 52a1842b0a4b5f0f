"""Regression metrics as tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ride_analytics.functions import columns as X
from ride_analytics.operators.joins import null_safe_join
from ride_analytics.operators.quantiles import grouped_median
from ride_analytics.sources.storage import written

METRICS = ("Accuracy (%)", "MAE", "MedAE", "RMSE", "R²")


def accuracy(mape: Column) -> Column:
    """Percent; an error of 100 % or more is 0, never below."""
    return (1.0 - F.least(mape, F.lit(1.0))) * 100.0


def regression_metrics(df: DataFrame, label: str = "fare_amount", prediction: str = "prediction",
                       groups: Sequence[str] = (), model: str | None = None, approx: bool = False) -> DataFrame:
    """Accuracy, MAE, median error, RMSE and R², one row per group.

    All but the median come from one aggregate; R² is null when the label is
    constant. The rows' errors are written once, so ``df`` is evaluated once.
    """
    groups = list(groups)
    err = df.select(*[F.col(f"`{g}`") for g in groups], F.col(f"`{label}`").alias("_label"), X.absolute_error(label, prediction).alias("_ae"),
                    X.percentage_error(label, prediction).alias("_pe"))
    err = err if approx else written(err, "errors")
    basic = err.groupBy(*groups).agg(
        accuracy(F.avg("_pe")).alias("Accuracy (%)"),
        F.avg("_ae").alias("MAE"),
        F.sqrt(F.avg(F.col("_ae") * F.col("_ae"))).alias("RMSE"),
        (1.0 - F.try_divide(F.sum(F.col("_ae") * F.col("_ae")), F.count("_ae") * F.var_pop("_label"))).alias("R²"))
    if groups:
        out = null_safe_join(basic, grouped_median(err, groups, "_ae", "MedAE", approx=approx, stored=True), groups, "left")
    else:
        median = grouped_median(err, [], "_ae", "MedAE", approx=approx, stored=True).select("MedAE").scalar()
        out = basic.withColumn("MedAE", median)
    names = [F.lit(model).alias("Model")] if model is not None else []
    return out.select(*names, *[F.col(f"`{g}`") for g in groups], *[F.col(f"`{m}`") for m in METRICS])


def metrics_by_sets(df: DataFrame, sets: Sequence[Sequence[str]], label: str = "fare_amount", prediction: str = "prediction",
                    approx: bool = False) -> DataFrame:
    """All metrics over several groupings at once: grouping (names joined by a comma), its columns (null where not in it) and the metrics.

    ``df`` holds the predictions of all models and periods, a row each. It is
    evaluated once; each row is expanded to its groupings and the groups merge map-side, in one aggregate and one median.
    """
    names = list(dict.fromkeys(g for own in sets for g in own))
    types = dict(df.dtypes)
    if not sets:
        raise ValueError("no grouping")

    def entry(own):
        cells = [(F.col(f"`{g}`") if g in own else F.lit(None).cast(types[g])).alias(g) for g in names]
        return F.struct(F.lit(",".join(own)).alias("grouping"), *cells)

    rows = df.select(F.explode(F.array(*[entry(list(own)) for own in sets])).alias("_set"), F.col(f"`{label}`").alias("_y"), F.col(f"`{prediction}`").alias("_p"))
    return regression_metrics(rows.select("_set.*", "_y", "_p"), "_y", "_p", ["grouping", *names], approx=approx)


def to_long(metrics: DataFrame, model: str = "Model") -> DataFrame:
    """One row per model and metric."""
    return metrics.select(F.col(model).alias("model"), *[F.col(f"`{m}`") for m in METRICS]).unpivot(
        ["model"], [f"`{m}`" for m in METRICS], "metric", "value").select(
        "model", F.replace("metric", F.lit("`"), F.lit("")).alias("metric"), "value")


def compare_runs(new: DataFrame, old: DataFrame) -> DataFrame:
    """Baseline and new value of every metric, matched by exact name, and the
    change; null where the model has no baseline."""
    before = old.select("model", "metric", F.col("value").alias("baseline"))
    return (new.select("model", "metric", F.col("value").alias("current"))
               .join(before, ["model", "metric"], "left")
               .withColumn("delta", F.col("current") - F.col("baseline")))


def improvement_over(metrics: DataFrame, baseline_model: str, metric: str = "MAE") -> DataFrame:
    """Percent by which each model's error is below the baseline model's."""
    base = metrics.where((F.col("model") == baseline_model) & (F.col("metric") == metric)).select("value").scalar()
    return (metrics.where(F.col("metric") == metric)
                   .select("model", "metric", "value", (F.try_divide(base - F.col("value"), base) * 100).alias("improvement_pct")))

"""Where predictions go wrong: by zone, fare, distance and time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ride_analytics.functions import columns as X
from ride_analytics.functions.bins import (DISTANCE_BINS, FARE_CLASSES_LONG, FARE_ERROR_BINS, SUPPORT_GROUPS, BinSpec)
from ride_analytics.operators.metrics import accuracy
from ride_analytics.operators.ordering import rolling_mean
from ride_analytics.operators.quantiles import box_statistics, grouped_median

ZONE = "PULocationID"


def with_errors(df: DataFrame, label: str = "fare_amount", prediction: str = "prediction") -> DataFrame:
    return df.withColumns({"residual": X.residual(label, prediction), "abs_error": X.absolute_error(label, prediction)})


def zone_error_summary(df: DataFrame, label: str = "fare_amount", prediction: str = "prediction",
                       support: BinSpec = SUPPORT_GROUPS, approx: bool = False) -> DataFrame:
    """One row per pickup zone: mean fares, bias, errors and support."""
    err = with_errors(df, label, prediction)
    basic = err.groupBy(ZONE).agg(
        F.avg(label).alias("avg_actual_fare"), F.avg(prediction).alias("avg_pred_fare"),
        F.avg("residual").alias("mean_residual"), F.avg("abs_error").alias("mae"),
        F.count(F.lit(1)).alias("n_trips"))
    median = grouped_median(err, [ZONE], "abs_error", "median_ae", approx=approx)
    return basic.join(median, ZONE, "left").select(
        ZONE, "avg_actual_fare", "avg_pred_fare", "mean_residual", "mae", "median_ae", "n_trips",
        F.abs("mean_residual").alias("abs_mean_residual"), support.label(F.col("n_trips")).alias("support_group"))


def top_zones(summary: DataFrame, by: str, n: int = 15) -> DataFrame:
    """``by``: 'mae', 'under' (predicted too low) or 'over' (too high)."""
    order = {"mae": F.desc("mae"), "under": F.desc("mean_residual"), "over": F.asc("mean_residual")}[by]
    return summary.orderBy(order, ZONE).limit(n)


def supported_zones(summary: DataFrame, least: int = 500) -> DataFrame:
    return (summary.where(F.col("n_trips") >= least)
                   .select(ZONE, "mean_residual", "mae", "n_trips").orderBy(F.desc("mean_residual"), ZONE))


def support_group_counts(summary: DataFrame, support: BinSpec = SUPPORT_GROUPS) -> DataFrame:
    per = summary.groupBy("support_group").agg(F.count(F.lit(1)).alias("zones"), F.sum("n_trips").alias("trips"))
    out = support.table(summary.sparkSession, "support_group", "bin_order").join(per, "support_group", "left")
    return out.select("support_group", "bin_order", F.coalesce("zones", F.lit(0).cast("bigint")).alias("zones"),
                      F.coalesce("trips", F.lit(0).cast("bigint")).alias("trips"))


def support_vs_error(summary: DataFrame) -> DataFrame:
    return summary.select(ZONE, "n_trips", "mae", "abs_mean_residual", "support_group")


def error_by_bin(df: DataFrame, spec: BinSpec, value: str, label: str = "fare_amount",
                 prediction: str = "prediction", name: str = "bin") -> DataFrame:
    """Mean and median error per range of ``value``; an empty range stays with
    ``n = 0`` and null errors."""
    err = with_errors(df, label, prediction).withColumn(name, spec.label(F.col(value))).where(F.col(name).isNotNull())
    basic = err.groupBy(name).agg(F.avg("abs_error").alias("mae"), F.count(F.lit(1)).alias("n"))
    per = basic.join(grouped_median(err, [name], "abs_error", "median_ae"), name, "left")
    return (spec.table(df.sparkSession, name, "bin_order").join(per, name, "left")
                .select(name, "bin_order", "mae", "median_ae", F.coalesce("n", F.lit(0).cast("bigint")).alias("n"))
                .orderBy("bin_order"))


def error_by_fare_bin(df: DataFrame, **kw) -> DataFrame:
    return error_by_bin(df, FARE_ERROR_BINS, kw.get("label", "fare_amount"), name="fare_bin", **kw)


def error_by_distance_bin(df: DataFrame, **kw) -> DataFrame:
    return error_by_bin(df, DISTANCE_BINS, "trip_distance", name="distance_bin", **kw)


def residual_boxes_by_fare(df: DataFrame, label: str = "fare_amount", prediction: str = "prediction",
                           spec: BinSpec = FARE_CLASSES_LONG) -> DataFrame:
    err = with_errors(df, label, prediction).withColumns(
        {"fare_bin": spec.label(F.col(label)), "bin_order": spec.ordinal(F.col(label))})
    return box_statistics(err.where(F.col("fare_bin").isNotNull()), ["fare_bin", "bin_order"], "residual")


def accuracy_by_fare_class(df: DataFrame, label: str = "fare_amount", prediction: str = "prediction",
                           spec: BinSpec = FARE_CLASSES_LONG) -> DataFrame:
    tagged = df.withColumns({"fare_bin": spec.label(F.col(label)), "_ape": X.percentage_error(label, prediction)})
    per = tagged.groupBy("fare_bin").agg(accuracy(F.avg("_ape")).alias("accuracy_pct"), F.count(F.lit(1)).alias("n"))
    return (spec.table(df.sparkSession, "fare_bin", "bin_order").join(per, "fare_bin", "left")
                .select("fare_bin", "bin_order", "accuracy_pct", F.coalesce("n", F.lit(0).cast("bigint")).alias("n")))


def error_heatmap_distance_hour(df: DataFrame, label: str = "fare_amount", prediction: str = "prediction",
                                spec: BinSpec = DISTANCE_BINS) -> DataFrame:
    """Mean absolute error: a row per distance range, a column per hour."""
    err = with_errors(df, label, prediction).withColumn("dist_bin", spec.label(F.col("trip_distance")))
    return (err.where(F.col("dist_bin").isNotNull()).groupBy("dist_bin")
               .pivot("hour", list(range(24))).agg(F.avg("abs_error")))


def error_heatmap_hour_weekday(df: DataFrame, label: str = "fare_amount", prediction: str = "prediction") -> DataFrame:
    """Mean absolute error: a row per hour, a named column per weekday."""
    err = with_errors(df, label, prediction).withColumn("_day", X.weekday_name(F.col("day of week")))
    return err.groupBy("hour").pivot("_day", list(X.WEEKDAYS)).agg(F.avg("abs_error"))


def worst_predictions(df: DataFrame, n: int = 15, label: str = "fare_amount", prediction: str = "prediction",
                      key: str = "row_key") -> DataFrame:
    """The ``n`` largest errors, smallest of them first, tagged and labelled."""
    err = with_errors(df, label, prediction)
    worst = err.orderBy(F.desc("abs_error"), key).limit(n)
    text = F.format_string("%.1f miles at %d h, zone mean %.1f", F.col("trip_distance"), F.col("hour"), F.col("PU_fare_avg"))
    return (worst.select(key, label, prediction, "residual", "abs_error",
                         F.when(F.col("residual") > 0, "underpriced").otherwise("overpriced").alias("direction"),
                         text.alias("trip_label"))
                 .orderBy("abs_error", key))


def residual_trend(df: DataFrame, label: str = "fare_amount", prediction: str = "prediction",
                   key: str = "row_key", rows: int = 500, block: int = 200_000) -> DataFrame:
    """Rolling mean of predicted minus actual along the actual fare."""
    drift = df.select(key, label, (-X.residual(label, prediction)).alias("drift"))
    return rolling_mean(drift, [label, key], "drift", rows, "trend", block)

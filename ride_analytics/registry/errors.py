"""Metrics and error reports on a prediction given by a formula, so that SQL can
repeat them exactly."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ride_analytics.functions.bins import DISTANCE_BINS, FARE_CLASSES_LONG, FARE_ERROR_BINS, SUPPORT_GROUPS
from ride_analytics.operators import diagnostics as D
from ride_analytics.operators import metrics as M
from ride_analytics.operators import summaries as S
from ride_analytics.registry.base import (box_sql, case_bins, city, home, query, rounded, scored, sql, values_bins,
                                          with_formula)
from ride_analytics.sources import storage
from ride_analytics.sources.trips import in_months

SUPPORT = case_bins("n_trips", SUPPORT_GROUPS)
FARE_BIN = case_bins("fare_amount", FARE_CLASSES_LONG)

_METRICS = """(1 - least(avg(ape), 1)) * 100 AS "Accuracy (%)", avg(abs_error) AS MAE, median(abs_error) AS MedAE,
  sqrt(avg(abs_error * abs_error)) AS RMSE, 1 - sum(abs_error * abs_error) / (count(*) * var_pop(fare_amount)) AS "R²" """
_NAMES = ["Accuracy (%)", "MAE", "MedAE", "RMSE", "R²"]

ZONE_SUMMARY = f"""zone_summary AS (SELECT *, {SUPPORT} AS support_group FROM (
  SELECT PULocationID, avg(fare_amount) AS avg_actual_fare, avg(prediction) AS avg_pred_fare, avg(residual) AS mean_residual,
    avg(abs_error) AS mae, median(abs_error) AS median_ae, count(*) AS n_trips, abs(avg(residual)) AS abs_mean_residual
  FROM scored GROUP BY 1))"""
_ZONE_DOUBLES = ["avg_actual_fare", "avg_pred_fare", "mean_residual", "mae", "median_ae", "abs_mean_residual"]


def summary(spark, sf):
    return D.zone_error_summary(scored(spark, sf))


@query("regression_metrics", sql(f"SELECT 'formula' AS \"Model\", {_METRICS} FROM scored", doubles=_NAMES))
def _(spark, sf):
    return rounded(M.regression_metrics(scored(spark, sf), model="formula"))


@query("regression_metrics_by_hour", sql(f'SELECT "hour", {_METRICS} FROM scored GROUP BY 1', doubles=_NAMES))
def _(spark, sf):
    return rounded(M.regression_metrics(scored(spark, sf), groups=["hour"]))


@query("zone_error_summary", sql("SELECT * FROM zone_summary", ZONE_SUMMARY, doubles=_ZONE_DOUBLES))
def _(spark, sf):
    return rounded(summary(spark, sf))


@query("csv_zone_report", sql("SELECT * FROM zone_summary", ZONE_SUMMARY, doubles=_ZONE_DOUBLES))
def _(spark, sf):
    """The zone summary as a CSV result table, read back."""
    table = summary(spark, sf)
    paths = storage.write_csv_tables({"zone_summary": table}, storage.fresh_path(spark, "zone-report"))
    return rounded(storage.read_csv(spark, paths["zone_summary"], table.schema))


@query("support_group_counts", sql("""SELECT b.support_group, b.bin_order, coalesce(z.zones, 0) AS zones, coalesce(z.trips, 0) AS trips
  FROM bins b LEFT JOIN (SELECT support_group, count(*) AS zones, CAST(sum(n_trips) AS BIGINT) AS trips FROM zone_summary GROUP BY 1) z
    ON b.support_group = z.support_group""", ZONE_SUMMARY, values_bins(SUPPORT_GROUPS, "support_group")))
def _(spark, sf):
    return D.support_group_counts(summary(spark, sf))


@query("zones_with_support", sql("SELECT PULocationID, mean_residual, mae, n_trips FROM zone_summary WHERE n_trips >= 500",
                                 ZONE_SUMMARY, doubles=["mean_residual", "mae"]))
def _(spark, sf):
    return rounded(D.supported_zones(summary(spark, sf)))


@query("zone_support_vs_error", sql("""SELECT PULocationID, n_trips, mae, abs_mean_residual, support_group FROM zone_summary""",
                                    ZONE_SUMMARY, doubles=["mae", "abs_mean_residual"]))
def _(spark, sf):
    return rounded(D.support_vs_error(summary(spark, sf)))


for _by, _order in (("mae", "mae DESC"), ("under", "mean_residual DESC"), ("over", "mean_residual")):
    @query({"mae": "top_error_zones", "under": "top_underpredicted_zones", "over": "top_overpredicted_zones"}[_by],
           sql(f"SELECT * FROM zone_summary ORDER BY {_order}, PULocationID LIMIT 15", ZONE_SUMMARY, doubles=_ZONE_DOUBLES))
    def _(spark, sf, by=_by):
        return rounded(D.top_zones(summary(spark, sf), by))


def _bin_sql(spec, value, name):
    return sql(f"""SELECT b.{name}, b.bin_order, e.mae, e.median_ae, coalesce(e.n, 0) AS n FROM bins b LEFT JOIN (
      SELECT {case_bins(value, spec)} AS {name}, avg(abs_error) AS mae, median(abs_error) AS median_ae, count(*) AS n
      FROM scored GROUP BY 1) e ON b.{name} = e.{name}""", values_bins(spec, name), doubles=["mae", "median_ae"])


@query("error_by_fare_bin", _bin_sql(FARE_ERROR_BINS, "fare_amount", "fare_bin"))
def _(spark, sf):
    """No fare is above 60 after cleaning: that range stays, empty."""
    return rounded(D.error_by_fare_bin(scored(spark, sf)))


@query("error_by_distance_bin", _bin_sql(DISTANCE_BINS, "trip_distance", "distance_bin"))
def _(spark, sf):
    return rounded(D.error_by_distance_bin(scored(spark, sf)))


@query("residual_boxes_by_fare", sql(box_sql("classed", "fare_bin, bin_order", "residual"),
    f"""classed AS (SELECT *, {FARE_BIN} AS fare_bin,
      CAST({case_bins('fare_amount', FARE_CLASSES_LONG, range(4))} AS INTEGER) AS bin_order FROM scored)""",
    doubles=["q1", "median", "q3", "whisker_low", "whisker_high"]))
def _(spark, sf):
    return rounded(D.residual_boxes_by_fare(scored(spark, sf)))


@query("accuracy_by_fare_class", sql(f"""SELECT b.fare_bin, b.bin_order, e.accuracy_pct, coalesce(e.n, 0) AS n FROM bins b
  LEFT JOIN (SELECT {FARE_BIN} AS fare_bin, (1 - least(avg(ape), 1)) * 100 AS accuracy_pct, count(*) AS n FROM scored GROUP BY 1) e
    ON b.fare_bin = e.fare_bin""", values_bins(FARE_CLASSES_LONG, "fare_bin"), doubles=["accuracy_pct"]))
def _(spark, sf):
    return rounded(D.accuracy_by_fare_class(scored(spark, sf)))


@query("error_heatmap_distance_hour", sql(f"SELECT {case_bins('trip_distance', DISTANCE_BINS)} AS dist_bin, " + ", ".join(
    f'avg(CASE WHEN "hour" = {h} THEN abs_error END) AS "{h}"' for h in range(24)) + " FROM scored GROUP BY 1",
    doubles=[str(h) for h in range(24)]))
def _(spark, sf):
    return rounded(D.error_heatmap_distance_hour(scored(spark, sf)))


_DAYS = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]


@query("error_heatmap_hour_weekday", sql('SELECT "hour", ' + ", ".join(
    f'avg(CASE WHEN "day of week" = {i} THEN abs_error END) AS "{d}"' for i, d in enumerate(_DAYS)) + " FROM scored GROUP BY 1",
    doubles=_DAYS))
def _(spark, sf):
    return rounded(D.error_heatmap_hour_weekday(scored(spark, sf)))


@query("worst_predictions", sql("""SELECT row_key, fare_amount, prediction, residual, abs_error,
    CASE WHEN residual > 0 THEN 'underpriced' ELSE 'overpriced' END AS direction,
    printf('%.1f miles at %d h, zone mean %.1f', trip_distance, "hour", PU_fare_avg) AS trip_label
  FROM scored JOIN (SELECT PULocationID AS k, avg(fare_amount) AS PU_fare_avg FROM scored GROUP BY 1) ON PULocationID = k
  ORDER BY abs_error DESC, row_key LIMIT 15""", doubles=["prediction", "residual", "abs_error"]))
def _(spark, sf):
    df = scored(spark, sf)
    zone = storage.written(S.mean_fare_by_zone(df, "PULocationID", "PU_fare_avg"), "pu-fare")
    return rounded(D.worst_predictions(df.join(zone, "PULocationID")))


@query("residual_trend", sql("""SELECT row_key, fare_amount, -residual AS drift,
  row_number() OVER (ORDER BY fare_amount, row_key) - 1 AS position,
  avg(-residual) OVER (ORDER BY fare_amount, row_key ROWS 499 PRECEDING) AS trend FROM scored""", doubles=["drift", "trend"]))
def _(spark, sf):
    return rounded(D.residual_trend(scored(spark, sf)))


# --- metrics as long tables --------------------------------------------------------
def _year(df, year):
    return df.where(in_months("tpep_pickup_datetime", [f"{year}-{m:02d}" for m in range(1, 13)]))


def _runs(spark, sf):
    """Two models on trips of two years, in long form."""
    out = []
    for year in (1996, 2000):
        df = _year(city(spark, sf), year)
        flat = M.regression_metrics(df.withColumn("prediction", F.lit(25.0)), model="flat")
        formula = M.regression_metrics(with_formula(df), model="formula")
        out.append(M.to_long(flat.unionByName(formula)))
    return out


def _year_metrics(name, year):
    """Common table with the long metrics of one year, the same two models."""
    period = f"tpep_pickup_datetime >= TIMESTAMP '{year}-01-01' AND tpep_pickup_datetime < TIMESTAMP '{year + 1}-01-01'"
    flat = """(SELECT *, fare_amount - 25 AS residual, abs(fare_amount - 25) AS abs_error,
      abs(fare_amount - 25) / greatest(abs(fare_amount), CAST(2.220446049250313e-16 AS DOUBLE)) AS ape FROM city)"""
    return f"""{name} AS (SELECT model, metric, value FROM (
        SELECT 'flat' AS model, {_METRICS} FROM {flat} WHERE {period}
        UNION ALL SELECT 'formula' AS model, {_METRICS} FROM scored WHERE {period})
      UNPIVOT (value FOR metric IN ("Accuracy (%)", "MAE", "MedAE", "RMSE", "R²")))"""


@query("metrics_long_form", sql("SELECT model, metric, value FROM old", _year_metrics("old", 1996), doubles=["value"]))
def _(spark, sf):
    return rounded(_runs(spark, sf)[0])


@query("compare_periods", sql("""SELECT n.model, n.metric, n.value AS current, o.value AS baseline, n.value - o.value AS delta
  FROM new n LEFT JOIN (SELECT * FROM old WHERE model = 'formula') o ON n.model = o.model AND n.metric = o.metric""",
    _year_metrics("old", 1996), _year_metrics("new", 2000), doubles=["current", "baseline", "delta"]))
def _(spark, sf):
    """The flat model has no baseline: its change is null."""
    old, new = _runs(spark, sf)
    return rounded(M.compare_runs(new, old.where("model = 'formula'")))


@query("improvement_over_baseline", sql("""SELECT m.model, m.metric, m.value, (b.value - m.value) / b.value * 100 AS improvement_pct
  FROM old m, (SELECT value FROM old WHERE model = 'flat' AND metric = 'MAE') b WHERE m.metric = 'MAE'""",
    _year_metrics("old", 1996), doubles=["value", "improvement_pct"]))
def _(spark, sf):
    return rounded(M.improvement_over(_runs(spark, sf)[0], "flat"))


@query("saved_metrics", sql("""SELECT model, metric, value, 'baseline' AS run FROM old
  UNION ALL SELECT model, metric, value, 'later' FROM new""", _year_metrics("old", 1996), _year_metrics("new", 2000), doubles=["value"]))
def _(spark, sf):
    root = storage.fresh_path(spark, "metrics")
    for run, table in zip(("baseline", "later"), _runs(spark, sf)):
        storage.append_metrics(table, root, run)
    return rounded(storage.load_metrics(spark, root))


@query("statistics_report", sql("""SELECT 'integrity' AS item, CAST(count(*) AS DOUBLE) AS value FROM city
  UNION ALL SELECT 'borough', CAST(count(*) AS DOUBLE) FROM home
  UNION ALL SELECT 'mean fare', avg(fare_amount) FROM home
  UNION ALL SELECT 'median fare', median(fare_amount) FROM home""", doubles=["value"]))
def _(spark, sf):
    """The lines of the text report as a table."""
    from ride_analytics.operators.quantiles import grouped_median
    parts: list[DataFrame] = [
        city(spark, sf).agg(F.lit("integrity").alias("item"), F.count(F.lit(1)).cast("double").alias("value")),
        home(spark, sf).agg(F.lit("borough").alias("item"), F.count(F.lit(1)).cast("double").alias("value")),
        home(spark, sf).agg(F.lit("mean fare").alias("item"), F.avg("fare_amount").alias("value")),
        grouped_median(home(spark, sf), [], "fare_amount", "value").select(F.lit("median fare").alias("item"), "value"),
    ]
    return rounded(reduce(DataFrame.unionByName, parts))

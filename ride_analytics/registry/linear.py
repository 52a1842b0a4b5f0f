"""Linear models by sums of products, and metrics of many models at once, with closed forms in SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ride_analytics.models import gram
from ride_analytics.models.importance import permutation_importance
from ride_analytics.operators import sampling as SA
from ride_analytics.operators.metrics import metrics_by_sets
from ride_analytics.registry.base import city, query, rounded, sql, with_formula
from ride_analytics.sources.star_trips import CHECK_CONFIG

FEATURES = ["trip_distance", "hour"]
# means and centred sums of (x, h, y) over some rows
_SUMS = """count(*) AS n, avg(x) AS mx, avg(h) AS mh, avg(y) AS my, covar_pop(x, x) AS xx, covar_pop(h, h) AS hh,
  covar_pop(x, h) AS xh, covar_pop(x, y) AS xy, covar_pop(h, y) AS hy"""
_FIT = """(xy * hh - hy * xh) / (xx * hh - xh * xh) AS bx, (hy * xx - xy * xh) / (xx * hh - xh * xh) AS bh"""
_ROWS = """r AS (SELECT trip_distance AS x, CAST("hour" AS DOUBLE) AS h, fare_amount AS y, row_key,
  CAST(CAST(concat('0x', substr(md5(concat('fold:', row_key)), 1, 8)) AS BIGINT) % 5 AS INTEGER) AS fold FROM city)"""


@query("gram_linear_coefficients", sql("""SELECT feature, CASE feature WHEN 'trip_distance' THEN bx WHEN 'hour' THEN bh ELSE my - bx * mx - bh * mh END AS coefficient
  FROM f, (VALUES ('(intercept)'), ('trip_distance'), ('hour')) AS v(feature)""", _ROWS,
    f"f AS (SELECT *, {_FIT} FROM (SELECT {_SUMS} FROM r))", doubles=["coefficient"]))
def _(spark, sf):
    return rounded(gram.linear_coefficients(city(spark, sf), FEATURES, "fare_amount"))


@query("gram_fold_errors", sql("""SELECT f.fold, CAST(0.0 AS DOUBLE) AS ridge, count(*) AS n,
    sqrt(avg((y - (my + bx * (x - mx) + bh * (h - mh))) ** 2)) AS rmse,
    1 - avg((y - (my + bx * (x - mx) + bh * (h - mh))) ** 2) / var_pop(y) AS r2
  FROM f JOIN r ON r.fold = f.fold GROUP BY ALL""", _ROWS,
    f"f AS (SELECT *, {_FIT} FROM (SELECT k.fold, {_SUMS} FROM (SELECT DISTINCT fold FROM r) k JOIN r ON r.fold <> k.fold GROUP BY k.fold))",
    doubles=["rmse", "r2"]))
def _(spark, sf):
    """Cross-validated least squares: the SQL fits each fold anew and scores its rows one by one."""
    return rounded(gram.fold_errors(SA.with_fold(city(spark, sf)), FEATURES, "fare_amount"))


@query("gram_learning_curve", sql("""SELECT f.step, max(f.n) AS n_train, sqrt(avg(CASE WHEN r.fold <= f.step THEN (y - (my + bx * (x - mx) + bh * (h - mh))) ** 2 END)) AS train_rmse,
    sqrt(avg(CASE WHEN r.fold = 4 THEN (y - (my + bx * (x - mx) + bh * (h - mh))) ** 2 END)) AS test_rmse
  FROM f CROSS JOIN r GROUP BY f.step""", _ROWS,
    f"f AS (SELECT *, {_FIT} FROM (SELECT k.step, {_SUMS} FROM (VALUES (0), (1), (2), (3)) AS k(step) JOIN r ON r.fold <= k.step GROUP BY k.step))",
    doubles=["train_rmse", "test_rmse"]))
def _(spark, sf):
    df = SA.with_fold(city(spark, sf)).withColumn("held", F.col("fold") == 4).withColumnRenamed("fold", "step")
    return rounded(gram.size_errors(df, FEATURES, "fare_amount", "step", "held"))


# predictions that every engine computes alike, by model
_MODELS = {"flat": (25.0, 0.0, 0.0), "by distance": (18.0, 0.25, 0.0), "by both": (20.0, 0.2, 0.15)}


@query("metrics_of_models", sql("""SELECT CASE WHEN grouping(weekday) = 0 THEN 'model,weekday' WHEN grouping(hour) = 0 THEN 'model,hour' ELSE 'model' END AS grouping,
    model, hour, weekday, (1 - least(avg(abs(y - p) / greatest(abs(y), CAST(2.220446049250313e-16 AS DOUBLE))), 1)) * 100 AS "Accuracy (%)", avg(abs(y - p)) AS "MAE",
    quantile_cont(abs(y - p), 0.5) AS "MedAE", sqrt(avg((y - p) ** 2)) AS "RMSE", 1 - avg((y - p) ** 2) / nullif(var_pop(y), 0) AS "R²"
  FROM p GROUP BY GROUPING SETS ((model), (model, hour), (model, weekday))""",
    "p AS (SELECT model, fare_amount AS y, \"hour\" AS hour, \"day of week\" AS weekday, a + b * trip_distance + c * \"hour\" AS p FROM city, (VALUES "
    + ", ".join(f"('{k}', CAST({a} AS DOUBLE), CAST({b} AS DOUBLE), CAST({c} AS DOUBLE))" for k, (a, b, c) in _MODELS.items()) + ") AS m(model, a, b, c))",
    doubles=["Accuracy (%)", "MAE", "MedAE", "RMSE", "R²"]))
def _(spark, sf):
    """All models by model, by hour and by weekday: one evaluation of the trips, one aggregate, one median."""
    each = F.array(*[F.struct(F.lit(k).alias("model"), (F.lit(a) + F.lit(b) * F.col("trip_distance") + F.lit(c) * F.col("hour")).alias("prediction"))
                     for k, (a, b, c) in _MODELS.items()])
    rows = city(spark, sf).select("fare_amount", "hour", F.col("day of week").alias("weekday"), F.inline(each))
    return rounded(metrics_by_sets(rows, [["model"], ["model", "hour"], ["model", "weekday"]]))


class FormulaModel:
    """Stands for a fitted model; its prediction can be written in SQL."""

    transform = staticmethod(with_formula)


def _formula_error(distance: str, hour: str) -> str:
    return f"avg(abs(a.fare_amount - (CAST(20.0 AS DOUBLE) + CAST(0.2 AS DOUBLE) * {distance} + CAST(0.15 AS DOUBLE) * {hour})))"


@query("formula_permutation_importance", sql(
    """SELECT v.feature AS "Feature", avg(v.e - e.base) AS "MeanImportance", stddev_pop(v.e - e.base) AS "StdImportance"
  FROM e, LATERAL (VALUES ('trip_distance', e.distance), ('hour', e.hours), ('passenger_count', e.base)) AS v(feature, e) GROUP BY 1""",
    f"""a AS (SELECT *, row_number() OVER (ORDER BY CAST(concat('0x', substr(md5(concat('permute{CHECK_CONFIG.seed}:', row_key)), 1, 8)) AS BIGINT), row_key) - 1 AS pos,
    count(*) OVER () AS n FROM city)""",
    f"""e AS (SELECT s.r, {_formula_error('a.trip_distance', 'a."hour"')} AS base, {_formula_error('d.trip_distance', 'a."hour"')} AS distance,
    {_formula_error('a.trip_distance', 'd."hour"')} AS hours
  FROM a CROSS JOIN (VALUES (1), (2), (3), (4), (5)) AS s(r) JOIN a AS d ON d.pos = (a.pos + s.r) % a.n GROUP BY 1)""",
    doubles=["MeanImportance", "StdImportance"]))
def _(spark, sf):
    return rounded(permutation_importance(FormulaModel(), city(spark, sf), ["trip_distance", "hour", "passenger_count"], CHECK_CONFIG))

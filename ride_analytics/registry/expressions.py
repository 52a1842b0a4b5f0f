"""Scalar columns, splits and samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from ride_analytics.functions import columns as X
from ride_analytics.functions.bins import DISTANCE_BINS, FARE_CLASSES
from ride_analytics.operators import feature_tables as FT
from ride_analytics.operators import sampling as SA
from ride_analytics.registry.base import case_bins, city, hash_sql, query, rounded, scored, sql, trips
from ride_analytics.sources import storage


@query("parse_timestamps", sql("SELECT row_key, tpep_pickup_datetime AS ts FROM trips"))
def _(spark, sf):
    text = F.date_format("tpep_pickup_datetime", "yyyy-MM-dd HH:mm:ss")
    return trips(spark, sf).select("row_key", F.to_timestamp_ntz(text, F.lit("yyyy-MM-dd HH:mm:ss")).alias("ts"))


@query("time_columns", sql("""SELECT row_key, "hour", "day of week", "is weekend", is_night_fare, is_rush_hour,
  CAST(CAST(tpep_pickup_datetime AS DATE) AS VARCHAR) AS trip_date FROM city"""))
def _(spark, sf):
    return city(spark, sf).select("row_key", "hour", "day of week", "is weekend", "is_night_fare", "is_rush_hour",
                                  F.to_date("tpep_pickup_datetime").cast("string").alias("trip_date"))


@query("trip_duration", sql("""SELECT row_key,
  date_diff('microsecond', tpep_pickup_datetime, tpep_dropoff_datetime) / CAST(6e7 AS DOUBLE) AS minutes,
  date_diff('microsecond', tpep_pickup_datetime, tpep_dropoff_datetime) / CAST(3.6e9 AS DOUBLE) AS hours FROM trips""",
                            doubles=["minutes", "hours"]))
def _(spark, sf):
    ends = ("tpep_pickup_datetime", "tpep_dropoff_datetime")
    return rounded(trips(spark, sf).select("row_key", X.duration_minutes(*ends).alias("minutes"),
                                           X.duration_hours(*ends).alias("hours")))


@query("trip_speed", sql("SELECT row_key, speed_mph FROM speeds", doubles=["speed_mph"]))
def _(spark, sf):
    return rounded(FT.with_speed(city(spark, sf)).select("row_key", "speed_mph"))


@query("value_bins", sql(f"""SELECT row_key, {case_bins('fare_amount', FARE_CLASSES)} AS fare_class,
  {case_bins('trip_distance', DISTANCE_BINS)} AS distance_bin FROM trips"""))
def _(spark, sf):
    return trips(spark, sf).select("row_key", FARE_CLASSES.label(F.col("fare_amount")).alias("fare_class"),
                                   DISTANCE_BINS.label(F.col("trip_distance")).alias("distance_bin"))


@query("fare_per_mile", sql("""SELECT row_key, fare_amount / trip_distance AS per_mile,
  CASE WHEN fare_amount / trip_distance < 1 THEN 1 WHEN fare_amount / trip_distance > 10 THEN 10
    ELSE fare_amount / trip_distance END AS clipped FROM trips""", doubles=["per_mile", "clipped"]))
def _(spark, sf):
    per_mile = X.ratio(F.col("fare_amount"), F.col("trip_distance"))
    return rounded(trips(spark, sf).select("row_key", per_mile.alias("per_mile"), X.clip(per_mile, 1.0, 10.0).alias("clipped")))


@query("log_and_cyclic_columns", sql("""SELECT row_key, ln(1 + trip_distance) AS log_distance,
  sin(2 * pi() * "hour" / 24) AS hour_sin, cos(2 * pi() * "hour" / 24) AS hour_cos,
  sin(2 * pi() * "day of week" / 7) AS day_sin, cos(2 * pi() * "day of week" / 7) AS day_cos FROM city""",
                                     doubles=["log_distance", "hour_sin", "hour_cos", "day_sin", "day_cos"], digits=5))
def _(spark, sf):
    hs, hc = X.cyclic(F.col("hour"), 24)
    ds, dc = X.cyclic(F.col("day of week"), 7)
    df = city(spark, sf).select("row_key", F.log1p("trip_distance").alias("log_distance"), hs.alias("hour_sin"),
                                hc.alias("hour_cos"), ds.alias("day_sin"), dc.alias("day_cos"))
    return rounded(df, 5)


@query("residual_columns", sql("""SELECT row_key, residual, abs_error, ape, sqrt(abs_error) AS root_error,
  round_even(prediction * 10, 0) / 10 AS shown FROM scored""", doubles=["residual", "abs_error", "ape", "root_error"]))
def _(spark, sf):
    return rounded(scored(spark, sf).select(
        "row_key", X.residual("fare_amount", "prediction").alias("residual"),
        X.absolute_error("fare_amount", "prediction").alias("abs_error"),
        X.percentage_error("fare_amount", "prediction").alias("ape"),
        F.sqrt(X.absolute_error("fare_amount", "prediction")).alias("root_error"),
        (F.rint(F.col("prediction") * 10) / 10).alias("shown")))


@query("text_labels", sql("""SELECT row_key, ['Mon', 'Tue', 'Wed', 'Thu', 'Fri', 'Sat', 'Sun']["day of week" + 1] AS day,
  CASE "is weekend" WHEN 1 THEN 'Weekend' ELSE 'Weekday' END AS day_type,
  concat('route ', PULocationID, '-', DOLocationID) AS route FROM city"""))
def _(spark, sf):
    return city(spark, sf).select("row_key", X.weekday_name(F.col("day of week")).alias("day"),
                                  X.day_type(F.col("is weekend")).alias("day_type"),
                                  F.format_string("route %d-%d", "PULocationID", "DOLocationID").alias("route"))


# --- splits and samples -----------------------------------------------------------
@query("test_split", sql(f"SELECT row_key, {hash_sql()} % 100 < 20 AS is_test FROM trips"))
def _(spark, sf):
    return SA.with_test_flag(trips(spark, sf)).select("row_key", "is_test")


@query("holdout_split", sql(f"SELECT row_key, {hash_sql(salt='holdout')} % 100 < 15 AS is_val FROM trips"))
def _(spark, sf):
    return SA.with_holdout_flag(trips(spark, sf)).select("row_key", "is_val")


@query("fold_assignment", sql(f"SELECT row_key, CAST({hash_sql(salt='fold')} % 5 AS INTEGER) AS fold FROM trips"))
def _(spark, sf):
    return SA.with_fold(trips(spark, sf)).select("row_key", "fold")


@query("exact_class_sample", sql(f"""SELECT row_key, RatecodeID FROM (SELECT row_key, RatecodeID,
  row_number() OVER (PARTITION BY RatecodeID ORDER BY {hash_sql()}, row_key) AS r FROM trips) WHERE r <= 500"""))
def _(spark, sf):
    return SA.first_n_by_hash(trips(spark, sf).select("row_key", "RatecodeID"), 500, ["RatecodeID"])


@query("uniform_sample", sql(f"SELECT row_key, fare_amount FROM trips ORDER BY {hash_sql()}, row_key LIMIT 2000"))
def _(spark, sf):
    return SA.sample_rows(trips(spark, sf).select("row_key", "fare_amount"), 2000)


@query("nested_sample_levels", sql(f"""SELECT row_key, CASE WHEN u < CAST(0.1 AS DOUBLE) THEN 0 WHEN u < CAST(0.325 AS DOUBLE) THEN 1
  WHEN u < CAST(0.55 AS DOUBLE) THEN 2 WHEN u < CAST(0.775 AS DOUBLE) THEN 3 WHEN u < 1 THEN 4 END AS level
  FROM (SELECT row_key, {hash_sql(salt='curve')} / CAST(4294967296 AS DOUBLE) AS u FROM trips)"""))
def _(spark, sf):
    return SA.with_prefix_level(trips(spark, sf), [0.1, 0.325, 0.55, 0.775, 1.0]).select("row_key", "level")


@query("shuffled_rows", sql("SELECT row_key, fare_amount FROM trips"))
def _(spark, sf):
    return SA.shuffle_rows(trips(spark, sf).select("row_key", "fare_amount"))


_TARGET = 4000
_CLASS = case_bins("fare_amount", FARE_CLASSES)
_U = hash_sql("concat_ws('-', d.draw, 'trip_distance')", "noise42-u")
_V = hash_sql("concat_ws('-', d.draw, 'trip_distance')", "noise42-v")


@query("balanced_classes", sql(f"""SELECT row_key, fare_amount, trip_distance, 0 AS copy FROM numbered JOIN stats USING (class)
    WHERE size >= {_TARGET} AND pos <= {_TARGET}
  UNION ALL
  SELECT n.row_key, n.fare_amount, greatest(n.trip_distance + sqrt(-2 * ln(({_U} + 1) / CAST(4294967296 AS DOUBLE)))
      * cos(2 * pi() * ({_V} / CAST(4294967296 AS DOUBLE))) * s.sd * 0.01, s.low) AS trip_distance, d.copy
  FROM numbered n JOIN draws d ON n.class = d.class AND n.pos = d.pos JOIN stats s ON n.class = s.class""",
    f"classed AS (SELECT row_key, fare_amount, trip_distance, {_CLASS} AS class FROM city)",
    "stats AS (SELECT class, count(*) AS size, stddev_samp(trip_distance) AS sd, min(trip_distance) AS low FROM classed WHERE class IS NOT NULL GROUP BY 1)",
    f"numbered AS (SELECT *, row_number() OVER (PARTITION BY class ORDER BY {hash_sql(salt='balance42')}, row_key) AS pos FROM classed)",
    f"""draws AS (SELECT class, copy, draw, {hash_sql('draw', 'draw42')} % size + 1 AS pos FROM (
      SELECT class, size, i AS copy, concat_ws('-', class, i) AS draw FROM stats, range(1, {_TARGET + 1}) AS g(i) WHERE size < {_TARGET}))""",
    doubles=["trip_distance"]))
def _(spark, sf):
    df = city(spark, sf).select("row_key", "fare_amount", "trip_distance")
    return rounded(SA.balance_classes(df, _TARGET))


@query("feature_table_lookups", sql("""SELECT c.row_key, p.f AS PU_fare_avg, d.f AS DO_fare_avg,
    coalesce(r.s, b.s, g.s) AS route_avg_speed, coalesce(r.n, 0) AS route_popularity
  FROM city c JOIN tagged t ON c.row_key = t.row_key
  LEFT JOIN (SELECT PULocationID AS k, avg(fare_amount) AS f FROM train GROUP BY 1) p ON c.PULocationID = p.k
  LEFT JOIN (SELECT DOLocationID AS k, avg(fare_amount) AS f FROM train GROUP BY 1) d ON c.DOLocationID = d.k
  LEFT JOIN (SELECT PULocationID AS k, DOLocationID AS l, "hour" AS h, median(speed_mph) AS s, count(speed_mph) AS n
             FROM train GROUP BY 1, 2, 3) r ON c.PULocationID = r.k AND c.DOLocationID = r.l AND c."hour" = r.h
  LEFT JOIN (SELECT PULocationID AS k, "hour" AS h, median(speed_mph) AS s FROM train GROUP BY 1, 2) b
    ON c.PULocationID = b.k AND c."hour" = b.h
  CROSS JOIN (SELECT median(speed_mph) AS s FROM train) g WHERE t.is_test""",
    f"tagged AS (SELECT row_key, {hash_sql()} % 100 < 20 AS is_test FROM city)",
    "train AS (SELECT s.* FROM speeds s JOIN tagged t ON s.row_key = t.row_key WHERE NOT t.is_test)",
    doubles=["PU_fare_avg", "DO_fare_avg", "route_avg_speed"]))
def _(spark, sf):
    """Zone fares and the three-step speed fallback, learned from training trips
    and looked up for test trips."""
    df = SA.with_test_flag(city(spark, sf))
    train, test = df.where(~F.col("is_test")), df.where(F.col("is_test"))
    learned = {name: storage.written(table, name) for name, table in FT.learn_tables(train).items()}
    overall = learned["globals"].first()
    out = FT.add_zone_fares(test, learned["pu_fare"], learned["do_fare"], F.lit(overall["mean_fare"]))
    out = FT.add_route_features(out, learned["route_stats"], learned["zone_hour_speed"], F.lit(overall["median_speed"]))
    return rounded(out.select("row_key", "PU_fare_avg", "DO_fare_avg", "route_avg_speed", "route_popularity"))

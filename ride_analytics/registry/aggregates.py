"""Zone, time and range summaries, distributions, ordered reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ride_analytics.config import FEE_COLUMNS
from ride_analytics.functions import columns as X
from ride_analytics.functions.bins import DISTANCE_BINS, FARE_CLASSES
from ride_analytics.operators import feature_tables as FT
from ride_analytics.operators import histograms as H
from ride_analytics.operators import quantiles as Q
from ride_analytics.operators import screening as SC
from ride_analytics.operators import summaries as S
from ride_analytics.operators.ordering import number_rows, rolling_mean, smallest_prefix
from ride_analytics.registry.base import (box_sql, case_bins, city, query, rounded, scored, sql, trips, values_bins,
                                          zones)
from ride_analytics.sources.star_trips import read_table

DIST_LABEL = case_bins("trip_distance", DISTANCE_BINS)
DIST_ORDER = case_bins("trip_distance", DISTANCE_BINS, range(len(DISTANCE_BINS.labels)))
BINNED = f"""binned AS (SELECT *, {DIST_LABEL} AS "distance bin",
  CAST({DIST_ORDER} AS INTEGER) AS "distance bin order", fare_amount / trip_distance AS per_mile FROM city)"""


for _key, _name in (("PULocationID", "PU_fare_avg"), ("DOLocationID", "DO_fare_avg")):
    @query(f"mean_fare_by_{'pickup' if _key[0] == 'P' else 'dropoff'}_zone",
           sql(f"SELECT {_key}, avg(fare_amount) AS {_name} FROM city GROUP BY 1", doubles=[_name]))
    def _(spark, sf, key=_key, name=_name):
        return rounded(S.mean_fare_by_zone(city(spark, sf), key, name))


@query("global_mean_fare", sql("SELECT avg(fare_amount) AS mean_fare FROM city", doubles=["mean_fare"]))
def _(spark, sf):
    return rounded(S.global_mean_fare(city(spark, sf)))


@query("zone_profile", sql("""SELECT PULocationID, avg(fare_amount) AS mean_fare, avg(trip_distance) AS mean_distance
  FROM city GROUP BY 1""", doubles=["mean_fare", "mean_distance"]))
def _(spark, sf):
    return rounded(S.zone_profile(city(spark, sf)))


@query("route_statistics", sql("""SELECT PULocationID, DOLocationID, "hour", median(speed_mph) AS route_avg_speed,
  count(speed_mph) AS route_popularity FROM speeds GROUP BY 1, 2, 3""", doubles=["route_avg_speed"]))
def _(spark, sf):
    return rounded(FT.route_stats(city(spark, sf)))


@query("zone_hour_speed", sql("""SELECT PULocationID, "hour", median(speed_mph) AS zone_hour_speed FROM speeds
  GROUP BY 1, 2""", doubles=["zone_hour_speed"]))
def _(spark, sf):
    return rounded(FT.zone_hour_speed(city(spark, sf)))


@query("global_median_speed", sql("SELECT median(speed_mph) AS median_speed FROM speeds", doubles=["median_speed"]))
def _(spark, sf):
    return rounded(FT.global_speed(city(spark, sf)))


@query("large_group_medians", sql("""SELECT RatecodeID, quantile_cont(fare_amount, 0.1) AS p10,
  median(fare_amount) AS p50, quantile_cont(fare_amount, 0.99) AS p99 FROM trips GROUP BY 1""",
                                 doubles=["p10", "p50", "p99"]))
def _(spark, sf):
    """The path for groups too large for one task, forced here."""
    return rounded(Q.grouped_quantiles(trips(spark, sf), ["RatecodeID"], "fare_amount",
                                       {"p10": 0.1, "p50": 0.5, "p99": 0.99}, small_rows=0))


@query("trips_per_pickup_zone", sql("SELECT PULocationID, count(*) AS trip_count FROM city GROUP BY 1"))
def _(spark, sf):
    return S.trips_by(city(spark, sf), "PULocationID")


for _key, _side in (("PULocationID", "pickup"), ("DOLocationID", "dropoff")):
    @query(f"{_side}_volume", sql(f"""SELECT {_key}, trip_count, CASE WHEN trip_count = max(trip_count) OVER () THEN 'peak'
      WHEN trip_count = min(trip_count) OVER () THEN 'low' ELSE 'other' END AS mark
      FROM (SELECT {_key}, count(*) AS trip_count FROM city GROUP BY 1)"""))
    def _(spark, sf, key=_key):
        return S.location_volume(city(spark, sf), key)

for _key, _side in (("PU_Boro", "pickup"), ("DO_Boro", "dropoff")):
    @query(f"{_side}_borough_volume", sql(f"""SELECT {_key}, count(*) AS trip_count FROM city
      WHERE {_key} IS NOT NULL GROUP BY 1"""))
    def _(spark, sf, key=_key):
        return S.borough_volume(city(spark, sf), key)


@query("borough_share", sql("""SELECT PU_Boro, count(*) AS trip_count, count(*) * 100.0 / sum(count(*)) OVER () AS share_pct
  FROM city WHERE PU_Boro IS NOT NULL GROUP BY 1""", doubles=["share_pct"]))
def _(spark, sf):
    return rounded(S.borough_share(city(spark, sf)))


_BIN_COUNTS = """SELECT b."distance bin", b.bin_order, coalesce(c.n, 0) AS trip_count FROM bins b
  LEFT JOIN (SELECT "distance bin", count(*) AS n FROM binned GROUP BY 1) c ON b."distance bin" = c."distance bin" """


@query("distance_bin_counts", sql(_BIN_COUNTS, BINNED, values_bins(DISTANCE_BINS, "distance bin")))
def _(spark, sf):
    return S.distance_bin_counts(city(spark, sf))


@query("distance_bin_share", sql(f"""SELECT *, trip_count * 100.0 / sum(trip_count) OVER () AS share_pct FROM ({_BIN_COUNTS})""",
                                 BINNED, values_bins(DISTANCE_BINS, "distance bin"), doubles=["share_pct"]))
def _(spark, sf):
    return rounded(S.distance_bin_share(city(spark, sf)))


SCANNED = ["VendorID", "passenger_count", "RatecodeID", "hour", "day of week", "is weekend", "is_night_fare",
           "is_rush_hour", "is_holiday", "extra", "mta_tax", "improvement_surcharge", "congestion_surcharge",
           "cbd_congestion_fee"]


@query("quasi_constant_scan", sql("SELECT \"column\", CAST(max(n) AS DOUBLE) / sum(n) AS top_share, "
                                  "CASE WHEN CAST(max(n) AS DOUBLE) / sum(n) >= 0.95 THEN 'DROP' ELSE 'KEEP' END AS status FROM ("
                                  + " UNION ALL ".join(f"""SELECT '{c}' AS "column", CAST("{c}" AS VARCHAR) AS v, count(*) AS n
                                    FROM city GROUP BY "{c}" """ for c in SCANNED)
                                  + ") GROUP BY \"column\"", doubles=["top_share"]))
def _(spark, sf):
    return rounded(SC.quasi_constant_scan(city(spark, sf), SCANNED))


@query("fee_incidence", sql(" UNION ALL ".join(
    f"SELECT '{c}' AS fee, avg(CASE WHEN {c} > 0 THEN 1.0 ELSE 0.0 END) * 100 AS pct_trips, '{c.replace('_', ' ')}' AS label FROM city"
    for c in FEE_COLUMNS), doubles=["pct_trips"]))
def _(spark, sf):
    return rounded(S.fee_incidence(city(spark, sf), FEE_COLUMNS))


def _describe_sql(column, value):
    return f"""SELECT '{column}' AS "column", count({value}) AS "count", avg({value}) AS mean,
      stddev_samp({value}) AS std, min({value}) AS min, quantile_cont({value}, 0.25) AS q25,
      quantile_cont({value}, 0.5) AS q50, quantile_cont({value}, 0.75) AS q75, max({value}) AS max FROM city"""


_MINUTES = "(date_diff('microsecond', tpep_pickup_datetime, tpep_dropoff_datetime) / CAST(6e7 AS DOUBLE))"


@query("describe_fare_and_duration", sql(_describe_sql("fare_amount", "fare_amount") + " UNION ALL "
                                         + _describe_sql("trip_duration_min", _MINUTES),
                                         doubles=["mean", "std", "min", "q25", "q50", "q75", "max"], digits=4))
def _(spark, sf):
    df = city(spark, sf).withColumn("trip_duration_min", X.duration_minutes("tpep_pickup_datetime", "tpep_dropoff_datetime"))
    return rounded(Q.describe(df, ["fare_amount", "trip_duration_min"], digits=None), 4)


@query("value_range_and_view_cap", sql("""SELECT min(least(fare_amount, prediction)) AS low,
  max(greatest(fare_amount, prediction)) AS high,
  least(100, ceil(max(greatest(fare_amount, prediction)) / 5) * 5) AS view_cap FROM scored""", doubles=["low", "high"]))
def _(spark, sf):
    return rounded(S.value_range(scored(spark, sf), "fare_amount", "prediction"))


@query("fare_per_mile_by_distance", sql("""SELECT "distance bin", "distance bin order",
  median(per_mile) AS median_fare_per_mile FROM binned WHERE "distance bin" IS NOT NULL GROUP BY 1, 2""", BINNED,
                                        doubles=["median_fare_per_mile"]))
def _(spark, sf):
    return rounded(S.fare_per_mile_by_distance(city(spark, sf)))


@query("fare_boxes_by_distance", sql(box_sql("binned", '"distance bin", "distance bin order"', "fare_amount"), BINNED,
                                     doubles=["q1", "median", "q3", "whisker_low", "whisker_high"]))
def _(spark, sf):
    return rounded(S.fare_boxes_by_distance(city(spark, sf)))


CORR = ["passenger_count", "trip_distance", "hour", "day of week", "is weekend", "is_night_fare", "is_rush_hour", "is_holiday"]


@query("correlation_matrix", sql(" UNION ALL ".join(
    f"""SELECT '{X.display_name(a)}' AS x, '{X.display_name(b)}' AS y, corr("{a}", "{b}") AS corr FROM city"""
    for a in CORR for b in CORR), doubles=["corr"]))
def _(spark, sf):
    return rounded(SC.correlation_matrix(city(spark, sf), CORR + ["fare_amount"], display=True))


@query("fare_heatmap", sql('SELECT "day of week", ' + ", ".join(
    f'avg(CASE WHEN "hour" = {h} THEN fare_amount END) AS "{h}"' for h in range(24)) + " FROM city GROUP BY 1",
                           doubles=[str(h) for h in range(24)]))
def _(spark, sf):
    return rounded(S.fare_heatmap(city(spark, sf)))


FLAGSHIP = "fare_by_weekday_and_hour"


@query(FLAGSHIP, sql("""SELECT "day of week", "hour", avg(fare_amount) AS mean_fare,
  ['Mon', 'Tue', 'Wed', 'Thu', 'Fri', 'Sat', 'Sun']["day of week" + 1] AS day FROM city GROUP BY 1, 2""",
                     doubles=["mean_fare"]))
def flagship(spark, sf):
    return rounded(S.fare_heatmap_long(city(spark, sf)))


@query("hourly_volume_weekday_weekend", sql("""SELECT "hour", "is weekend", count(*) AS trip_count,
  CASE "is weekend" WHEN 1 THEN 'Weekend' ELSE 'Weekday' END AS "day type" FROM city GROUP BY 1, 2"""))
def _(spark, sf):
    return S.hourly_volume(city(spark, sf))


def _histogram_sql(value, source, bins=80):
    return f"""SELECT CAST(bin AS INTEGER) AS bin, lo + bin * w AS bin_low, lo + (bin + 1) * w AS bin_high, n FROM (
      SELECT least(floor(({value} - lo) / w), {bins - 1}) AS bin, any_value(lo) AS lo, any_value(w) AS w, count(*) AS n
      FROM {source}, (SELECT min({value}) AS lo, (max({value}) - min({value})) / {bins} AS w FROM {source}) GROUP BY 1)"""


for _value in ("fare_amount", "residual"):
    @query(f"{'fare' if _value[0] == 'f' else 'residual'}_histogram",
           sql(_histogram_sql(_value, "scored"), doubles=["bin_low", "bin_high"]))
    def _(spark, sf, value=_value):
        df = scored(spark, sf).withColumn("residual", X.residual("fare_amount", "prediction"))
        return rounded(H.histogram(df, value))


@query("fare_density_curve", sql("""SELECT CAST(g.i AS INTEGER) AS point, s.lo + g.i * ((s.hi - s.lo) / 199) AS x,
    sum(c.n * exp(-0.5 * pow((s.lo + g.i * ((s.hi - s.lo) / 199) - c.m) / s.h, 2))) / (max(s.n) * max(s.h) * sqrt(2 * pi())) AS density
  FROM cells c, shape s, range(200) AS g(i) GROUP BY g.i, s.lo, s.hi""",
    """shape AS (SELECT min(fare_amount) AS lo, max(fare_amount) AS hi, count(*) AS n,
      stddev_samp(fare_amount) * pow(count(*), -0.2) AS h FROM city)""",
    """cells AS (SELECT floor((fare_amount - lo) / (h / 4)) AS cell, count(*) AS n, avg(fare_amount) AS m
      FROM city, shape GROUP BY 1)""", doubles=["x", "density"]))
def _(spark, sf):
    return rounded(H.density_curve(city(spark, sf), "fare_amount"))


def _hexagon_sql(x, y, grid):
    down = int(grid / 3 ** 0.5)
    return f"""SELECT lattice, i, j, x0 + (i + lattice * 0.5) * wx AS x, y0 + (j + lattice * 0.5) * wy AS y, n FROM (
      SELECT CASE WHEN near THEN 0 ELSE 1 END AS lattice, CAST(CASE WHEN near THEN round_even(u, 0) ELSE floor(u) END AS INTEGER) AS i,
        CAST(CASE WHEN near THEN round_even(v, 0) ELSE floor(v) END AS INTEGER) AS j, any_value(x0) AS x0, any_value(y0) AS y0,
        any_value(wx) AS wx, any_value(wy) AS wy, count(*) AS n
      FROM (SELECT *, (u - round_even(u, 0)) * (u - round_even(u, 0)) + (v - round_even(v, 0)) * (v - round_even(v, 0)) * 3.0
                 < (u - floor(u) - 0.5) * (u - floor(u) - 0.5) + (v - floor(v) - 0.5) * (v - floor(v) - 0.5) * 3.0 AS near
            FROM (SELECT ({x} - x0) / wx AS u, ({y} - y0) / wy AS v, x0, y0, wx, wy FROM scored,
                  (SELECT min({x}) AS x0, min({y}) AS y0, (max({x}) - min({x})) / {grid} AS wx,
                          (max({y}) - min({y})) / {down} AS wy FROM scored)))
      GROUP BY 1, 2, 3)"""


@query("actual_vs_predicted_hexagons", sql(_hexagon_sql("fare_amount", "prediction", 60), doubles=["x", "y"]))
def _(spark, sf):
    return rounded(H.hexagons(scored(spark, sf), "fare_amount", "prediction", 60))


@query("predicted_vs_residual_hexagons", sql(_hexagon_sql("prediction", "residual", 50), doubles=["x", "y"]))
def _(spark, sf):
    df = scored(spark, sf).withColumn("residual", X.residual("fare_amount", "prediction"))
    return rounded(H.hexagons(df, "prediction", "residual", 50))


@query("fare_class_deviation", sql(f"""SELECT {case_bins('fare_amount', FARE_CLASSES)} AS fare_class,
  stddev_samp(trip_distance) AS sd FROM city GROUP BY 1""", doubles=["sd"]))
def _(spark, sf):
    return rounded(city(spark, sf).groupBy(FARE_CLASSES.label(F.col("fare_amount")).alias("fare_class"))
                   .agg(F.stddev_samp("trip_distance").alias("sd")))


@query("mean_fare_by_hour", sql("""SELECT "hour", avg(fare_amount) AS mean_fare FROM city GROUP BY 1""", doubles=["mean_fare"]))
def _(spark, sf):
    return rounded(S.mean_fare_by_hour(city(spark, sf)))


@query("rate_code_distribution", sql("SELECT RatecodeID, count(*) AS trip_count FROM trips GROUP BY 1"))
def _(spark, sf):
    return S.rate_code_distribution(trips(spark, sf))


@query("zone_demand_top_bottom", sql("""SELECT c.PULocationID, c.trip_count, c.side, coalesce(z.Zone, CAST(c.PULocationID AS VARCHAR)) AS Zone FROM (
    SELECT * FROM (SELECT *, 'top' AS side FROM counts ORDER BY trip_count DESC, PULocationID LIMIT 20)
    UNION ALL SELECT * FROM (SELECT *, 'bottom' AS side FROM counts ORDER BY trip_count, PULocationID LIMIT 20)) c
  LEFT JOIN (SELECT * FROM zones WHERE Borough = 'ASIA') z ON c.PULocationID = z.LocationID""",
    "counts AS (SELECT PULocationID, count(*) AS trip_count FROM city GROUP BY 1)"))
def _(spark, sf):
    return S.zone_demand(city(spark, sf), zones(spark, sf), "ASIA")


@query("zone_share_prefix", sql("""SELECT * FROM (SELECT *, sum(share) OVER (ORDER BY share DESC, PULocationID ROWS UNBOUNDED PRECEDING) AS cumulative,
    CAST(row_number() OVER (ORDER BY share DESC, PULocationID) AS INTEGER) AS rank
  FROM (SELECT PULocationID, count(*) AS trip_count, count(*) * 100.0 / sum(count(*)) OVER () AS share FROM city GROUP BY 1))
  WHERE cumulative - share < 95""", doubles=["share", "cumulative"]))
def _(spark, sf):
    """Fewest zones that make up 95 % of the trips."""
    shares = S.with_share(S.trips_by(city(spark, sf), "PULocationID"), name="share")
    return rounded(smallest_prefix(shares, "share", 95.0, tie="PULocationID"))


@query("row_numbers_in_fare_order", sql("""SELECT row_key, fare_amount,
  row_number() OVER (ORDER BY fare_amount, row_key) - 1 AS position FROM trips"""))
def _(spark, sf):
    return number_rows(trips(spark, sf).select("row_key", "fare_amount"), ["fare_amount", "row_key"])


# --- the event table: times with seconds, free values ---------------------------
@query("event_value_by_weekday_and_hour", sql("""SELECT CAST(isodow(ts) - 1 AS INTEGER) AS "day of week",
  CAST(hour(ts) AS INTEGER) AS "hour", avg("value") AS mean_value, count(*) AS n FROM events GROUP BY 1, 2""", doubles=["mean_value"]))
def _(spark, sf):
    ev = read_table(spark, sf, "events")
    return rounded(ev.groupBy(X.day_of_week(F.col("ts")).alias("day of week"), X.hour_of(F.col("ts")).alias("hour"))
                     .agg(F.avg("value").alias("mean_value"), F.count(F.lit(1)).alias("n")))


@query("event_value_histogram", sql(_histogram_sql('"value"', "events"), doubles=["bin_low", "bin_high"]))
def _(spark, sf):
    return rounded(H.histogram(read_table(spark, sf, "events"), "value"))


@query("event_value_trend", sql("""SELECT event_id, "value", avg("value") OVER (ORDER BY ts, event_id ROWS 499 PRECEDING) AS trend FROM events""",
                                doubles=["trend"]))
def _(spark, sf):
    ev = read_table(spark, sf, "events").select("event_id", "ts", "value")
    return rounded(rolling_mean(ev, ["ts", "event_id"], "value", 500, block=2_000).select("event_id", "value", "trend"))

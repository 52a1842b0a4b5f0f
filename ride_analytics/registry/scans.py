"""Scans, row rules, lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from ride_analytics.config import FEATURE_SETS, Config
from ride_analytics.functions import columns as X
from ride_analytics.operators import cleaning as C
from ride_analytics.operators import summaries as S
from ride_analytics.operators.feature_tables import add_zone_fares
from ride_analytics.operators.summaries import zone_map_table
from ride_analytics.registry.base import (_KEPT, ALL_BOROUGHS, CHECK_CONFIG, check_holidays, city, home, query, rounded,
                                          sql, trips, zones)
from ride_analytics.sources import storage
from ride_analytics.sources.trips import existing_columns, keep_required, load_trips, load_zones


@query("trip_scan", sql(f"SELECT row_key, {_KEPT} FROM trips"))
def _(spark, sf):
    return keep_required(trips(spark, sf), CHECK_CONFIG)


@query("zone_lookup_scan", sql("SELECT LocationID, Borough, Zone FROM zones"))
def _(spark, sf):
    path = storage.write_csv(zones(spark, sf), storage.fresh_path(spark, "zone-lookup"))
    return load_zones(spark, path)


MONTHS = [f"2000-{m:02d}" for m in range(1, 13)]


@query("other_period_scan", sql(f"""SELECT row_key, {_KEPT} FROM trips
  WHERE tpep_pickup_datetime >= TIMESTAMP '2000-01-01' AND tpep_pickup_datetime < TIMESTAMP '2001-01-01'"""))
def _(spark, sf):
    """Trips written by month, then read back for the months of another year only."""
    path = storage.fresh_path(spark, "trips-by-month")
    months = trips(spark, sf).withColumn("pickup_month", F.date_format("tpep_pickup_datetime", "yyyy-MM"))
    months.hint("rebalance", "pickup_month").write.partitionBy("pickup_month").parquet(path)
    return load_trips(spark, path, MONTHS, CHECK_CONFIG)


@query("cached_clean_trips", sql("""SELECT "hour", count(*) AS trip_count FROM city GROUP BY "hour" """))
def _(spark, sf):
    root = storage.fresh_path(spark, "processed")
    raw = trips(spark, sf)
    # another input under the same settings comes first and must not be what is read back
    other = raw.where("RatecodeID = 1")
    storage.cached_table(spark, root, ALL_BOROUGHS.key(), lambda: other, [other])
    storage.cached_table(spark, root, ALL_BOROUGHS.key(), lambda: city(spark, sf), [raw])
    return S.trips_by(storage.cached_table(spark, root, ALL_BOROUGHS.key(), lambda: city(spark, sf), [raw]), "hour")


@query("csv_result_table", sql("SELECT PULocationID, count(*) AS trip_count FROM city GROUP BY 1"))
def _(spark, sf):
    table = S.trips_by(city(spark, sf), "PULocationID")
    path = storage.write_csv(table, storage.fresh_path(spark, "zone-summary"))
    return storage.read_csv(spark, path, "PULocationID int, trip_count bigint")


@query("drop_incomplete_rows", sql("""SELECT row_key, RatecodeID FROM trips WHERE RatecodeID <> 3"""))
def _(spark, sf):
    """Rate 3 stands for an unknown rate here."""
    gaps = trips(spark, sf).withColumn("RatecodeID", F.when(F.col("RatecodeID") != 3, F.col("RatecodeID")))
    return C.drop_incomplete(gaps).select("row_key", "RatecodeID")


@query("fees_not_negative", sql("""SELECT row_key, extra FROM trips WHERE extra >= 0 AND mta_tax >= 0
  AND improvement_surcharge >= 0 AND congestion_surcharge >= 0 AND cbd_congestion_fee >= 0"""))
def _(spark, sf):
    df = trips(spark, sf)
    return df.where(C.fees_not_negative(df)).select("row_key", "extra")


@query("passengers_plausible", sql("SELECT row_key, passenger_count FROM trips WHERE passenger_count BETWEEN 1 AND 6"))
def _(spark, sf):
    return trips(spark, sf).where(C.passengers_plausible()).select("row_key", "passenger_count")


@query("distance_and_fare_plausible", sql("""SELECT row_key, trip_distance, fare_amount FROM trips
  WHERE trip_distance > 0 AND fare_amount > 0 AND fare_amount <= 50"""))
def _(spark, sf):
    return trips(spark, sf).where(C.distance_and_fare_plausible()).select("row_key", "trip_distance", "fare_amount")


@query("standard_rate_only", sql("SELECT row_key, RatecodeID FROM trips WHERE RatecodeID = 1"))
def _(spark, sf):
    return trips(spark, sf).where(C.standard_rate()).select("row_key", "RatecodeID")


@query("trips_inside_borough", sql("SELECT row_key, PU_Boro, DO_Boro FROM home"))
def _(spark, sf):
    return city(spark, sf).where(C.in_borough("ASIA")).select("row_key", "PU_Boro", "DO_Boro")


@query("borough_zones_any_case", sql("SELECT LocationID, Zone FROM zones WHERE lower(Borough) = 'asia'"))
def _(spark, sf):
    return zones(spark, sf).where(F.lower("Borough") == "asia").select("LocationID", "Zone")


@query("zone_map_of_borough", sql("""SELECT z.LocationID, z.Borough, z.Zone, avg(c.fare_amount) AS mean_fare, count(c.row_key) FILTER (c.row_key IS NOT NULL) AS n
  FROM zones z LEFT JOIN city c ON c.PULocationID = z.LocationID WHERE lower(z.Borough) = 'asia' GROUP BY 1, 2, 3""", doubles=["mean_fare"]))
def _(spark, sf):
    """The map's zones by the operator's own filter, in another letter case than the table's."""
    table = zone_map_table(city(spark, sf), zones(spark, sf), borough="aSiA")
    return rounded(table.withColumn("n", F.coalesce("trip_count", F.lit(0).cast("bigint"))).drop("trip_count"))


def _projection(mode):
    cols = [c for c in FEATURE_SETS[mode]["features"]
            if c not in ("PU_fare_avg", "DO_fare_avg", "route_avg_speed", "pickup_cluster", "route_popularity")]
    listed = ", ".join(f'"{c}"' for c in cols)

    @query(f"feature_columns_{mode.lower()}", sql(f"SELECT row_key, {listed}, fare_amount FROM city"))
    def _(spark, sf):
        df = city(spark, sf)
        names = existing_columns(df, Config(feature_mode=mode).features)
        return df.select("row_key", *[F.col(f"`{c}`") for c in names], "fare_amount")


for _mode in FEATURE_SETS:
    _projection(_mode)


@query("drop_and_rename_columns", sql("""SELECT row_key, "hour" AS "hour", is_night_fare AS "is night fare",
  is_rush_hour AS "is rush hour" FROM city"""))
def _(spark, sf):
    df = city(spark, sf).select("row_key", "hour", "is_night_fare", "is_rush_hour", "fare_amount").drop("fare_amount")
    return df.toDF("row_key", *[X.display_name(c) for c in df.columns[1:]])


@query("existing_candidate_columns", sql('SELECT row_key, "hour", extra FROM city'))
def _(spark, sf):
    df = city(spark, sf)
    return df.select("row_key", *existing_columns(df, ["hour", "airport_fee", "extra", "tolls"]))


@query("masked_assignment", sql("""SELECT row_key, CASE WHEN trip_distance > 25 THEN CAST(25 AS DOUBLE)
  ELSE trip_distance END AS trip_distance FROM city"""))
def _(spark, sf):
    far = F.col("trip_distance") > 25
    return city(spark, sf).select("row_key", F.when(far, F.lit(25.0)).otherwise(F.col("trip_distance")).alias("trip_distance"))


@query("row_funnel", sql("""SELECT 'raw' AS step, count(*) AS n, 0 AS step_order FROM trips
  UNION ALL SELECT 'integrity', count(*), 1 FROM sound
  UNION ALL SELECT 'borough', count(*), 2 FROM home"""))
def _(spark, sf):
    return C.row_funnel(trips(spark, sf), zones(spark, sf), CHECK_CONFIG)


@query("borough_lookup", sql("SELECT row_key, PU_Boro, DO_Boro FROM city"))
def _(spark, sf):
    return C.with_boroughs(C.integrity_filter(trips(spark, sf)), zones(spark, sf)).select("row_key", "PU_Boro", "DO_Boro")


@query("zone_name_lookup", sql("""SELECT c.PULocationID, c.trip_count, coalesce(z.Zone, CAST(c.PULocationID AS VARCHAR)) AS Zone
  FROM (SELECT PULocationID, count(*) AS trip_count FROM city GROUP BY 1) c
  LEFT JOIN (SELECT * FROM zones WHERE Borough = 'ASIA') z ON c.PULocationID = z.LocationID"""))
def _(spark, sf):
    return C.zone_names(S.trips_by(city(spark, sf), "PULocationID"), zones(spark, sf), "ASIA")


_FLAGS = 'row_key, "hour", "day of week", "is weekend", is_night_fare, is_rush_hour, is_holiday'


@query("holiday_flag", sql("SELECT row_key, is_holiday FROM city"))
def _(spark, sf):
    return C.with_holiday_flag(C.integrity_filter(trips(spark, sf)), check_holidays(spark)).select("row_key", "is_holiday")


@query("clean_trips", sql(f"SELECT {_FLAGS}, PU_Boro, DO_Boro, {_KEPT} FROM home"))
def _(spark, sf):
    return home(spark, sf)


@query("clean_trips_all_boroughs", sql(f"SELECT {_FLAGS}, PU_Boro, DO_Boro, {_KEPT} FROM city"))
def _(spark, sf):
    return city(spark, sf)


@query("zone_map_table", sql("""SELECT z.LocationID, z.Borough, z.Zone, a.mean_fare, a.trip_count FROM zones z
  LEFT JOIN (SELECT PULocationID, avg(fare_amount) AS mean_fare, count(*) AS trip_count FROM home GROUP BY 1) a
    ON z.LocationID = a.PULocationID""", doubles=["mean_fare"]))
def _(spark, sf):
    """Zones outside the borough have no trips and stay with nulls."""
    return rounded(S.zone_map_table(home(spark, sf), zones(spark, sf)))


@query("unseen_zone_fallback", sql("""SELECT c.row_key, coalesce(p.f, g.f) AS PU_fare_avg, coalesce(d.f, g.f) AS DO_fare_avg
  FROM city c
  LEFT JOIN (SELECT PULocationID AS k, avg(fare_amount) AS f FROM home GROUP BY 1) p ON c.PULocationID = p.k
  LEFT JOIN (SELECT DOLocationID AS k, avg(fare_amount) AS f FROM home GROUP BY 1) d ON c.DOLocationID = d.k
  CROSS JOIN (SELECT avg(fare_amount) AS f FROM home) g""", doubles=["PU_fare_avg", "DO_fare_avg"]))
def _(spark, sf):
    """Means learned inside one borough, looked up for trips of all boroughs."""
    train = home(spark, sf)
    pu = storage.written(S.mean_fare_by_zone(train, "PULocationID", "PU_fare_avg"), "pu-fare")
    do = storage.written(S.mean_fare_by_zone(train, "DOLocationID", "DO_fare_avg"), "do-fare")
    mean = S.global_mean_fare(train).scalar()
    return rounded(add_zone_fares(city(spark, sf), pu, do, mean).select("row_key", "PU_fare_avg", "DO_fare_avg"))



import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ride_analytics.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8)
    session.sparkContext.setLogLevel("OFF")
    yield session


@pytest.fixture(scope="session")
def known(spark):
    """Trips whose fare is 3 + 2.5 * distance + zone effect + noise; 1 % planted extremes."""
    return known_trips(spark, 6000, 1.0)


def known_trips(spark, n, factor, seed=7):
    from pyspark.sql import functions as F
    z = F.col("id")
    df = (spark.range(n).withColumn("row_key", F.concat(F.lit(f"s{seed}-"), z))
          .withColumn("u", F.pmod(F.xxhash64(z, F.lit(seed)), F.lit(100000)) / 100000.0)
          .withColumn("v", F.pmod(F.xxhash64(z, F.lit(seed + 1)), F.lit(100000)) / 100000.0)
          .withColumn("g", F.sqrt(-2 * F.ln(F.greatest(F.col("u"), F.lit(1e-6)))) * F.cos(F.col("v") * 6.283185307))
          .withColumn("trip_distance", F.round(0.3 + 14.7 * F.pmod(F.xxhash64(z, F.lit(seed + 2)), F.lit(10000)) / 10000.0, 2))
          .withColumn("PULocationID", F.pmod(F.xxhash64(z, F.lit(seed + 3)), F.lit(20)).cast("int"))
          .withColumn("DOLocationID", F.pmod(F.xxhash64(z, F.lit(seed + 4)), F.lit(20)).cast("int"))
          .withColumn("hour_", F.pmod(F.xxhash64(z, F.lit(seed + 5)), F.lit(24)).cast("int"))
          .withColumn("day_", F.pmod(F.xxhash64(z, F.lit(seed + 6)), F.lit(28)).cast("int")))
    fare = (3 + 2.5 * F.col("trip_distance") + 0.2 * F.col("PULocationID") + F.col("g")) * factor
    planted = F.col("id") % 100 == 13
    return df.select(
        "row_key", F.lit(1).alias("VendorID"),
        F.expr("timestampadd(HOUR, hour_, timestampadd(DAY, day_, timestamp_ntz'2025-01-01 00:00:00'))").alias("tpep_pickup_datetime"),
        F.expr("timestampadd(SECOND, cast(trip_distance * 240 as int), timestampadd(HOUR, hour_, timestampadd(DAY, day_, timestamp_ntz'2025-01-01 00:00:00')))").alias("tpep_dropoff_datetime"),
        F.lit(1.0).alias("passenger_count"),
        F.when(planted, 60.0 + F.col("id") % 7).otherwise(F.col("trip_distance")).alias("trip_distance"),
        F.lit(1.0).alias("RatecodeID"), "PULocationID", "DOLocationID",
        F.when(planted, 0.5 + 0.1 * (F.col("id") % 5)).otherwise(F.greatest(F.lit(2.0), F.least(F.lit(50.0), F.round(fare, 2)))).alias("fare_amount"),
        F.lit(1.0).alias("extra"), F.lit(0.5).alias("mta_tax"), F.lit(1.0).alias("improvement_surcharge"),
        F.lit(2.5).alias("congestion_surcharge"), F.lit(0.75).alias("cbd_congestion_fee"))


@pytest.fixture(scope="session")
def known_zones(spark):
    from ride_analytics.sources.small import small_table
    return small_table(spark, [(i, "Home" if i < 18 else "Away", f"Zone {i}") for i in range(20)],
                       "LocationID int, Borough string, Zone string")


@pytest.fixture(scope="session")
def known_holidays(spark):
    import datetime
    from ride_analytics.sources.trips import holiday_table
    return holiday_table(spark, [(datetime.date(2025, 1, 1), "New Year's Day"), (datetime.date(2025, 1, 1), "twice"),
                                 (datetime.date(2025, 1, 20), "Day")])

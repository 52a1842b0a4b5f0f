"""Trips derived from an order star schema (line items, orders, customers, suppliers).

Gives every line item the columns of a trip, so that the jobs can be checked on
tables that other engines read too.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ride_analytics.config import Config
from ride_analytics.sources.trips import holiday_table

# Dates of the check calendar, inside the range of the orders.
CHECK_HOLIDAYS = (
    ("1995-07-04", "Independence Day"), ("1995-12-25", "Christmas Day"),
    ("1996-01-01", "New Year's Day"), ("1996-07-04", "Independence Day"),
    ("1996-11-28", "Thanksgiving"), ("1996-12-25", "Christmas Day"),
    ("1997-01-01", "New Year's Day"), ("1997-07-04", "Independence Day"),
    ("1998-01-01", "New Year's Day"), ("1998-12-25", "Christmas Day"),
    ("1999-07-04", "Independence Day"), ("2000-01-01", "New Year's Day"),
    ("2000-07-04", "Independence Day"), ("2000-12-25", "Christmas Day"),
)
CHECK_CONFIG = Config(home_borough="ASIA", feature_mode="FULL")
ALL_BOROUGHS = Config(home_borough=None, feature_mode="FULL")


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def star_trips(spark: SparkSession, folder: str) -> DataFrame:
    """One trip per line item. Spark orders and picks the joins: customers and
    suppliers are broadcast while their files stay under its threshold."""
    items = read_table(spark, folder, "lineitem")
    orders = read_table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    customers = read_table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    suppliers = read_table(spark, folder, "supplier").select("s_suppkey", "s_nationkey")
    joined = (items.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
                   .join(customers, F.col("o_custkey") == F.col("c_custkey"))
                   .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey")))
    hours = "cast(o_orderkey % 24 as int)"
    return joined.select(
        F.concat_ws("-", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber").alias("row_key"),
        (F.col("l_suppkey") % 2 + 1).cast("int").alias("VendorID"),
        F.expr(f"timestampadd(HOUR, {hours}, o_orderdate)").alias("tpep_pickup_datetime"),
        F.expr(f"timestampadd(HOUR, {hours}, l_shipdate)").alias("tpep_dropoff_datetime"),
        F.col("l_linenumber").cast("double").alias("passenger_count"),
        F.col("l_quantity").cast("double").alias("trip_distance"),
        F.when(F.col("l_returnflag") == "A", 1.0).when(F.col("l_returnflag") == "N", 2.0)
         .otherwise(3.0).alias("RatecodeID"),
        F.col("c_nationkey").cast("int").alias("PULocationID"),
        F.col("s_nationkey").cast("int").alias("DOLocationID"),
        # whole cents, halves up; round() on doubles differs between engines
        (F.floor(F.col("l_extendedprice") / 20 + 0.5) / 100).alias("fare_amount"),
        (F.floor(F.col("l_discount") * 100 - 0.5) / 100).alias("extra"),
        F.col("l_tax").cast("double").alias("mta_tax"),
        F.lit(1.0).alias("improvement_surcharge"),
        F.lit(2.5).alias("congestion_surcharge"),
        F.lit(0.75).alias("cbd_congestion_fee"),
    )


def star_zones(spark: SparkSession, folder: str) -> DataFrame:
    nations = read_table(spark, folder, "nation")
    regions = read_table(spark, folder, "region")
    return (nations.join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
                   .select(F.col("n_nationkey").cast("int").alias("LocationID"),
                           F.col("r_name").alias("Borough"), F.col("n_name").alias("Zone")))


def check_holidays(spark: SparkSession) -> DataFrame:
    return holiday_table(spark, [(dt.date.fromisoformat(d), n) for d, n in CHECK_HOLIDAYS])

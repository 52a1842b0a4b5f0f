"""Shared inputs of the registered queries, as DataFrames and as SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ride_analytics.operators.cleaning import clean_trips
from ride_analytics.sources.star_trips import (ALL_BOROUGHS, CHECK_CONFIG, CHECK_HOLIDAYS, check_holidays, star_trips,
                                               star_zones)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` is the statement its result must equal."""
    def add(fn):
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


# Where a value is cut between two last digits. Halfway would be 0.5, but means
# of cents often lie exactly there, and the last bits of a sum depend on order.
OFFSET = 0.3711


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles to a fixed number of digits, in arithmetic that every engine does alike."""
    scale = F.lit(float(10 ** digits))
    return df.select(*[(F.floor(F.col(f"`{n}`") * scale + F.lit(OFFSET)) / scale).alias(n) if t == "double"
                       else F.col(f"`{n}`") for n, t in df.dtypes])


# --- DataFrame inputs -----------------------------------------------------------
def trips(spark, sf):
    return star_trips(spark, sf)


def zones(spark, sf):
    return star_zones(spark, sf)


def city(spark, sf):
    """Clean trips of all boroughs."""
    return clean_trips(trips(spark, sf), zones(spark, sf), check_holidays(spark), ALL_BOROUGHS)


def home(spark, sf):
    """Clean trips inside the home borough."""
    return clean_trips(trips(spark, sf), zones(spark, sf), check_holidays(spark), CHECK_CONFIG)


def with_formula(df: DataFrame) -> DataFrame:
    """A prediction that every engine computes alike."""
    return df.withColumn("prediction", F.lit(20.0) + F.lit(0.2) * F.col("trip_distance") + F.lit(0.15) * F.col("hour"))


def scored(spark, sf):
    return with_formula(city(spark, sf))


# --- the same inputs in SQL -------------------------------------------------------
_KEPT = """VendorID, tpep_pickup_datetime, tpep_dropoff_datetime, passenger_count, trip_distance, RatecodeID,
  PULocationID, DOLocationID, fare_amount, extra, mta_tax, improvement_surcharge, congestion_surcharge,
  cbd_congestion_fee"""

CTE_TRIPS = """trips AS (
  SELECT concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber) AS row_key,
    CAST(l_suppkey % 2 + 1 AS INTEGER) AS VendorID,
    o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS tpep_pickup_datetime,
    l_shipdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS tpep_dropoff_datetime,
    CAST(l_linenumber AS DOUBLE) AS passenger_count,
    CAST(l_quantity AS DOUBLE) AS trip_distance,
    CASE l_returnflag WHEN 'A' THEN CAST(1 AS DOUBLE) WHEN 'N' THEN CAST(2 AS DOUBLE) ELSE CAST(3 AS DOUBLE) END AS RatecodeID,
    CAST(c_nationkey AS INTEGER) AS PULocationID, CAST(s_nationkey AS INTEGER) AS DOLocationID,
    floor(l_extendedprice / 20 + CAST(0.5 AS DOUBLE)) / 100 AS fare_amount,
    floor(l_discount * 100 - CAST(0.5 AS DOUBLE)) / 100 AS extra, CAST(l_tax AS DOUBLE) AS mta_tax,
    CAST(1.0 AS DOUBLE) AS improvement_surcharge, CAST(2.5 AS DOUBLE) AS congestion_surcharge,
    CAST(0.75 AS DOUBLE) AS cbd_congestion_fee
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey)"""

CTE_ZONES = """zones AS (
  SELECT CAST(n_nationkey AS INTEGER) AS LocationID, r_name AS Borough, n_name AS Zone
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""

CTE_HOLIDAYS = ("holidays AS (SELECT CAST(d AS DATE) AS date, name FROM (VALUES "
                + ", ".join("('{}', '{}')".format(d, n.replace("'", "''")) for d, n in CHECK_HOLIDAYS)
                + ") AS h(d, name))")

CTE_SOUND = """sound AS (
  SELECT * FROM trips
  WHERE extra >= 0 AND mta_tax >= 0 AND improvement_surcharge >= 0 AND congestion_surcharge >= 0
    AND cbd_congestion_fee >= 0 AND passenger_count BETWEEN 1 AND 6
    AND trip_distance > 0 AND fare_amount > 0 AND fare_amount <= 50 AND RatecodeID = 1)"""

CTE_TIMED = """timed AS (
  SELECT *, CAST(hour(tpep_pickup_datetime) AS INTEGER) AS "hour",
    CAST(isodow(tpep_pickup_datetime) - 1 AS INTEGER) AS "day of week"
  FROM sound)"""

CTE_CITY = """city AS (
  SELECT t.*,
    CASE WHEN "day of week" IN (5, 6) THEN 1 ELSE 0 END AS "is weekend",
    CASE WHEN "hour" >= 20 OR "hour" < 6 THEN 1 ELSE 0 END AS is_night_fare,
    CASE WHEN "hour" >= 16 AND "hour" < 20 AND "day of week" < 5 THEN 1 ELSE 0 END AS is_rush_hour,
    CASE WHEN CAST(tpep_pickup_datetime AS DATE) IN (SELECT date FROM holidays) THEN 1 ELSE 0 END AS is_holiday,
    p.Borough AS PU_Boro, d.Borough AS DO_Boro
  FROM timed t LEFT JOIN zones p ON t.PULocationID = p.LocationID LEFT JOIN zones d ON t.DOLocationID = d.LocationID)"""

CTE_HOME = "home AS (SELECT * FROM city WHERE PU_Boro = 'ASIA' AND DO_Boro = 'ASIA')"

CTE_SCORED = """scored AS (
  SELECT *, fare_amount - prediction AS residual, abs(fare_amount - prediction) AS abs_error,
    abs(fare_amount - prediction) / greatest(abs(fare_amount), CAST(2.220446049250313e-16 AS DOUBLE)) AS ape
  FROM (SELECT *, CAST(20.0 AS DOUBLE) + CAST(0.2 AS DOUBLE) * trip_distance
               + CAST(0.15 AS DOUBLE) * "hour" AS prediction FROM city))"""

CTE_SPEED = """speeds AS (
  SELECT *, CASE WHEN h = 0 THEN NULL WHEN trip_distance / h > 100 THEN 100 ELSE trip_distance / h END AS speed_mph
  FROM (SELECT *, date_diff('microsecond', tpep_pickup_datetime, tpep_dropoff_datetime) / CAST(3.6e9 AS DOUBLE) AS h
        FROM city))"""

_CHAIN = [("trips", CTE_TRIPS), ("zones", CTE_ZONES), ("holidays", CTE_HOLIDAYS), ("sound", CTE_SOUND),
          ("timed", CTE_TIMED), ("city", CTE_CITY), ("home", CTE_HOME), ("scored", CTE_SCORED), ("speeds", CTE_SPEED)]


def sql(body: str, *more: str, doubles: tuple | list = (), digits: int = 6) -> str:
    """``body`` over the views above; ``more`` are further views before it, and
    ``doubles`` the result columns to round."""
    text = body
    if doubles:
        swaps = ", ".join(f'floor("{c}" * CAST(1e{digits} AS DOUBLE) + CAST({OFFSET} AS DOUBLE)) / CAST(1e{digits} AS DOUBLE) AS "{c}"' for c in doubles)
        text = f"SELECT * REPLACE ({swaps}) FROM ({body}) AS q"
    return "WITH " + ",\n".join([c for _, c in _CHAIN] + list(more)) + "\n" + text


def case_bins(value: str, spec, outcomes=None, types: str = "") -> str:
    """The CASE expression of a BinSpec."""
    parts = []
    for i, (lo, hi) in enumerate(zip(spec.edges, spec.edges[1:])):
        out = f"'{spec.labels[i]}'" if outcomes is None else str(outcomes[i])
        low = f"{value} > {lo}" if spec.closed == "right" else f"{value} >= {lo}"
        high = "" if hi == float("inf") else (f" AND {value} <= {hi}" if spec.closed == "right" else f" AND {value} < {hi}")
        parts.append(f"WHEN {low}{high} THEN {out}")
    return "CASE " + " ".join(parts) + " END"


def values_bins(spec, label: str, order: str = "bin_order", name: str = "bins") -> str:
    rows = ", ".join(f"('{lab}', CAST({i} AS INTEGER))" for i, lab in enumerate(spec.labels))
    return f'{name} AS (SELECT * FROM (VALUES {rows}) AS b("{label}", {order}))'


def hash_sql(key: str = "row_key", salt: str = "") -> str:
    text = key if not salt else f"concat('{salt}:', {key})"
    return f"CAST(concat('0x', substr(md5({text}), 1, 8)) AS BIGINT)"


def box_sql(source: str, keys: str, value: str) -> str:
    """Box statistics of ``value`` in ``source`` by ``keys`` (comma-separated)."""
    on = " AND ".join(f"s.{k.strip()} = b.{k.strip()}" for k in keys.split(","))
    sel = ", ".join(f"b.{k.strip()}" for k in keys.split(","))
    return f"""SELECT {sel}, max(b.n) AS n, max(b.q1) AS q1, max(b.m) AS median, max(b.q3) AS q3,
      least(min(CASE WHEN s.{value} >= b.q1 - (b.q3 - b.q1) * 1.5 THEN s.{value} END), max(b.q1)) AS whisker_low,
      greatest(max(CASE WHEN s.{value} <= b.q3 + (b.q3 - b.q1) * 1.5 THEN s.{value} END), max(b.q3)) AS whisker_high
    FROM {source} s JOIN (SELECT {keys}, count({value}) AS n, quantile_cont({value}, 0.25) AS q1,
        quantile_cont({value}, 0.5) AS m, quantile_cont({value}, 0.75) AS q3 FROM {source} GROUP BY {keys}) b ON {on}
    GROUP BY {sel}"""

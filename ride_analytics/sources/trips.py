"""Typed scans of trips, zones and holidays."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ride_analytics.config import Config
from ride_analytics.sources.small import small_table

TRIP_TYPES = {
    "VendorID": T.IntegerType(),
    "tpep_pickup_datetime": T.TimestampNTZType(),
    "tpep_dropoff_datetime": T.TimestampNTZType(),
    "passenger_count": T.DoubleType(),
    "trip_distance": T.DoubleType(),
    "RatecodeID": T.DoubleType(),
    "PULocationID": T.IntegerType(),
    "DOLocationID": T.IntegerType(),
    "fare_amount": T.DoubleType(),
    "extra": T.DoubleType(),
    "mta_tax": T.DoubleType(),
    "improvement_surcharge": T.DoubleType(),
    "congestion_surcharge": T.DoubleType(),
    "cbd_congestion_fee": T.DoubleType(),
}
TRIP_SCHEMA = T.StructType([T.StructField(n, t, True) for n, t in TRIP_TYPES.items()])
ZONE_SCHEMA = T.StructType([
    T.StructField("LocationID", T.IntegerType()),
    T.StructField("Borough", T.StringType()),
    T.StructField("Zone", T.StringType()),
])
HOLIDAY_SCHEMA = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("name", T.StringType()),
])


def require_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Fail while the plan is built, not after the scan, when a column is absent."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df


def existing_columns(df: DataFrame, candidates: Sequence[str]) -> list[str]:
    return [c for c in candidates if c in df.columns]


def keep_required(df: DataFrame, cfg: Config) -> DataFrame:
    """Projection onto the kept columns (and a row key, where there is one)."""
    require_columns(df, cfg.required_columns)
    key = [c for c in ("row_key",) if c in df.columns]
    return df.select(*key, *existing_columns(df, cfg.keep_columns))


def load_trips(spark: SparkSession, paths, months: Sequence[str] | None = None,
               cfg: Config = Config()) -> DataFrame:
    """Parquet scan of trips.

    ``months`` (``'YYYY-MM'``) restricts the scan: by the ``pickup_month``
    partition column where the data is laid out by it, so that other months are
    never listed, otherwise by a range on the pickup time, which Parquet
    row-group statistics can skip on.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    if len(paths) > 1:  # months may differ in types and order of columns: each by its own schema
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), (load_trips(spark, p, months, cfg) for p in paths))
    raw = spark.read.parquet(*paths)
    require_columns(raw, cfg.required_columns)
    if months is not None:
        if "pickup_month" in raw.columns:
            raw = raw.where(F.col("pickup_month").cast("string").isin(*months))
        else:
            raw = raw.where(in_months("tpep_pickup_datetime", months))
    kept = existing_columns(raw, cfg.keep_columns)
    key = F.col("row_key") if "row_key" in raw.columns else content_key(kept)
    return raw.select(key.alias("row_key"), *[F.col(c).cast(TRIP_TYPES[c]).alias(c) for c in kept])


def content_key(columns: Sequence[str]):
    """Row key from the row's own values, for sources without one: the same after
    a retry, unlike a generated number. Only rows equal in every column share it."""
    return F.md5(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]))


def in_months(column: str, months: Sequence[str]):
    """Half-open month ranges, so that the predicate reaches the scan."""
    test = F.lit(False)
    for m in months:
        first = f"timestamp_ntz'{m}-01 00:00:00'"
        test = test | F.expr(f"`{column}` >= {first} AND `{column}` < {first} + INTERVAL 1 MONTH")
    return test


def other_month_path(path: str, month: str, other: str) -> str:
    """Path of another month's file; an error if the path names no such month."""
    changed = path.replace(month, other)
    if changed == path:
        raise ValueError(f"{path!r} does not name month {month!r}")
    return changed


def load_zones(spark: SparkSession, path: str) -> DataFrame:
    """Zone lookup: a CSV file with a header; further columns are ignored."""
    raw = spark.read.option("header", True).csv(path)
    require_columns(raw, ZONE_SCHEMA.fieldNames())
    return raw.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in ZONE_SCHEMA])


def holiday_table(spark: SparkSession, dates: Iterable[tuple]) -> DataFrame:
    """Date dimension from ``(date, name)`` pairs."""
    return small_table(spark, dates, HOLIDAY_SCHEMA)


def load_holidays(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).schema(HOLIDAY_SCHEMA).csv(path)

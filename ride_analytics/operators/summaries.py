"""Counts, shares and means of trips by zone, borough, hour and range."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ride_analytics.functions import columns as X
from ride_analytics.functions.bins import DISTANCE_BINS, BinSpec
from ride_analytics.operators.cleaning import zone_names
from ride_analytics.operators.quantiles import box_statistics, grouped_median
from ride_analytics.sources.storage import cut


def mean_by(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.avg(value).alias(name))


def mean_fare_by_zone(df: DataFrame, key: str, name: str) -> DataFrame:
    return mean_by(df, [key], "fare_amount", name)


def global_mean_fare(df: DataFrame) -> DataFrame:
    return df.agg(F.avg("fare_amount").alias("mean_fare"))


def zone_profile(df: DataFrame) -> DataFrame:
    return df.groupBy("PULocationID").agg(F.avg("fare_amount").alias("mean_fare"),
                                          F.avg("trip_distance").alias("mean_distance"))


def trips_by(df: DataFrame, *keys: str, name: str = "trip_count") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def location_volume(df: DataFrame, key: str) -> DataFrame:
    """Trips per location in id order; the busiest and the quietest are marked."""
    counts = trips_by(df.where(F.col(key).isNotNull()), key)
    whole = Window.partitionBy()          # one row per location id
    return (counts.withColumn("mark", F.when(F.col("trip_count") == F.max("trip_count").over(whole), "peak")
                                       .when(F.col("trip_count") == F.min("trip_count").over(whole), "low")
                                       .otherwise("other"))
                  .orderBy(key))


def with_share(counts: DataFrame, count: str = "trip_count", name: str = "share_pct") -> DataFrame:
    """Percentage of the total; ``counts`` is a summary with few rows."""
    return counts.withColumn(name, F.col(count) * 100.0 / F.sum(count).over(Window.partitionBy()))


def borough_volume(df: DataFrame, key: str = "PU_Boro") -> DataFrame:
    """Most trips first; trips without a borough are left out, as is usual for value counts."""
    return trips_by(df.where(F.col(key).isNotNull()), key).orderBy(F.desc("trip_count"), key)


def borough_share(df: DataFrame, key: str = "PU_Boro") -> DataFrame:
    return with_share(borough_volume(df, key)).orderBy(F.desc("trip_count"), key)


def with_distance_bin(df: DataFrame, spec: BinSpec = DISTANCE_BINS, name: str = "distance bin") -> DataFrame:
    d = F.col("trip_distance")
    return df.withColumns({name: spec.label(d), f"{name} order": spec.ordinal(d)})


def distance_bin_counts(df: DataFrame, spec: BinSpec = DISTANCE_BINS) -> DataFrame:
    """Trips per distance range, empty ranges included."""
    counts = trips_by(with_distance_bin(df, spec), "distance bin")
    return (spec.table(df.sparkSession, "distance bin", "bin_order").join(counts, "distance bin", "left")
                .withColumn("trip_count", F.coalesce("trip_count", F.lit(0).cast("bigint"))))


def distance_bin_share(df: DataFrame, spec: BinSpec = DISTANCE_BINS) -> DataFrame:
    return with_share(distance_bin_counts(df, spec)).orderBy("bin_order")


def fare_per_mile_by_distance(df: DataFrame, spec: BinSpec = DISTANCE_BINS) -> DataFrame:
    """Median fare per mile of the ranges that occur."""
    rated = with_distance_bin(df, spec).withColumn(
        "fare per mile", X.ratio(F.col("fare_amount"), F.col("trip_distance"))).where(F.col("distance bin").isNotNull())
    return grouped_median(rated, ["distance bin", "distance bin order"], "fare per mile", "median_fare_per_mile")


def fare_boxes_by_distance(df: DataFrame, spec: BinSpec = DISTANCE_BINS) -> DataFrame:
    binned = with_distance_bin(df, spec).where(F.col("distance bin").isNotNull())
    return box_statistics(binned, ["distance bin", "distance bin order"], "fare_amount")


def fee_incidence(df: DataFrame, fees: Sequence[str]) -> DataFrame:
    """Percentage of trips with a positive fee, one row per fee column."""
    wide = df.agg(*[(F.avg((F.col(c) > 0).cast("double")) * 100).alias(c) for c in fees])
    return wide.unpivot([], list(fees), "fee", "pct_trips").withColumn("label", F.replace("fee", F.lit("_"), F.lit(" ")))


def fare_heatmap(df: DataFrame) -> DataFrame:
    """Mean fare: one row per weekday (Monday is 0), one column per hour."""
    return df.groupBy("day of week").pivot("hour", list(range(24))).agg(F.avg("fare_amount"))


def fare_heatmap_long(df: DataFrame) -> DataFrame:
    return (df.groupBy("day of week", "hour").agg(F.avg("fare_amount").alias("mean_fare"))
              .withColumn("day", X.weekday_name(F.col("day of week"))))


def hourly_volume(df: DataFrame) -> DataFrame:
    return (trips_by(df, "hour", "is weekend")
            .withColumn("day type", X.day_type(F.col("is weekend"))))


def mean_fare_by_hour(df: DataFrame) -> DataFrame:
    return mean_by(df, ["hour"], "fare_amount", "mean_fare")


def rate_code_distribution(raw: DataFrame) -> DataFrame:
    return trips_by(raw, "RatecodeID")


def zone_demand(df: DataFrame, zones: DataFrame, borough: str | None, n: int = 20) -> DataFrame:
    """The ``n`` busiest and the ``n`` quietest pickup zones, named; ids break ties."""
    counts = cut(trips_by(df, "PULocationID"))      # one pass over the trips for both ends
    ends = []
    for side, order in (("top", F.desc("trip_count")), ("bottom", F.asc("trip_count"))):
        ends.append(counts.orderBy(order, "PULocationID").limit(n).withColumn("side", F.lit(side)))
    return zone_names(ends[0].unionByName(ends[1]), zones, borough)


def zone_map_table(df: DataFrame, zones: DataFrame, borough: str | None = None) -> DataFrame:
    """Mean fare and trips of every zone of the borough (any letter case);
    zones without trips stay, with nulls."""
    per_zone = df.groupBy("PULocationID").agg(F.avg("fare_amount").alias("mean_fare"),
                                              F.count(F.lit(1)).alias("trip_count"))
    dim = zones if borough is None else zones.where(F.lower("Borough") == borough.lower())
    return (dim.join(per_zone, F.col("LocationID") == F.col("PULocationID"), "left").drop("PULocationID"))


def value_range(df: DataFrame, *columns: str) -> DataFrame:
    """Common minimum and maximum of columns, and the axis limit above them. NaN counts as null."""
    known = [F.when(~F.isnan(F.col(f"`{c}`").cast("double")), F.col(f"`{c}`")) for c in columns]
    lo, hi = [F.min(c) for c in known], [F.max(c) for c in known]
    low = F.least(*lo) if len(lo) > 1 else lo[0]
    high = F.greatest(*hi) if len(hi) > 1 else hi[0]
    return df.agg(low.alias("low"), high.alias("high"), X.view_cap(high).alias("view_cap"))

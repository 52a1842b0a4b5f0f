"""Row rules and derived columns of clean trips."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ride_analytics.config import Config
from ride_analytics.functions import columns as X
from ride_analytics.sources.trips import existing_columns, keep_required, require_columns


def complete(df: DataFrame, cfg: Config = Config()) -> Column:
    """No kept column is null or NaN. Must be tested before the range rules:
    in Spark NaN compares greater than every number."""
    types = dict(df.dtypes)
    return X.all_of([
        F.col(c).isNotNull() & ~F.isnan(c) if types[c] in ("double", "float") else F.col(c).isNotNull()
        for c in existing_columns(df, cfg.keep_columns)])


def drop_incomplete(df: DataFrame, cfg: Config = Config()) -> DataFrame:
    return df.na.drop("any", subset=existing_columns(df, cfg.keep_columns))


def fees_not_negative(df: DataFrame, cfg: Config = Config()) -> Column:
    require_columns(df, [c for c in cfg.fee_columns if c not in cfg.optional_fees])
    return X.all_of([F.col(c) >= 0 for c in existing_columns(df, cfg.fee_columns)])


def passengers_plausible() -> Column:
    return F.col("passenger_count").between(1, 6)


def distance_and_fare_plausible(cfg: Config = Config()) -> Column:
    return (F.col("trip_distance") > 0) & (F.col("fare_amount") > 0) & (F.col("fare_amount") <= cfg.max_fare)


def standard_rate() -> Column:
    return F.col("RatecodeID") == 1


def integrity_filter(df: DataFrame, cfg: Config = Config()) -> DataFrame:
    """All row rules in one filter, next to the scan.

    One condition, not a chain of filters: over derived columns the optimizer
    spends seconds on combining a chain.
    """
    return df.where(complete(df, cfg) & fees_not_negative(df, cfg) & passengers_plausible()
                    & distance_and_fare_plausible(cfg) & standard_rate())


def with_time_columns(df: DataFrame) -> DataFrame:
    ts = F.col("tpep_pickup_datetime").cast("timestamp_ntz")
    return (df.withColumns({"hour": X.hour_of(ts), "day of week": X.day_of_week(ts)})
              .withColumns({
                  "is weekend": X.is_weekend(F.col("day of week")),
                  "is_night_fare": X.is_night(F.col("hour")),
                  "is_rush_hour": X.is_rush(F.col("hour"), F.col("day of week")),
              }))


def with_holiday_flag(df: DataFrame, holidays: DataFrame) -> DataFrame:
    """Date-dimension lookup in place of a calendar call per row."""
    days = holidays.select(F.col("date").alias("_holiday")).distinct()
    joined = df.join(days, F.to_date("tpep_pickup_datetime") == F.col("_holiday"), "left")
    return joined.withColumn("is_holiday", F.col("_holiday").isNotNull().cast("int")).drop("_holiday")


def with_boroughs(df: DataFrame, zones: DataFrame) -> DataFrame:
    """The zone table joined twice, once per trip end; unknown ids give null."""
    pu = zones.select(F.col("LocationID").alias("_pu"), F.col("Borough").alias("PU_Boro"))
    do = zones.select(F.col("LocationID").alias("_do"), F.col("Borough").alias("DO_Boro"))
    return (df.join(pu, F.col("PULocationID") == F.col("_pu"), "left")
              .join(do, F.col("DOLocationID") == F.col("_do"), "left")
              .drop("_pu", "_do"))


def in_borough(borough: str) -> Column:
    return (F.col("PU_Boro") == borough) & (F.col("DO_Boro") == borough)


def zone_names(counts: DataFrame, zones: DataFrame, borough: str | None, key: str = "PULocationID",
               name: str = "Zone") -> DataFrame:
    """Zone name of an id, looked up among one borough's zones; others keep the id."""
    dim = zones if borough is None else zones.where(F.col("Borough") == borough)
    dim = dim.select(F.col("LocationID").alias("_id"), F.col("Zone").alias("_zone"))
    return (counts.join(dim, F.col(key) == F.col("_id"), "left")
                  .withColumn(name, F.coalesce(F.col("_zone"), F.col(key).cast("string")))
                  .drop("_id", "_zone"))


def clean_trips(trips: DataFrame, zones: DataFrame, holidays: DataFrame, cfg: Config = Config()) -> DataFrame:
    """Kept columns, all row rules, time flags, holiday flag, boroughs of both ends,
    and (where a home borough is set) only trips inside it."""
    df = integrity_filter(keep_required(trips, cfg), cfg)
    df = with_boroughs(with_holiday_flag(with_time_columns(df), holidays), zones)
    return df if cfg.home_borough is None else df.where(in_borough(cfg.home_borough))


def row_funnel(trips: DataFrame, zones: DataFrame, cfg: Config, outlier_flag: str | None = None) -> DataFrame:
    """Rows left after each step, all counted in one pass over the trips."""
    keep = keep_required(trips, cfg)
    if outlier_flag is not None:
        keep = trips.select(*keep.columns, outlier_flag)
    passed = (complete(keep, cfg) & fees_not_negative(keep, cfg) & passengers_plausible()
              & distance_and_fare_plausible(cfg) & standard_rate())
    tagged = with_boroughs(keep, zones).withColumn("_ok", F.coalesce(passed, F.lit(False)))
    home = F.lit(True) if cfg.home_borough is None else in_borough(cfg.home_borough)
    tagged = tagged.withColumn("_home", F.col("_ok") & F.coalesce(home, F.lit(False)))
    steps = [("raw", F.lit(True)), ("integrity", F.col("_ok")), ("borough", F.col("_home"))]
    if outlier_flag is not None:
        steps.append(("outliers removed", F.col("_home") & ~F.col(outlier_flag)))
    counts = tagged.agg(*[F.count_if(cond).alias(name) for name, cond in steps])
    return (counts.unpivot([], [n for n, _ in steps], "step", "n")
                  .withColumn("step_order", F.array_position(F.array(*[F.lit(n) for n, _ in steps]), F.col("step")).cast("int") - 1))

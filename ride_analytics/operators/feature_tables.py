"""Feature tables learned from training trips, and their lookups."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ride_analytics.config import Config
from ride_analytics.functions import columns as X
from ride_analytics.operators.joins import bounded, null_safe_join
from ride_analytics.operators.quantiles import grouped_median
from ride_analytics.operators.zone_clusters import cluster_zones
from ride_analytics.sources.storage import cut, fresh_path, written

ROUTE = ["PULocationID", "DOLocationID", "hour"]
ZONE_HOUR = ["PULocationID", "hour"]
GROUP_ROWS = 1_000_000    # speeds of a route that one task may sort


def with_speed(df: DataFrame) -> DataFrame:
    if "speed_mph" in df.columns:  # known already
        return df
    hours = X.duration_hours("tpep_pickup_datetime", "tpep_dropoff_datetime")
    return df.withColumn("speed_mph", X.speed_mph(F.col("trip_distance"), hours))


def speed_rows(df: DataFrame) -> DataFrame:
    """What every table is learned from, written once: route, hour, speed, fare and distance of each trip."""
    return written(with_speed(df).select(*ROUTE, "speed_mph", "fare_amount", "trip_distance"), "speed-rows")


def route_sums(df: DataFrame) -> DataFrame:
    """Counts and sums per route and hour, merged before the shuffle: all means
    follow from them, and how many speeds a route has."""
    return cut(with_speed(df).groupBy(*ROUTE).agg(
        F.count(F.lit(1)).alias("n"), F.count("speed_mph").alias("speeds"), F.sum("fare_amount").alias("fare"), F.sum("trip_distance").alias("miles")))


def _speeds(df: DataFrame) -> DataFrame:
    return with_speed(df).select(*ROUTE, "speed_mph")


def _medians(rows: DataFrame, keys: list[str], sizes: DataFrame, name: str, approx: bool, stored: bool) -> DataFrame:
    """Median speed per group. A group of at most ``GROUP_ROWS`` speeds, by the
    counts in ``sizes``, has it in the one shuffle of the trips by group; larger
    ones are narrowed down."""
    if approx:
        return grouped_median(rows, keys, "speed_mph", name, approx=True)
    median = F.percentile("speed_mph", F.lit(0.5)).alias(name)
    large = sizes.where(F.col("speeds") > GROUP_ROWS).select(*keys)
    if large.isEmpty():
        return rows.groupBy(*keys).agg(median)

    def in_large(how):
        return null_safe_join(rows, bounded(large), keys, how)

    return in_large("left_anti").groupBy(*keys).agg(median).unionByName(
        grouped_median(in_large("left_semi"), keys, "speed_mph", name, stored=stored))


def route_stats(df: DataFrame, approx: bool = False, sums: DataFrame | None = None, stored: bool = False) -> DataFrame:
    """Median speed and number of speeds per pickup, dropoff and hour. Routes with
    only null speeds stay, with a null median."""
    sums = route_sums(df) if sums is None else sums
    medians = _medians(_speeds(df), ROUTE, sums, "route_avg_speed", approx, stored)
    return null_safe_join(sums.select(*ROUTE, F.col("speeds").alias("route_popularity")), medians, ROUTE, "left").select(
        *ROUTE, "route_avg_speed", "route_popularity")


def zone_hour_speed(df: DataFrame, approx: bool = False, sums: DataFrame | None = None, stored: bool = False) -> DataFrame:
    """Median speed per pickup zone and hour; those with only null speeds stay, with a null median."""
    sums = route_sums(df) if sums is None else sums
    numbers = _speeds(df).withColumn("speed_mph", F.when(~F.isnan("speed_mph"), F.col("speed_mph")))     # NaN does not count
    sizes = sums.groupBy(*ZONE_HOUR).agg(F.sum("speeds").alias("speeds"))
    medians = _medians(numbers, ZONE_HOUR, sizes, "zone_hour_speed", approx, stored)
    return null_safe_join(sums.select(*ZONE_HOUR).distinct(), medians, ZONE_HOUR, "left").select(*ZONE_HOUR, "zone_hour_speed")


def global_speed(df: DataFrame, approx: bool = False, stored: bool = False) -> DataFrame:
    return grouped_median(_speeds(df), [], "speed_mph", "median_speed", approx=approx, stored=stored)


@dataclass
class FeatureTables:
    """Everything scoring needs besides the model. All tables are small:
    zones, zone-hours and routes, never trips."""

    pu_fare: DataFrame         # PULocationID, PU_fare_avg
    do_fare: DataFrame         # DOLocationID, DO_fare_avg
    zone_cluster: DataFrame    # PULocationID, mean_fare, mean_distance, pickup_cluster
    route_stats: DataFrame     # PULocationID, DOLocationID, hour, route_avg_speed, route_popularity
    zone_hour_speed: DataFrame  # PULocationID, hour, zone_hour_speed
    globals: DataFrame         # mean_fare, median_speed (one row)

    def save(self, root: str) -> None:
        def write(name: str) -> None:
            getattr(self, name).write.mode("overwrite").parquet(f"{root}/{name}")

        with ThreadPoolExecutor(max_workers=4) as pool:      # small tables, written side by side
            list(pool.map(write, [f.name for f in fields(self)]))

    @classmethod
    def load(cls, spark: SparkSession, root: str) -> FeatureTables:
        return cls(**{f.name: spark.read.parquet(f"{root}/{f.name}") for f in fields(cls)})


def learn_tables(train: DataFrame, cfg: Config = Config(), stored: bool = False) -> dict[str, DataFrame]:
    """All tables but the clusters. Zone means come from the sums per route and hour.

    The trips are read once: sums and all medians come from the written rows of ``speed_rows``,
    or from ``train`` itself where that is a written table with speeds (``stored``).
    """
    train = train if stored else speed_rows(train)
    with ThreadPoolExecutor(max_workers=2) as pool:      # chains of short jobs
        speed = pool.submit(global_speed, train, cfg.approx_medians, True)
        sums = route_sums(train)
        overall = speed.result().select("median_speed").scalar()

    def mean(total, name):
        return (F.sum(total) / F.sum("n")).alias(name)

    return {
        "pu_fare": sums.groupBy("PULocationID").agg(mean("fare", "PU_fare_avg")),
        "do_fare": sums.groupBy("DOLocationID").agg(mean("fare", "DO_fare_avg")),
        "profile": sums.groupBy("PULocationID").agg(mean("fare", "mean_fare"), mean("miles", "mean_distance")),
        "route_stats": route_stats(train, cfg.approx_medians, sums, stored=True),
        "zone_hour_speed": zone_hour_speed(train, cfg.approx_medians, sums, stored=True),
        "globals": sums.agg(mean("fare", "mean_fare")).select("mean_fare", overall.alias("median_speed")),
    }


def fit_feature_tables(train: DataFrame, cfg: Config = Config(), root: str | None = None, stored: bool = False) -> FeatureTables:
    """Learn all tables and write them under ``root``. ``stored``: see ``learn_tables``."""
    spark = train.sparkSession
    root = root or fresh_path(spark, "feature-tables")
    learned = learn_tables(train, cfg, stored)
    profile = learned.pop("profile")

    def clusters(path: str) -> None:
        cluster_zones(written(profile, "zone-profile"), cfg.zone_clusters, cfg.cluster_rounds).write.mode("overwrite").parquet(path)

    with ThreadPoolExecutor(max_workers=6) as pool:      # small tables, written side by side
        done = [pool.submit(clusters, f"{root}/zone_cluster")]
        done += [pool.submit(table.write.mode("overwrite").parquet, f"{root}/{name}") for name, table in learned.items()]
        for d in done:
            d.result()
    return FeatureTables.load(spark, root)


def add_zone_fares(df: DataFrame, pu_fare: DataFrame, do_fare: DataFrame, mean_fare) -> DataFrame:
    """Mean fare of both zones; a zone never seen in training gets the global mean."""
    out = df.join(bounded(pu_fare), "PULocationID", "left").join(bounded(do_fare), "DOLocationID", "left")
    return out.withColumns({c: F.coalesce(F.col(c), mean_fare) for c in ("PU_fare_avg", "DO_fare_avg")})


def add_clusters(df: DataFrame, zone_cluster: DataFrame) -> DataFrame:
    ids = zone_cluster.select("PULocationID", "pickup_cluster")
    return (df.join(bounded(ids), "PULocationID", "left")
              .withColumn("pickup_cluster", F.coalesce("pickup_cluster", F.lit(-1))))


def add_route_features(df: DataFrame, routes: DataFrame, backup: DataFrame, median_speed) -> DataFrame:
    """Route speed, else the pickup zone's at that hour, else the global median.
    The test is on the median: a known route without any speed falls back too."""
    out = df.join(bounded(routes), ROUTE, "left").join(bounded(backup), ZONE_HOUR, "left")
    return (out.withColumn("route_avg_speed", F.coalesce("route_avg_speed", "zone_hour_speed", median_speed))
               .withColumn("route_popularity", F.coalesce("route_popularity", F.lit(0).cast("bigint")))
               .drop("zone_hour_speed"))


def apply_feature_tables(df: DataFrame, tables: FeatureTables) -> DataFrame:
    """All lookups. Tables of a checked size are broadcast, so that the trips are
    not shuffled; larger ones are left to Spark's joins."""
    values = tables.globals.first()      # one row
    order = df.columns
    out = add_zone_fares(df, tables.pu_fare, tables.do_fare, F.lit(values["mean_fare"]))
    out = add_clusters(out, tables.zone_cluster)
    out = add_route_features(out, tables.route_stats, tables.zone_hour_speed, F.lit(values["median_speed"]))
    new = ["PU_fare_avg", "DO_fare_avg", "pickup_cluster", "route_avg_speed", "route_popularity"]
    return out.select(*[F.col(f"`{c}`") for c in order], *new)


def out_of_fold_zone_fares(train: DataFrame, key: str, name: str, fold: str = "fold") -> DataFrame:
    """Mean fare of the zone over the *other* folds, so that no row meets its own
    fare; without another fold's trips, the mean of all other folds."""
    per = train.groupBy(key, fold).agg(F.sum("fare_amount").alias("_sum"), F.count("fare_amount").alias("_num"))
    zone = per.groupBy(key).agg(F.sum("_sum").alias("_zone_sum"), F.sum("_num").alias("_zone_num"))
    whole = per.agg(F.sum("_sum").alias("s"), F.sum("_num").alias("n"))
    rest = per.groupBy(fold).agg(
        F.try_divide(whole.select("s").scalar() - F.sum("_sum"), whole.select("n").scalar() - F.sum("_num")).alias("_rest"))
    own = F.try_divide(F.col("_zone_sum") - F.col("_sum"), F.col("_zone_num") - F.col("_num"))
    table = cut(per.join(zone, key).join(rest, fold).select(key, fold, F.coalesce(own, F.col("_rest")).alias(name)))
    return train.join(bounded(table), [key, fold], "left")


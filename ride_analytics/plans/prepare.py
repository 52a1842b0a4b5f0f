"""From raw trips to training and test tables."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ride_analytics.config import Config
from ride_analytics.functions.bins import FARE_CLASSES
from ride_analytics.operators.cleaning import clean_trips
from ride_analytics.operators.feature_tables import ROUTE, FeatureTables, apply_feature_tables, fit_feature_tables, with_speed
from ride_analytics.operators.isolation_forest import IsolationForestModel, fit_outliers, inliers
from ride_analytics.operators.sampling import KEY, balance_classes, with_fold, with_test_flag
from ride_analytics.sources.storage import cached_table, exists, fingerprint, fresh_path

REPORTED = ("PULocationID", "hour", "day of week", "trip_distance", "PU_fare_avg")     # what the reports group by


@dataclass
class Prepared:
    train: DataFrame
    test: DataFrame
    tables: FeatureTables
    forest: IsolationForestModel
    root: str


def fit_forest(clean: DataFrame, cfg: Config) -> IsolationForestModel:
    seen = clean
    if cfg.outlier_fit_on == "train":
        seen = with_test_flag(clean, cfg.test_percent).where(~F.col("is_test"))
    return fit_outliers(seen, cfg.contamination, cfg.seed)


def without_outliers(clean: DataFrame, cfg: Config, forest: IsolationForestModel | None = None):
    """Inliers, and the forest that decided. The forest sees all clean trips, or
    only the training part with ``outlier_fit_on='train'``."""
    forest = forest or fit_forest(clean, cfg)
    return inliers(forest.transform_repeated(clean)).drop("is outlier", "outlier score"), forest


def prepare(trips: DataFrame, zones: DataFrame, holidays: DataFrame, cfg: Config, root: str | None = None) -> Prepared:
    """Clean, drop outliers, split, learn the feature tables from the training
    part, look them up for both parts, balance the training part, assign folds.

    Everything is written under ``root`` and a key of the settings and the
    input; a second call with the same of both reads it back.
    """
    spark = trips.sparkSession
    base = f"{root or fresh_path(spark, 'prepared')}/{cfg.key()}-{fingerprint(trips, zones, holidays)}"
    # Stored once and narrow: forest, cut-off and split each read it.
    clean = cached_table(spark, base, "clean", lambda: model_rows(clean_trips(trips, zones, holidays, cfg), cfg))
    if exists(spark, f"{base}/forest/meta/_SUCCESS"):
        forest = IsolationForestModel.load(spark, f"{base}/forest")
    else:
        forest = fit_forest(clean, cfg)
        forest.save(spark, f"{base}/forest")
    kept = cached_table(spark, base, "kept", lambda: model_rows(without_outliers(clean, cfg, forest)[0], cfg))
    train, test = kept.where(~F.col("is_test")), kept.where(F.col("is_test"))
    if exists(spark, f"{base}/tables/globals/_SUCCESS"):
        tables = FeatureTables.load(spark, f"{base}/tables")
    else:
        tables = fit_feature_tables(train, cfg, f"{base}/tables", stored="speed_mph" in kept.columns)
    parts = {"train": lambda: training_rows(train, tables, cfg), "test": lambda: model_columns(apply_feature_tables(test, tables), cfg)}
    with ThreadPoolExecutor(max_workers=len(parts)) as pool:      # written side by side
        stored = dict(zip(parts, pool.map(lambda name: cached_table(spark, base, name, parts[name]), parts)))
    return Prepared(**stored, tables=tables, forest=forest, root=base)


def model_rows(clean: DataFrame, cfg: Config) -> DataFrame:
    """What the forest, the feature tables, the models and the reports read of a trip: key, route, speed, plain features, target, test flag."""
    flagged = with_speed(clean) if "is_test" in clean.columns else with_test_flag(with_speed(clean), cfg.test_percent)
    wanted = {KEY, *ROUTE, *cfg.features, *REPORTED, cfg.target, "fare_amount", "speed_mph", "is_test"}
    return flagged.select(*[F.col(f"`{c}`") for c in flagged.columns if c in wanted])


def model_columns(df: DataFrame, cfg: Config) -> DataFrame:
    """Key, features of the chosen set, target, and what the reports group by."""
    extra = [c for c in REPORTED if c not in cfg.features]
    return df.select(KEY, *[F.col(f"`{c}`") for c in (*cfg.features, *extra)], cfg.target)


def training_rows(train: DataFrame, tables: FeatureTables, cfg: Config) -> DataFrame:
    """Features, balanced classes and folds. The fold follows the source row, so
    that copies of a row never meet across folds, unless ``legacy_folds``."""
    rows = model_columns(apply_feature_tables(train, tables), cfg)
    if cfg.balance:
        rows = balance_classes(rows, cfg.balance_target, FARE_CLASSES, cfg.target, seed=cfg.seed)
    else:
        rows = rows.withColumn("copy", F.lit(0).cast("bigint"))
    key = F.concat_ws("#", KEY, "copy") if cfg.legacy_folds else F.col(KEY)
    return with_fold(rows, cfg.folds, key)


def load_prepared(spark: SparkSession, base: str) -> Prepared:
    """The tables that ``prepare`` left in ``Prepared.root``."""
    return Prepared(spark.read.parquet(f"{base}/train"), spark.read.parquet(f"{base}/test"),
                    FeatureTables.load(spark, f"{base}/tables"), IsolationForestModel.load(spark, f"{base}/forest"), base)

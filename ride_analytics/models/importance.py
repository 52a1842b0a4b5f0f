"""What a fitted model relies on."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ride_analytics.config import Config
from ride_analytics.functions.columns import absolute_error
from ride_analytics.models.estimators import feature_names
from ride_analytics.operators.ordering import number_rows, smallest_prefix
from ride_analytics.operators.quantiles import grouped_quantiles
from ride_analytics.operators.sampling import KEY, hash_number, sample_rows, with_prefix_level
from ride_analytics.sources.small import small_table
from ride_analytics.sources.storage import written

IMPORTANCE = "`Model` string, `Feature` string, `Importance (%)` double"


def _percent(spark: SparkSession, model: str, names: Sequence[str], values: Sequence[float]) -> DataFrame:
    total = sum(values)
    rows = [(model, n, 100.0 * float(v) / total if total else 0.0) for n, v in zip(names, values)]
    return small_table(spark, rows, IMPORTANCE)


def native_importances(spark: SparkSession, model: PipelineModel, cfg: Config, name: str) -> DataFrame:
    return _percent(spark, name, feature_names(cfg), model.stages[-1].featureImportances.toArray())


def secondary_importances(importances: DataFrame) -> DataFrame:
    """Without the dominant feature of each model."""
    top = Window.partitionBy("Model").orderBy(F.desc("Importance (%)"), "Feature")
    return importances.withColumn("_r", F.row_number().over(top)).where("_r > 1").drop("_r")


def linear_importances(model: PipelineModel, df: DataFrame | None, cfg: Config, name: str = "Linear Baseline",
                       spark: SparkSession | None = None) -> DataFrame:
    """Mean absolute share ``coefficient * (x - mean x)`` over all rows, else the
    absolute coefficients."""
    names = feature_names(cfg)
    weights = [float(c) for c in model.stages[-1].coefficients.toArray()]
    if df is None:
        return _percent(spark, name, names, [abs(w) for w in weights])
    x = vector_to_array("features")
    # read by both aggregates, derived once
    values = written(PipelineModel(model.stages[:-1]).transform(df).select(*[x[i].alias(f"x{i}") for i in range(len(names))]), "linear-features")
    means = values.agg(*[F.avg(f"x{i}") for i in range(len(names))]).first()
    if means[0] is None:
        return _percent(df.sparkSession, name, names, [abs(w) for w in weights])
    shares = values.agg(*[F.avg(F.abs(F.lit(w) * (F.col(f"x{i}") - F.lit(means[i])))) for i, w in enumerate(weights)]).first()
    return _percent(df.sparkSession, name, names, list(shares))


def combined_importances(tables: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, tables)


def sufficient_features(importances: DataFrame, threshold: float = 95.0) -> DataFrame:
    """Per model, the fewest features whose importances reach ``threshold`` percent."""
    return smallest_prefix(importances, "Importance (%)", threshold, groups=["Model"], tie="Feature")


def permutation_importance(model: PipelineModel, df: DataFrame, features: Sequence[str], cfg: Config,
                           repeats: int = 5, key: str = KEY, block: int = 100_000) -> DataFrame:
    """Mean and deviation over ``repeats`` of the rise of the mean absolute error
    when one feature is taken from other rows.

    Rows are numbered once, in hash order, so the row a few places on is any other
    row. Repeat ``r`` takes the feature from the row ``r + 1`` places on, the first
    rows following the last one. Blocks of numbered rows get copies of the few
    rows that follow them, so donors come from a window over each block instead of
    a join. Each row is scored as it is and once per repeat and feature.
    """
    features = list(features)
    numbered = number_rows(df.withColumn("_h", hash_number(F.col(key), f"permute{cfg.seed}")), ["_h", key], "_pos").drop("_h")
    n = numbered.count()
    shifts = [1 + r % (n - 1) if n > 1 else 0 for r in range(repeats)]
    pos = F.col("_pos")

    def place(shift):
        """Block of the row that takes from this one, and the place of this one after it."""
        taker = pos - F.lit(shift)
        return F.struct(F.floor(F.when(taker < 0, taker + n).otherwise(taker) / block).alias("b"),
                        F.when(taker < 0, pos + n).otherwise(pos).alias("at"))

    places = F.array_distinct(F.array(*[place(s) for s in sorted({0, *shifts})]))
    w = Window.partitionBy("_p.b").orderBy("_p.at")
    donor = F.struct(*[F.col(f"`{f}`").alias(f"d{i}") for i, f in enumerate(features)])
    taken = numbered.withColumn("_p", F.explode(places)).withColumns({f"_l{r}": F.lead(donor, s).over(w) for r, s in enumerate(shifts)})
    own = taken.where((F.col("_p.at") == pos) & (F.col("_p.b") == F.floor(pos / block)))
    changed = list(range(len(features)))
    each = (own.withColumn("_s", F.explode(F.array(*[F.struct(F.lit(r).alias("r"), F.col(f"_l{r}").alias("d")) for r in range(repeats)])))
               .withColumn("_f", F.explode(F.when(F.col("_s.r") == 0, F.array(*[F.lit(i) for i in [-1, *changed]]))
                                            .otherwise(F.array(*[F.lit(i) for i in changed])))))
    mixed = each.withColumns({f: F.when(F.col("_f") == i, F.col(f"_s.d.d{i}")).otherwise(F.col(f"`{f}`"))
                              for i, f in enumerate(features)})
    errors = (model.transform(mixed).groupBy("_f", F.col("_s.r").alias("_r"))
                   .agg(F.avg(absolute_error(cfg.target, "prediction")).alias("e")))     # at most repeats x features + 1 rows
    base = F.max(F.when(F.col("_f") == -1, F.col("e"))).over(Window.partitionBy(F.lit(0)))
    names = F.element_at(F.array(*[F.lit(f) for f in features]), F.col("_f") + 1)
    rises = errors.withColumn("rise", F.col("e") - base).where("_f >= 0")
    return (rises.groupBy("_f").agg(F.avg("rise").alias("MeanImportance"), F.stddev_pop("rise").alias("StdImportance"))
                 .select(names.alias("Feature"), "MeanImportance", "StdImportance").orderBy("MeanImportance"))


def individual_curves(model: PipelineModel, df: DataFrame, feature: str, points: int = 20, rows: int = 500,
                      key: str = KEY, low: float = 0.05, high: float = 0.95) -> DataFrame:
    """Prediction of sampled rows at values of one feature, evenly spaced between
    two of its quantiles over all rows."""
    ends = grouped_quantiles(df, [], feature, {"lo": low, "hi": high}).first()
    step = (ends["hi"] - ends["lo"]) / (points - 1)
    values = F.transform(F.sequence(F.lit(0), F.lit(points - 1)), lambda i: F.lit(ends["lo"]) + i * F.lit(step))
    grid = sample_rows(df, rows, key).withColumn(feature, F.explode(values))
    return model.transform(grid).select(key, F.col(f"`{feature}`").alias("value"), "prediction")


def partial_dependence(curves: DataFrame) -> DataFrame:
    return curves.groupBy("value").agg(F.avg("prediction").alias("mean_prediction")).orderBy("value")


def sampled_attributions(model: PipelineModel, df: DataFrame, features: Sequence[str], cfg: Config, rows: int = 100,
                         permutations: int = 10, key: str = KEY) -> DataFrame:
    """Shapley values of sampled rows by sampled permutations (Strumbelj and
    Kononenko 2014).

    For a row and a permutation, features move one by one from a partner row to
    the row itself; the change of the prediction at each step belongs to the
    feature moved. Partners are other rows of the sample.
    """
    features = list(features)
    d = len(features)
    sample = written(number_rows(sample_rows(df, rows, key), [key], "_pos"), "attribution-sample")
    n = sample.count()
    text = F.concat_ws("-", F.col(key), F.col("_perm"))
    order = F.transform(
        F.array_sort(F.array(*[F.struct(hash_number(F.concat_ws("-", text, F.lit(f)), f"order{cfg.seed}").alias("h"),
                                        F.lit(i).alias("i")) for i, f in enumerate(features)])), lambda s: s["i"])
    donors = sample.select(F.col("_pos").alias("_from"), *[F.col(f"`{f}`").alias(f"_d{i}") for i, f in enumerate(features)])
    paths = (sample.withColumn("_perm", F.explode(F.sequence(F.lit(0), F.lit(permutations - 1))))
                   .withColumn("_order", order)
                   .withColumn("_from", hash_number(text, f"partner{cfg.seed}") % n)
                   .join(donors, "_from")
                   .withColumn("_step", F.explode(F.sequence(F.lit(0), F.lit(d)))))
    mixed = paths.withColumns({f: F.when(F.array_position("_order", F.lit(i)) <= F.col("_step"), F.col(f"`{f}`"))
                                   .otherwise(F.col(f"_d{i}")) for i, f in enumerate(features)})
    steps = model.transform(mixed).select(key, "_pos", "_perm", "_step", "_order", "prediction")
    path = Window.partitionBy("_pos", "_perm").orderBy("_step")      # d + 1 rows
    moved = (steps.withColumn("_delta", F.col("prediction") - F.lag("prediction").over(path)).where("_step > 0")
                  .withColumn("_i", F.element_at("_order", F.col("_step"))))
    names = F.element_at(F.array(*[F.lit(f) for f in features]), F.col("_i") + 1)
    # rows that share a key stay apart
    return moved.groupBy("_pos", key, names.alias("feature")).agg(F.avg("_delta").alias("attribution")).drop("_pos")


def learning_curve(models: dict[str, Pipeline], df: DataFrame, cfg: Config,
                   fractions: Sequence[float] = (0.1, 0.325, 0.55, 0.775, 1.0), fold: str = "fold",
                   parallelism: int = 4) -> DataFrame:
    """Training and validation error of every model, sample size and fold.
    Samples are nested."""
    spark = df.sparkSession
    data = written(with_prefix_level(df, fractions), "learning-curve")
    error = absolute_error(cfg.target, "prediction")

    def one(point):
        name, level, k = point
        used = (F.col("level") <= level) & (F.col(fold) != k)
        model = models[name].fit(data.where(used))
        got = (model.transform(data.where(used | (F.col(fold) == k)))
                    .agg(F.count_if(F.col(fold) != k).alias("n"),
                         F.avg(F.when(F.col(fold) != k, error)).alias("t"),
                         F.avg(F.when(F.col(fold) == k, error)).alias("v")).first())
        return name, level, k, got["n"], got["t"], got["v"]

    points = [(name, level, k) for name in models for level in range(len(fractions)) for k in range(cfg.folds)]
    with ThreadPoolExecutor(max_workers=parallelism) as pool:      # Spark runs the jobs of several fits at once
        rows = list(pool.map(one, points))
    return small_table(spark, rows, "model string, level int, fold int, train_rows bigint, train_mae double, validation_mae double")


def curve_summary(curve: DataFrame) -> DataFrame:
    return curve.groupBy("model", "level").agg(
        F.avg("train_rows").alias("train_rows"),
        F.avg("train_mae").alias("train_mean"), F.stddev_pop("train_mae").alias("train_std"),
        F.avg("validation_mae").alias("validation_mean"), F.stddev_pop("validation_mae").alias("validation_std"))

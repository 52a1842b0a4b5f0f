"""Feature pipeline and fare models, all of Spark ML's own persistable stages."""

from __future__ import annotations

import math
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer, StandardScaler, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession

from ride_analytics.config import BOOST_QUICK_GRID, FOREST_QUICK_GRID, Config
from ride_analytics.sources.small import small_table

# Where a caller gives no parameters.
FOREST_DEFAULTS = {"numTrees": 100, "maxDepth": 10, "maxBins": 256}
BOOST_DEFAULTS = {"maxIter": 100, "maxDepth": 6, "stepSize": 0.3, "maxBins": 256}


def feature_names(cfg: Config) -> list[str]:
    """Names of the entries of the feature vector, in order."""
    cyclic = [f"{f}_{part}" for f, _ in cfg.cyclic_features for part in ("sin", "cos")]
    return [*cfg.log_features, *cyclic, *cfg.passthrough_features]


def feature_stages(cfg: Config) -> list:
    """Logarithm and scaling, sine and cosine of cyclic features, the rest as is.

    The columns are SQL, so the fitted model is saved without Python code. The
    scaler divides by the sample deviation.
    """
    logs = [f"log1p(`{f}`) AS `_log_{f}`" for f in cfg.log_features]
    waves = [f"{fn}(`{f}` * {2 * math.pi!r}D / {float(p)!r}D) AS `{f}_{fn}`"
             for f, p in cfg.cyclic_features for fn in ("sin", "cos")]
    return [
        SQLTransformer(statement=f"SELECT *, {', '.join(logs + waves)} FROM __THIS__"),
        VectorAssembler(inputCols=[f"_log_{f}" for f in cfg.log_features], outputCol="_logs"),
        StandardScaler(inputCol="_logs", outputCol="_scaled", withMean=True, withStd=True),
        VectorAssembler(inputCols=["_scaled", *feature_names(cfg)[len(cfg.log_features):]], outputCol="features"),
    ]


def _pipeline(cfg: Config, estimator) -> Pipeline:
    return Pipeline(stages=[*feature_stages(cfg), estimator])


def linear_model(cfg: Config) -> Pipeline:
    return _pipeline(cfg, LinearRegression(labelCol=cfg.target))


def elastic_net(cfg: Config, regParam: float = 0.1, elasticNetParam: float = 0.5, **params) -> Pipeline:
    return _pipeline(cfg, LinearRegression(labelCol=cfg.target, regParam=regParam, elasticNetParam=elasticNetParam, **params))


def random_forest(cfg: Config, **params) -> Pipeline:
    return _pipeline(cfg, RandomForestRegressor(labelCol=cfg.target, seed=cfg.seed, **{**FOREST_DEFAULTS, **params}))


def boosted_trees(cfg: Config, **params) -> Pipeline:
    base = {"lossType": "squared", "checkpointInterval": 10}
    return _pipeline(cfg, GBTRegressor(labelCol=cfg.target, seed=cfg.seed, **{**base, **BOOST_DEFAULTS, **params}))


def fit_stored(pipeline: Pipeline, df: DataFrame) -> PipelineModel:
    """``pipeline.fit(df)``; the model's several passes read kept features instead of deriving them each time."""
    *head, model = pipeline.getStages()
    prepared = Pipeline(stages=head).fit(df)
    rows = prepared.transform(df).select(model.getFeaturesCol(), model.getLabelCol()).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return PipelineModel([*prepared.stages, model.fit(rows)])
    finally:
        rows.unpersist()


def fit_together(pipelines: dict[str, Pipeline], df: DataFrame) -> dict[str, PipelineModel]:
    """``fit_stored`` of models on the same rows: pipelines with equal feature stages
    fit them once and share the kept features, and their models are fitted side by side."""
    if not pipelines:
        return {}
    stages = {name: p.getStages() for name, p in pipelines.items()}
    *head, model = next(iter(stages.values()))
    columns = [model.getFeaturesCol(), model.getLabelCol()]
    for *other, m in stages.values():
        if list(map(_settings, other)) != list(map(_settings, head)) or [m.getFeaturesCol(), m.getLabelCol()] != columns:
            return {name: fit_stored(p, df) for name, p in pipelines.items()}
    prepared = Pipeline(stages=head).fit(df)
    rows = prepared.transform(df).select(*columns).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        with ThreadPoolExecutor(max_workers=len(stages)) as pool:      # each is a chain of short jobs
            models = list(pool.map(lambda s: s[-1].fit(rows), stages.values()))
    finally:
        rows.unpersist()
    return {name: PipelineModel([*prepared.stages, m]) for name, m in zip(stages, models)}


def _settings(stage) -> tuple:
    return type(stage), {p.name: v for p, v in stage.extractParamMap().items()}


def default_models(cfg: Config) -> dict[str, tuple[Pipeline, dict]]:
    """Name to (pipeline, grid of the quick comparison)."""
    return {
        "Linear Baseline": (linear_model(cfg), {}),
        "Random Forest": (random_forest(cfg), FOREST_QUICK_GRID),
        "Boosted Trees": (boosted_trees(cfg), BOOST_QUICK_GRID),
    }


def coefficients(spark: SparkSession, model, cfg: Config) -> DataFrame:
    fitted = model.stages[-1]
    rows = [(n, float(c)) for n, c in zip(feature_names(cfg), fitted.coefficients.toArray())]
    return small_table(spark, rows + [("(intercept)", float(fitted.intercept))], "feature string, coefficient double")

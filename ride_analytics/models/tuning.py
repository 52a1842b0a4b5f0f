"""Model comparison and parameter search. The driver holds scores, never rows."""

from __future__ import annotations

import itertools
import math
import random
import time
from concurrent.futures import ThreadPoolExecutor
from threading import Lock

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import Evaluator, RegressionEvaluator
from pyspark.ml.param.shared import HasLabelCol, HasPredictionCol
from pyspark.ml.regression import LinearRegression
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ride_analytics.config import Config
from ride_analytics.functions.columns import percentage_error
from ride_analytics.models.estimators import fit_stored
from ride_analytics.operators.sampling import KEY, hash_number, sample_rows, with_holdout_flag
from ride_analytics.sources.small import small_table
from ride_analytics.sources.storage import shared_dir, written


ROWS_AT_ONCE = 16_000_000   # of all models that are fitted at the same time


class MapeEvaluator(Evaluator, HasLabelCol, HasPredictionCol, DefaultParamsReadable, DefaultParamsWritable):
    """Mean absolute percentage error, which Spark's regression evaluator lacks."""

    def __init__(self, labelCol: str = "label", predictionCol: str = "prediction"):
        super().__init__()
        self._set(labelCol=labelCol, predictionCol=predictionCol)

    def _evaluate(self, dataset: DataFrame) -> float:
        error = percentage_error(self.getLabelCol(), self.getPredictionCol())
        value = dataset.agg(F.avg(error)).first()[0]
        return math.nan if value is None else float(value)

    def isLargerBetter(self) -> bool:
        return False


def mae(cfg: Config) -> Evaluator:
    return RegressionEvaluator(labelCol=cfg.target, metricName="mae")


def mape(cfg: Config) -> Evaluator:
    return MapeEvaluator(labelCol=cfg.target)


def grid_points(grid: dict) -> list[dict]:
    names = list(grid)
    return [dict(zip(names, values)) for values in itertools.product(*grid.values())]


def sample_grid(grid: dict, n: int, seed: int) -> list[dict]:
    points = grid_points(grid)
    return random.Random(seed).sample(points, min(n, len(points)))


def with_params(pipeline: Pipeline, params: dict) -> Pipeline:
    """Copy of the pipeline with parameters of its model overridden by name."""
    *head, last = pipeline.getStages()
    changed = last.copy({last.getParam(k): v for k, v in params.items()})
    return Pipeline(stages=[*head, changed])


def cross_validate(pipeline: Pipeline, df: DataFrame, points: list[dict], evaluator: Evaluator, cfg: Config, **kw) -> list[float]:
    """Mean score of every grid point over the given folds; nothing is refitted on all rows."""
    return [s for s, in cross_validate_all(pipeline, df, points, [evaluator], cfg, **kw)]


def cross_validate_all(pipeline: Pipeline, df: DataFrame, points: list[dict], evaluators: list[Evaluator], cfg: Config,
                       fold: str = "fold", parallelism: int = 8) -> list[list[float]]:
    """Mean scores of every grid point by each of the evaluators, from one fit per point and fold.

    The feature stages have no part in the grid, so each fold fits them once and
    keeps the features of its rows while its points are fitted. Points of
    several folds are fitted at once: a tree or a boosting step is many short jobs.
    Of many rows (``ROWS_AT_ONCE``) fewer are, since each keeps rows of its own and fills the cores alone.
    """
    shared_dir(df.sparkSession)
    sizes = dict(df.groupBy(fold).count().limit(cfg.folds + 1).collect())   # a row per fold
    if wrong := [k for k in sizes if k is None or not 0 <= k < cfg.folds]:
        raise ValueError(f"fold numbers must be in range [0, {cfg.folds}), but got {wrong[0]}")
    if empty := [k for k in range(cfg.folds) if k not in sizes or len(sizes) == 1]:
        raise ValueError(f"the training or validation data of fold {empty[0]} is empty")
    *head, model = pipeline.getStages()
    columns = list(dict.fromkeys([model.getFeaturesCol(), model.getLabelCol(), *[e.getLabelCol() for e in evaluators], fold]))
    keep = len(points) > 1 or not isinstance(model, LinearRegression)   # the linear model reads its rows once
    locks, rows, left = [Lock() for _ in range(cfg.folds)], {}, [len(points)] * cfg.folds

    def score(task):
        k, point = task
        with locks[k]:
            if k not in rows:
                featured = Pipeline(stages=head).fit(df.where(F.col(fold) != k)).transform(df).select(*columns)
                rows[k] = featured.persist(StorageLevel.MEMORY_AND_DISK) if keep else featured
        try:
            fitted = with_params(Pipeline(stages=[model]), point).fit(rows[k].where(F.col(fold) != k))
            held = fitted.transform(rows[k].where(F.col(fold) == k))
            return [float(e.evaluate(held)) for e in evaluators]
        finally:
            with locks[k]:
                left[k] -= 1
                if keep and not left[k]:
                    rows[k].unpersist()

    with ThreadPoolExecutor(max_workers=fits_at_once(sum(sizes.values()), parallelism)) as pool:
        scores = list(pool.map(score, [(k, p) for k in range(cfg.folds) for p in points]))
    return [[sum(of) / cfg.folds for of in zip(*scores[i::len(points)])] for i in range(len(points))]


def fits_at_once(rows: int, most: int) -> int:
    return max(1, min(most, ROWS_AT_ONCE // max(1, rows)))


def cv_score(pipeline: Pipeline, df: DataFrame, evaluator: Evaluator, cfg: Config, **kw) -> float:
    return cross_validate(pipeline, df, [{}], evaluator, cfg, **kw)[0]


def cv_scores(pipeline: Pipeline, df: DataFrame, evaluators: list[Evaluator], cfg: Config, **kw) -> list[float]:
    """``cv_score`` by several evaluators; the models of the folds are fitted once for all."""
    return cross_validate_all(pipeline, df, [{}], evaluators, cfg, **kw)[0]


def random_search(pipeline: Pipeline, grid: dict, df: DataFrame, n: int, evaluator: Evaluator, cfg: Config, refit: bool = True, **kw):
    """Score ``n`` random grid points by cross-validation, refit the best.

    Returns the fitted model, its parameters and all (parameters, score) pairs;
    no model with ``refit=False``, for callers that fit another one.
    """
    points = sample_grid(grid, n, cfg.seed)
    scores = cross_validate(pipeline, df, points, evaluator, cfg, **kw)
    best = min(range(len(points)), key=scores.__getitem__)
    return fit_stored(with_params(pipeline, points[best]), df) if refit else None, points[best], list(zip(points, scores))


def halving_search(pipeline: Pipeline, grid: dict, df: DataFrame, evaluator: Evaluator, cfg: Config,
                   factor: int = 3, min_rows: int = 2_000, key: str = KEY, **kw):
    """Successive halving with rows as the resource.

    Many points start on few rows; the best ``1 / factor`` go on with ``factor``
    times as many. Samples are nested, so each round adds rows to the last.
    """
    rows = df.count()
    points = sample_grid(grid, max(1, rows // min_rows), cfg.seed)
    size, history, number = min(min_rows, rows), [], 0
    while True:
        if size >= rows:
            scores = cross_validate(pipeline, df, points, evaluator, cfg, **kw)
        else:       # drawn once: every fold reads it several times
            part = df.where(hash_number(F.col(key), "halving") < int(2 ** 32 * size / rows)).persist(StorageLevel.MEMORY_AND_DISK)
            try:
                scores = cross_validate(pipeline, part, points, evaluator, cfg, **kw)
            finally:
                part.unpersist()
        history += [(number, size, p, s) for p, s in zip(points, scores)]
        order = sorted(range(len(points)), key=scores.__getitem__)
        if len(points) == 1 or size >= rows:
            break
        points = [points[i] for i in order[:math.ceil(len(points) / factor)]]
        size, number = min(size * factor, rows), number + 1
    best = points[order[0]]
    return fit_stored(with_params(pipeline, best), df), best, history


def best_size(errors: list[float], patience: int) -> int:
    """Number of trees at the least error, looking no further than ``patience``
    trees without improvement."""
    best = 0
    for i, e in enumerate(errors):
        if e < errors[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1


def early_stopped_boosting(pipeline: Pipeline, df: DataFrame, cfg: Config, ceiling: int = 2000, patience: int = 50,
                         first: int = 200):
    """Find the number of trees on a hold-out part, then fit all rows with it.

    The probe has ``first`` trees, and twice as many each time its best number
    lies within ``patience`` of its end, up to ``ceiling``.

    The feature stages are fitted on the remaining part only. Spark's own rule
    stops at the first small improvement, so the errors after each tree are
    taken from the model instead. Returns the model, its size and those errors.
    """
    shared_dir(df.sparkSession)
    flagged = with_holdout_flag(df, cfg.holdout_percent)
    *head, boost = pipeline.getStages()
    prepared = Pipeline(stages=head).fit(flagged.where(~F.col("is_val")))
    both = written(prepared.transform(flagged).select("features", cfg.target, "is_val"), "early-stopping")
    train, val = both.where(~F.col("is_val")), both.where(F.col("is_val"))
    trees = min(first, ceiling)
    while True:
        probe = boost.copy({boost.maxIter: trees}).fit(train)
        errors = [float(e) for e in probe.evaluateEachIteration(val, "squared")]
        size = best_size(errors, patience)
        if trees >= ceiling or size + patience <= trees:
            break
        trees = min(2 * trees, ceiling)
    return fit_stored(with_params(pipeline, {"maxIter": size}), df), size, errors


def tune_forest(pipeline: Pipeline, grid: dict, df: DataFrame, cfg: Config, **kw) -> tuple[PipelineModel, dict]:
    model, best, _ = halving_search(pipeline, grid, df, mae(cfg), cfg, **kw)
    return model, best


def tune_boosting(pipeline: Pipeline, grid: dict, df: DataFrame, cfg: Config, n: int = 10, ceiling: int = 2000,
                  patience: int = 50, **kw) -> tuple[PipelineModel, dict]:
    """Random search for the shape of the trees, then early stopping for their number, which the grid does not set."""
    grid = {k: v for k, v in grid.items() if k != "maxIter"}
    _, best, _ = random_search(pipeline, grid, df, n, mae(cfg), cfg, refit=False, **kw)
    model, size, _ = early_stopped_boosting(with_params(pipeline, best), df, cfg, ceiling, patience)
    return model, {**best, "maxIter": size}


def quick_comparison(models: dict, df: DataFrame, cfg: Config, rows: int = 20_000, n: int = 3, **kw) -> DataFrame:
    """Cross-validated percentage error of every model on a sample of the rows:
    Model, CV Accuracy (%), CV MAPE, Fast Tune Time (s)."""
    sample = written(sample_rows(df, rows), "comparison-sample")
    out = []
    for name, (pipeline, grid) in models.items():
        start = time.time()
        if grid:
            _, _, scored = random_search(pipeline, grid, sample, n, mape(cfg), cfg, refit=False, **kw)
            error = min(s for _, s in scored)
        else:
            error = cv_score(pipeline, sample, mape(cfg), cfg, **kw)
        out.append((name, (1.0 - min(error, 1.0)) * 100.0, error, round(time.time() - start, 2)))
    return small_table(df.sparkSession, out,
                       "`Model` string, `CV Accuracy (%)` double, `CV MAPE` double, `Fast Tune Time (s)` double")

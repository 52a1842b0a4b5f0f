"""Isolation forest (Liu, Ting and Zhou 2008) as a Spark ML estimator.

Spark ML has none. Trees see a few hundred rows each, so growing them is cheap;
what matters at scale is drawing those rows and scoring all the others, and both
are map-side work.
"""

from __future__ import annotations

import math
import random
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ride_analytics.operators.joins import BROADCAST_ROWS, null_safe_join
from ride_analytics.operators.quantiles import grouped_quantiles
from ride_analytics.operators.sampling import first_n_by_hash
from ride_analytics.sources.small import small_table
from ride_analytics.sources.storage import cut

GRID_CELLS = 1 << 16     # of a tree's lookup table; larger trees are walked
NODE_SCHEMA = "tree int, node int, feature int, threshold double, path double"


def average_path(n: float) -> float:
    """Expected path length of an unsuccessful search among ``n`` points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + 0.5772156649015329) - 2.0 * (n - 1.0) / n


class _ForestParams(Params):
    inputCols = Param(Params._dummy(), "inputCols", "numeric input columns", TypeConverters.toListString)
    keyCol = Param(Params._dummy(), "keyCol", "row key the samples are drawn by", TypeConverters.toString)
    numTrees = Param(Params._dummy(), "numTrees", "number of trees", TypeConverters.toInt)
    sampleSize = Param(Params._dummy(), "sampleSize", "rows per tree", TypeConverters.toInt)
    contamination = Param(Params._dummy(), "contamination", "share of rows to flag", TypeConverters.toFloat)
    seed = Param(Params._dummy(), "seed", "random seed", TypeConverters.toInt)
    scoreCol = Param(Params._dummy(), "scoreCol", "output: anomaly score in (0, 1)", TypeConverters.toString)
    predictionCol = Param(Params._dummy(), "predictionCol", "output: true for outliers", TypeConverters.toString)

    def __init__(self):
        super().__init__()
        self._setDefault(inputCols=["fare_amount", "trip_distance"], keyCol="row_key", numTrees=100,
                         sampleSize=256, contamination=0.01, seed=42,
                         scoreCol="outlier score", predictionCol="is outlier")

    def value(self, param):
        return self.getOrDefault(param)


def draw_samples(df: DataFrame, cols: list[str], key: str, trees: int, size: int, seed: int) -> tuple[DataFrame, int]:
    """Rows (tree, cols...), ``min(size, n)`` distinct ones for every tree, and that number.

    A pool of at most ``trees * size`` rows, which does not grow with the data, is
    drawn by hash and numbered in hash order. Each tree takes the positions of an
    arithmetic progression of its own modulo the pool size; a step without common
    divisor never repeats a row.
    """
    spark, values = df.sparkSession, df.select(key, *[F.col(f"`{c}`").cast("double").alias(c) for c in cols]).na.drop()
    pool = first_n_by_hash(values, trees * size, key=key, salt=f"forest{seed}")
    order = Window.orderBy(F.xxhash64(key, F.lit(seed)), key)        # the pool only
    pool = cut(pool.withColumn("_pos", F.row_number().over(order) - 1))
    n, rng = pool.count(), random.Random(seed)
    steps = [s for s in (rng.randrange(1, n + 1) for _ in range(50 * trees)) if math.gcd(s, n) == 1] if n else []
    paths = [(t, rng.randrange(n), steps[t % len(steps)] if steps else 1) for t in range(trees)] if n else []
    draws = (small_table(spark, paths, "tree int, start bigint, step bigint")
             .select("tree", "start", "step", F.explode(F.sequence(F.lit(0), F.lit(max(min(size, n), 1) - 1))).alias("j"))
             .select("tree", ((F.col("start") + F.col("j") * F.col("step")) % max(n, 1)).cast("int").alias("_pos")))
    return pool.join(draws, "_pos").select("tree", *[F.col(f"`{c}`") for c in cols]), min(size, n)


def _tree_grower(cols: list[str], depth: int, seed: int):
    """Function growing one tree from its few hundred rows, in heap layout.

    Self-contained, so that workers need no copy of this package.
    """
    def grow(pdf):
        import math

        import numpy as np
        import pandas as pd

        def average(n):
            if n <= 1:
                return 0.0
            if n == 2:
                return 1.0
            return 2.0 * (math.log(n - 1.0) + 0.5772156649015329) - 2.0 * (n - 1.0) / n

        tree = int(pdf["tree"].iloc[0])
        rng = np.random.default_rng([seed, tree])
        points = pdf[cols].to_numpy(dtype=float)
        points = points[np.lexsort(points.T)]          # independent of arrival order
        nodes, todo = [], [(0, 0, points)]
        while todo:
            node, level, rows = todo.pop()
            low, high = rows.min(axis=0), rows.max(axis=0)
            free = np.flatnonzero(high > low)
            if level == depth or len(rows) <= 1 or len(free) == 0:
                nodes.append((tree, node, -1, math.nan, level + average(len(rows))))
                continue
            f = int(rng.choice(free))
            cut_at = float(rng.uniform(low[f], high[f]))
            left = rows[:, f] <= cut_at
            nodes.append((tree, node, f, cut_at, math.nan))
            todo.append((2 * node + 1, level + 1, rows[left]))
            todo.append((2 * node + 2, level + 1, rows[~left]))
        return pd.DataFrame(nodes, columns=["tree", "node", "feature", "threshold", "path"])
    return grow


class IsolationForest(Estimator, _ForestParams):
    @keyword_only
    def __init__(self, *, inputCols=None, keyCol=None, numTrees=None, sampleSize=None, contamination=None,
                 seed=None, scoreCol=None, predictionCol=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> IsolationForestModel:
        cols = self.value(self.inputCols)
        size, trees, seed = self.value(self.sampleSize), self.value(self.numTrees), self.value(self.seed)
        samples, used = draw_samples(dataset, cols, self.value(self.keyCol), trees, size, seed)
        if used == 0:
            raise ValueError("no complete rows to grow a forest from")
        depth = max(1, math.ceil(math.log2(max(used, 2))))
        # Bounded by trees * 2**(depth + 1) rows: the model itself.
        spread = samples.repartition(min(trees, max(2, dataset.sparkSession.sparkContext.defaultParallelism)), "tree")
        nodes = spread.groupBy("tree").applyInPandas(_tree_grower(cols, depth, seed), NODE_SCHEMA).toPandas()
        model = IsolationForestModel(nodes=nodes, sample_size=used, depth=depth)
        self._copyValues(model)
        model.cutoff = model.fit_cutoff(dataset)
        return model


class IsolationForestModel(Model, _ForestParams):
    def __init__(self, nodes: pd.DataFrame, sample_size: int, depth: int, cutoff: float = math.nan):
        super().__init__()
        self.nodes, self.sample_size, self.depth, self.cutoff = nodes, sample_size, depth, cutoff

    def _arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Complete trees: a leaf above the last level sends rows left, to the
        bottom node that holds its path length."""
        inner = 2 ** self.depth - 1
        trees = int(self.nodes["tree"].max()) + 1
        feature = np.zeros((trees, inner), dtype=np.int64)
        threshold = np.full((trees, inner), np.inf)
        path = np.zeros((trees, inner + 1))
        for t, n, f, x, p in self.nodes.itertuples(index=False):
            if f >= 0:
                feature[t, n], threshold[t, n] = f, x
            else:
                while n < inner:
                    n = 2 * n + 1
                path[t, n - inner] = p
        return feature, threshold, path

    def _grids(self) -> tuple[list[np.ndarray], np.ndarray, list[np.ndarray], np.ndarray] | None:
        """The trees as lookup tables: per column all thresholds, per tree and column the cell of each of their ranges,
        and per tree where its cells begin among the path lengths. None where a tree has too many cells for that.

        A row's way through a tree depends only on which of the tree's thresholds its values exceed.
        """
        feature, threshold, path = self._arrays()
        width, inner = len(self.value(self.inputCols)), threshold.shape[1]
        every = [np.unique(threshold[(feature == c) & np.isfinite(threshold)]) for c in range(width)]
        places, begins, cells = [[] for _ in range(width)], [], []
        for f, t, p in zip(feature, threshold, path):
            own = [np.unique(t[(f == c) & np.isfinite(t)]) for c in range(width)]
            shape = [len(x) + 1 for x in own]
            if math.prod(shape) > GRID_CELLS:
                return None
            x = np.stack(np.meshgrid(*[np.append(o, np.inf) for o in own], indexing="ij"), axis=-1).reshape(-1, width)
            row, at = np.arange(len(x)), np.zeros(len(x), dtype=np.int64)
            for _ in range(self.depth):
                at = 2 * at + 1 + (x[row, f[at]] > t[at])
            begins.append(sum(map(len, cells)))
            cells.append(p[at - inner])
            step = 1
            for c in reversed(range(width)):
                # a value above k of all thresholds of its column is above so many of the tree's
                places[c].append((np.searchsorted(own[c], np.append(every[c], np.inf), side="left") * step).astype(np.int32))
                step *= shape[c]
        return every, np.array(begins), [np.array(x) for x in places], np.concatenate(cells)

    def score_column(self, spark: SparkSession, columns: list[str] | None = None):
        """Vectorized score ``2 ** (-mean path / c(sample))`` of the input columns, or of ``columns`` in their place."""
        grids = self._grids()
        shared = spark.sparkContext.broadcast(self._arrays() if grids is None else grids)     # trees * 2**depth numbers, or trees * GRID_CELLS
        depth, norm, width, tables = self.depth, average_path(self.sample_size), len(self.value(self.inputCols)), grids is not None

        @F.pandas_udf(T.DoubleType())
        def score(parts: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
            import numpy as np
            import pandas as pd

            def looked_up(x):
                every, begins, places, cells = shared.value
                # a missing value exceeds no threshold
                ranks = [np.searchsorted(t, np.where(np.isnan(v), -np.inf, v), side="left") for t, v in zip(every, x.T)]
                total = np.zeros(len(x))
                for k, begin in enumerate(begins):
                    at = places[0][k].take(ranks[0])
                    for p, r in zip(places[1:], ranks[1:]):
                        at += p[k].take(r)
                    total += cells[begin:].take(at)
                return total

            def walked(x):
                feature, threshold, path = shared.value
                inner = threshold.shape[1]
                flat, start = np.ascontiguousarray(x).ravel(), np.arange(len(x)) * width
                total = np.zeros(len(x))
                for f, t, p in zip(feature, threshold, path):
                    at = np.zeros(len(x), dtype=np.int64)
                    for _ in range(depth):
                        at = 2 * at + 1 + (flat[start + f[at]] > t[at])
                    total += p[at - inner]
                return total

            for batch in parts:
                x = np.column_stack([s.to_numpy(dtype=float) for s in batch])
                mean = (looked_up if tables else walked)(x) / len(shared.value[1])
                yield pd.Series(np.power(2.0, -mean / norm) if norm > 0 else np.full(len(x), 0.5))

        return score(*[F.col(f"`{c}`").cast("double") for c in columns or self.value(self.inputCols)])

    def score_distinct(self, df: DataFrame) -> DataFrame:
        """Distinct input rows with their number and score: the score depends on
        nothing else, and repeated values are scored once."""
        cols = [F.col(f"`{c}`").cast("double").alias(c) for c in self.value(self.inputCols)]
        groups = df.select(*cols).na.drop().groupBy(*[f"`{c}`" for c in self.value(self.inputCols)]).agg(
            F.count(F.lit(1)).alias("n"))
        return groups.withColumn("score", self.score_column(df.sparkSession))

    def fit_cutoff(self, df: DataFrame) -> float:
        share = 1.0 - self.value(self.contamination)
        scored = cut(self.score_distinct(df).select("score", "n"))
        row = grouped_quantiles(scored, [], "score", {"q": share}, weight="n").first()
        return float(row["q"]) if row else math.inf

    def _transform(self, dataset: DataFrame) -> DataFrame:
        score, flag = self.value(self.scoreCol), self.value(self.predictionCol)
        return (dataset.withColumn(score, self.score_column(dataset.sparkSession))
                       .withColumn(flag, F.col(score) > self.cutoff))

    def transform_repeated(self, dataset: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
        """``transform`` of a stored table: each different input is scored once and looked up by the rows. Inputs that
        are more than ``most``, or hardly fewer than the rows, are scored row by row."""
        cols = self.value(self.inputCols)
        places = [f"_x{i}" for i in range(len(cols))]
        keyed = dataset.withColumns({p: F.col(f"`{c}`").cast("double") for p, c in zip(places, cols)})
        inputs = cut(keyed.select(*places).distinct())
        n = inputs.count()
        if n > most or 4 * n > dataset.count():
            return self.transform(dataset)
        score, flag = self.value(self.scoreCol), self.value(self.predictionCol)
        scores = cut(inputs.withColumn(score, self.score_column(dataset.sparkSession, places)).withColumn(flag, F.col(score) > self.cutoff))
        return null_safe_join(keyed, F.broadcast(scores), places).drop(*places)

    def save(self, spark: SparkSession, path: str) -> None:
        small_table(spark, self.nodes.itertuples(index=False), NODE_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
        meta = [(self.sample_size, self.depth, self.cutoff, self.value(self.inputCols), self.value(self.keyCol), self.value(self.scoreCol),
                 self.value(self.predictionCol), self.value(self.contamination))]
        (small_table(spark, meta, "sample_size int, depth int, cutoff double, columns array<string>, key string, score string, "
                                     "prediction string, contamination double")
              .coalesce(1).write.mode("overwrite").parquet(f"{path}/meta"))

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> IsolationForestModel:
        meta = spark.read.parquet(f"{path}/meta").first()
        nodes = spark.read.parquet(f"{path}/nodes").toPandas()
        model = cls(nodes, meta["sample_size"], meta["depth"], meta["cutoff"])
        return model._set(inputCols=list(meta["columns"]), keyCol=meta["key"], scoreCol=meta["score"], predictionCol=meta["prediction"],
                          contamination=meta["contamination"])


def fit_outliers(df: DataFrame, contamination: float = 0.01, seed: int = 42, key: str = "row_key") -> IsolationForestModel:
    return IsolationForest(contamination=contamination, seed=seed, keyCol=key).fit(df)


def inliers(tagged: DataFrame, flag: str = "is outlier") -> DataFrame:
    return tagged.where(~F.col(flag))


def outliers(tagged: DataFrame, flag: str = "is outlier") -> DataFrame:
    return tagged.where(F.col(flag))

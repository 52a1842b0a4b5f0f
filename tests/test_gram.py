"""Linear models from sums of products against Spark's learner and numpy."""
import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from ride_analytics.models import gram
from ride_analytics.operators.metrics import metrics_by_sets, regression_metrics


@pytest.fixture(scope="module")
def rows(spark):
    draw = np.random.default_rng(4)
    x = draw.normal(100, 3, (400, 2))
    y = 5 + 2 * x[:, 0] - 0.5 * x[:, 1] + draw.normal(0, 1, 400)
    data = [(float(a), float(b), float(c), k % 5, k % 4 == 3) for k, ((a, b), c) in enumerate(zip(x, y))]
    return spark.createDataFrame(data + [(None, 1.0, 2.0, 0, False), (1.0, float("nan"), 2.0, 1, True)], "x double, z double, y double, fold int, held boolean").cache()


def test_coefficients_equal_the_learner(rows):
    whole = VectorAssembler(inputCols=["x", "z"], outputCol="features", handleInvalid="skip").transform(rows.where(~F.isnan("z")))
    model = LinearRegression(labelCol="y").fit(whole)
    got = {r.feature: r.coefficient for r in gram.linear_coefficients(rows, ["x", "z"], "y").collect()}
    assert got["x"] == pytest.approx(model.coefficients[0], abs=1e-6) and got["z"] == pytest.approx(model.coefficients[1], abs=1e-6)
    assert got["(intercept)"] == pytest.approx(model.intercept, abs=1e-4)
    ridge = LinearRegression(labelCol="y", regParam=0.5).fit(whole)
    got = {r.feature: r.coefficient for r in gram.linear_coefficients(rows, ["x", "z"], "y", ridge=0.5).collect()}
    assert abs(got["x"]) < abs(model.coefficients[0]) and np.sign(got["z"]) == np.sign(ridge.coefficients[1])


def test_fold_errors_equal_refitting(rows):
    data = [(r.x, r.z, r.y, r.fold) for r in rows.collect() if r.x is not None and r.z == r.z]
    a = np.array(data)
    got = gram.fold_errors(rows, ["x", "z"], "y", ridges=(0.0, 0.1)).where("ridge = 0").orderBy("fold").collect()
    for r in got:
        own = a[:, 3] == r.fold
        design = np.c_[np.ones(len(a)), a[:, :2]]
        w = np.linalg.lstsq(design[~own], a[~own, 2], rcond=None)[0]
        assert r.n == own.sum() and r.rmse == pytest.approx(np.sqrt(np.mean((a[own, 2] - design[own] @ w) ** 2)), rel=1e-6)


def test_dependent_and_constant_features_and_no_rows(rows):
    got = {r.feature: r.coefficient for r in gram.linear_coefficients(rows.withColumn("c", F.lit(7.0)).withColumn("x2", F.col("x") * 2), ["x", "c", "x2", "z"], "y").collect()}
    assert got["c"] == 0 and got["x"] + 2 * got["x2"] == pytest.approx(2, abs=0.1)
    assert gram.linear_coefficients(rows.limit(0), ["x"], "y").count() == 0
    assert gram.fold_errors(rows.limit(0), ["x"], "y").count() == 0


def test_learning_curve_sizes(rows):
    got = gram.size_errors(rows, ["x", "z"], "y", "fold", "held").orderBy("fold").collect()
    assert [r.n_train for r in got] == [60, 120, 180, 240, 300] and all(r.test_rmse < 2 for r in got)


def test_metrics_by_sets_equal_single_groupings(rows):
    df = rows.where("x IS NOT NULL").select("y", F.col("x").alias("p"), "fold", "held")
    got = metrics_by_sets(df, [["fold"], ["fold", "held"]], "y", "p")
    one = {r.fold: r.MAE for r in got.where("grouping = 'fold'").collect()}
    want = {r.fold: r.MAE for r in regression_metrics(df, "y", "p", ["fold"]).collect()}
    assert one.keys() == want.keys() and all(one[k] == pytest.approx(want[k]) for k in want)
    assert got.where("grouping = 'fold,held'").count() == df.select("fold", "held").distinct().count()

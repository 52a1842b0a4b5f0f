"""Permutation importance against its definition, row by row."""

import hashlib
import math

import pytest
from pyspark.sql import functions as F

from ride_analytics.config import Config
from ride_analytics.models import estimators as E
from ride_analytics.models.importance import linear_importances, permutation_importance
from ride_analytics.sources.storage import shared_dir

CFG = Config()


class Formula:
    def transform(self, df):
        return df.withColumn("prediction", 2.0 * F.col("a") - F.col("b"))


def brute(rows, repeats):
    """rows: (key, a, b, target); Feature -> (mean, deviation)."""
    rows = sorted(rows, key=lambda r: (int(hashlib.md5(f"permute{CFG.seed}:{r[0]}".encode()).hexdigest()[:8], 16), r[0]))
    n = len(rows)
    error = lambda pairs: sum(abs(t - (2.0 * a - b)) for a, b, t in pairs) / n
    base = error([r[1:] for r in rows])
    found = {}
    for name in "ab":
        rises = []
        for r in range(repeats):
            shift = 1 + r % (n - 1) if n > 1 else 0
            donors = [rows[(i + shift) % n] for i in range(n)]
            rises.append(error([(d[1] if name == "a" else a, d[2] if name == "b" else b, t) for (_, a, b, t), d in zip(rows, donors)]) - base)
        mean = sum(rises) / repeats
        found[name] = (mean, math.sqrt(sum((x - mean) ** 2 for x in rises) / repeats))
    return found


@pytest.mark.parametrize("n, block", [(1, 4), (2, 4), (4, 1), (5, 2), (37, 7), (37, 12), (37, 1000)])
def test_blocks_give_the_donors_of_the_whole_order(spark, n, block):
    rows = [(f"k{i}", float(i * i % 17), float(i % 5), float(i % 11)) for i in range(n)]
    df = spark.createDataFrame(rows, f"row_key string, a double, b double, `{CFG.target}` double").repartition(3)
    got = {r["Feature"]: (r["MeanImportance"], r["StdImportance"])
           for r in permutation_importance(Formula(), df, ["a", "b"], CFG, 4, block=block).collect()}
    want = brute(rows, 4)
    assert got.keys() == want.keys()
    for name in want:
        assert got[name] == pytest.approx(want[name], abs=1e-9)


def test_no_join_of_rows(spark):
    rows = [(f"k{i}", float(i), 0.0, 1.0) for i in range(20)]
    df = spark.createDataFrame(rows, f"row_key string, a double, b double, `{CFG.target}` double")
    plan = permutation_importance(Formula(), df, ["a", "b"], CFG)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1      # partition offsets of the numbering, broadcast


def test_linear_importances_are_those_of_all_rows(spark):
    shared_dir(spark)
    a, b, c = CFG.features
    assert CFG.log_features and not CFG.cyclic_features
    rows = [(f"k{i}", float(i % 13), float(i * i % 29), float(i % 7) if i % 90 else 400.0, float(i % 13 + i % 5)) for i in range(1800)]
    df = spark.createDataFrame(rows, f"row_key string, `{a}` double, `{b}` double, `{c}` double, `{CFG.target}` double").repartition(3)
    model = E.linear_model(CFG).fit(df)
    vectors = [r["features"].toArray() for r in model.transform(df).select("features").collect()]
    means = [sum(v[i] for v in vectors) / len(vectors) for i in range(3)]
    shares = [sum(abs(w * (v[i] - means[i])) for v in vectors) / len(vectors) for i, w in enumerate(model.stages[-1].coefficients.toArray())]
    got = {r["Feature"]: r["Importance (%)"] for r in linear_importances(model, df, CFG).collect()}
    assert got == pytest.approx({n: 100 * s / sum(shares) for n, s in zip(E.feature_names(CFG), shares)}, rel=1e-9)

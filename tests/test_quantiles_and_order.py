import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ride_analytics.operators import histograms as H
from ride_analytics.operators import ordering as O
from ride_analytics.operators import quantiles as Q
from ride_analytics.operators import screening as SC
from ride_analytics.sources.small import small_table


@pytest.fixture(scope="module")
def skewed(spark):
    """One group holds most rows, one value a third of them; some nulls and NaN."""
    rng = np.random.default_rng(3)
    g = np.where(rng.random(6000) < 0.7, "hot", rng.choice(list("abc"), 6000))
    x = np.where(rng.random(6000) < 0.33, 7.0, np.round(rng.lognormal(2, 1.5, 6000), 3))
    rows = [(str(k), None if i % 97 == 0 else (float("nan") if i % 101 == 0 else float(v))) for i, (k, v) in enumerate(zip(g, x))]
    rows += [("empty", None), (None, 1.0), (None, 4.0)]
    return small_table(spark, rows, "g string, x double")


@pytest.mark.parametrize("small_rows,ranges", [(10**6, 64), (0, 64), (0, 3), (0, 1024)])
def test_grouped_quantiles_equal_pandas(skewed, small_rows, ranges):
    probs = {"p0": 0.0, "p1": 0.01, "q1": 0.25, "med": 0.5, "q3": 0.75, "p99": 0.99, "p100": 1.0}
    got = Q.grouped_quantiles(skewed, ["g"], "x", probs, small_rows=small_rows, ranges=ranges).toPandas()
    want = skewed.toPandas().dropna(subset=["x"]).groupby("g", dropna=False)["x"].quantile(list(probs.values())).unstack()
    assert len(got) == len(want) == 5           # the group without values is absent
    for _, r in got.iterrows():
        w = want[want.index.isna()].iloc[0] if pd.isna(r["g"]) else want.loc[r["g"]]
        np.testing.assert_allclose([r[n] for n in probs], w.to_numpy(), rtol=1e-12)


@pytest.mark.parametrize("small_rows", [10**6, 0])
def test_global_and_weighted_quantiles(spark, skewed, small_rows):
    got = Q.grouped_quantiles(skewed, [], "x", {"m": 0.5}, small_rows=small_rows, ranges=16).first()["m"]
    assert got == pytest.approx(skewed.toPandas()["x"].median())
    w = small_table(spark, [(1.0, 3), (2.0, 1), (9.0, 2)], "x double, n bigint")
    assert Q.grouped_quantiles(w, [], "x", {"m": 0.5}, weight="n", small_rows=small_rows).first()["m"] == 1.5


def test_approximate_quantiles(skewed):
    got = Q.grouped_quantiles(skewed.where("g = 'hot'"), ["g"], "x", {"m": 0.5}, approx=True).first()["m"]
    assert got == pytest.approx(skewed.where("g = 'hot'").toPandas()["x"].median(), rel=0.01)


def test_box_statistics(spark):
    df = small_table(spark, [("a", float(v)) for v in [1, 2, 3, 4, 5, 100]] + [("b", 1.0)], "g string, x double")
    for small in (10, 0):
        r = {x["g"]: x for x in Q.box_statistics(df, ["g"], "x", small_rows=small).collect()}
        assert (r["a"]["q1"], r["a"]["median"], r["a"]["q3"]) == (2.25, 3.5, 4.75)
        assert (r["a"]["whisker_low"], r["a"]["whisker_high"], r["a"]["n"]) == (1.0, 5.0, 6)
        assert r["b"]["whisker_low"] == r["b"]["whisker_high"] == 1.0
    whole = Q.box_statistics(df, [], "x").first()
    assert whole["n"] == 7 and whole["whisker_high"] == 5.0


def test_describe_equals_pandas(skewed):
    r = Q.describe(skewed, ["x"]).first()
    want = skewed.toPandas()["x"].describe().round(2)
    assert [r["count"], r["mean"], r["std"], r["min"], r["q25"], r["q50"], r["q75"], r["max"]] == pytest.approx(list(want))


def test_numbering_is_dense_under_ties(spark):
    df = spark.range(5000).withColumn("v", F.when(F.col("id") % 3 == 0, 1.0).otherwise(F.col("id") % 50)).repartition(7)
    got = O.number_rows(df, ["v", "id"]).toPandas().sort_values("position")
    assert list(got["position"]) == list(range(5000))
    want = df.toPandas().sort_values(["v", "id"])
    assert list(got["id"]) == list(want["id"])


@pytest.mark.parametrize("block", [500, 501, 777, 10_000])
def test_rolling_mean_equals_pandas(spark, block):
    df = spark.range(3000).withColumn("y", (F.col("id") * 37 % 101).cast("double")).withColumn("x", F.rand(1))
    df = df.cache()
    got = O.rolling_mean(df, ["y", "id"], "x", 500, block=block).toPandas().sort_values("position")
    want = df.toPandas().sort_values(["y", "id"])["x"].rolling(500, min_periods=1).mean()
    np.testing.assert_allclose(got["trend"], want, rtol=1e-9)


def test_smallest_prefix(spark):
    df = small_table(spark, [("m", "a", 60.0), ("m", "b", 30.0), ("m", "c", 6.0), ("m", "d", 4.0)], "g string, f string, s double")
    got = O.smallest_prefix(df, "s", 95.0, ["g"], tie="f").orderBy("rank").collect()
    assert [r["f"] for r in got] == ["a", "b", "c"]


def test_histogram_closes_last_bin(spark):
    df = small_table(spark, [(float(v),) for v in [0, 1, 2, 3, 10]] + [(None,)], "x double")
    got = {r["bin"]: r["n"] for r in H.histogram(df, "x", 10).collect()}
    assert got == {0: 1, 1: 1, 2: 1, 3: 1, 9: 1}
    flat = small_table(spark, [(5.0,), (5.0,)], "x double")
    assert [(r["bin"], r["n"]) for r in H.histogram(flat, "x", 10).collect()] == [(0, 2)]


def test_density_curve_close_to_kernel_sum(spark):
    x = np.random.default_rng(5).gamma(3, 4, 4000)
    got = H.density_curve(small_table(spark, [(float(v),) for v in x], "x double"), "x").toPandas().sort_values("point")
    h = x.std(ddof=1) * len(x) ** -0.2
    want = np.exp(-0.5 * ((got["x"].to_numpy()[:, None] - x) / h) ** 2).sum(axis=1) / (len(x) * h * np.sqrt(2 * np.pi))
    np.testing.assert_allclose(got["density"], want, atol=2e-3 * want.max())
    assert len(got) == 200


def test_hexagons_hold_every_row(spark):
    df = spark.range(2000).select(F.rand(1).alias("x"), F.randn(2).alias("y")).cache()
    cells = H.hexagons(df, "x", "y", 20)
    assert cells.agg(F.sum("n")).first()[0] == 2000
    assert cells.where("n < 1").count() == 0


def test_screening(spark):
    df = spark.range(1000).select((F.col("id") % 100 == 0).cast("int").alias("rare"), (F.col("id") % 2).cast("int").alias("half"),
                                  F.col("id").cast("double").alias("x"), (F.col("id") * -2.0).alias("neg"), F.rand(3).alias("fare_amount"))
    scan = SC.quasi_constant_scan(df, ["rare", "half", "absent"], 0.95)
    assert {r["column"]: (r["top_share"], r["status"]) for r in scan.collect()} == {"rare": (0.99, "DROP"), "half": (0.5, "KEEP")}
    assert SC.active_features(scan, ["rare", "half"], ["x"]) == ["half", "x"]
    corr = {(r["x"], r["y"]): r["corr"] for r in SC.correlation_matrix(df, ["x", "neg", "fare_amount"]).collect()}
    assert corr[("x", "neg")] == corr[("neg", "x")] == pytest.approx(-1.0)
    assert ("x", "fare_amount") not in corr
    shares = SC.component_shares(df, ["x", "neg", "half"], 0.99).collect()
    assert len(shares) == 2 and shares[-1]["cumulative"] == pytest.approx(1.0)

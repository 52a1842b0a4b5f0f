import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ride_analytics.operators import diagnostics as D
from ride_analytics.operators import metrics as M
from ride_analytics.operators import summaries as S
from ride_analytics.sources.small import small_table


@pytest.fixture(scope="module")
def scored(spark):
    rng = np.random.default_rng(11)
    n = 3000
    df = pd.DataFrame({"row_key": [str(i) for i in range(n)], "fare_amount": np.round(rng.uniform(1, 50, n), 2),
                       "PULocationID": np.where(rng.random(n) < 0.6, 1, rng.integers(2, 9, n)).astype("int32"),
                       "hour": rng.integers(0, 24, n).astype("int32"), "day of week": rng.integers(0, 7, n).astype("int32"),
                       "trip_distance": np.round(rng.uniform(0.1, 19, n), 1), "PU_fare_avg": 20.0})
    df["prediction"] = df["fare_amount"] + rng.normal(0, 3, n)
    return spark.createDataFrame(df).cache()


def test_metrics_equal_numpy(scored):
    p = scored.toPandas()
    e = p["fare_amount"] - p["prediction"]
    r = M.regression_metrics(scored, model="m").first()
    assert r["Model"] == "m"
    assert r["MAE"] == pytest.approx(e.abs().mean()) and r["MedAE"] == pytest.approx(e.abs().median())
    assert r["RMSE"] == pytest.approx(np.sqrt((e ** 2).mean()))
    assert r["R²"] == pytest.approx(1 - (e ** 2).sum() / ((p["fare_amount"] - p["fare_amount"].mean()) ** 2).sum())
    assert r["Accuracy (%)"] == pytest.approx((1 - min(1, (e.abs() / p["fare_amount"]).mean())) * 100)


def test_metric_edges(spark, scored):
    perfect = M.regression_metrics(scored.withColumn("prediction", F.col("fare_amount"))).first()
    assert (perfect["Accuracy (%)"], perfect["MAE"], perfect["MedAE"], perfect["RMSE"], perfect["R²"]) == (100, 0, 0, 0, 1)
    flat = small_table(spark, [(5.0, 20.0), (5.0, 20.0)], "fare_amount double, prediction double")
    r = M.regression_metrics(flat).first()
    assert r["R²"] is None and r["Accuracy (%)"] == 0.0


def test_union_combines_by_weight(scored):
    a, b = scored.where("hour < 8"), scored.where("hour >= 8")
    na, nb = a.count(), b.count()
    ra, rb, r = (M.regression_metrics(x).first() for x in (a, b, scored))
    assert r["MAE"] == pytest.approx((na * ra["MAE"] + nb * rb["MAE"]) / (na + nb))
    assert r["RMSE"] ** 2 == pytest.approx((na * ra["RMSE"] ** 2 + nb * rb["RMSE"] ** 2) / (na + nb))


def test_compare_runs_by_exact_name(spark):
    new = small_table(spark, [("m", "RMSE", 4.0), ("m", "R²", 0.5), ("x", "MAE", 1.0)], "model string, metric string, value double")
    old = small_table(spark, [("m", "RMSE", 3.0), ("m", "R²", 0.75)], "model string, metric string, value double")
    got = {(r["model"], r["metric"]): (r["baseline"], r["delta"]) for r in M.compare_runs(new, old).collect()}
    assert got == {("m", "RMSE"): (3.0, 1.0), ("m", "R²"): (0.75, -0.25), ("x", "MAE"): (None, None)}
    base = small_table(spark, [("lin", "MAE", 2.0), ("b", "MAE", 1.5)], "model string, metric string, value double")
    assert {r["model"]: r["improvement_pct"] for r in M.improvement_over(base, "lin").collect()} == {"lin": 0.0, "b": 25.0}


def test_zone_summary(scored):
    s = D.zone_error_summary(scored).cache()
    assert s.columns == ["PULocationID", "avg_actual_fare", "avg_pred_fare", "mean_residual", "mae", "median_ae", "n_trips",
                         "abs_mean_residual", "support_group"]
    assert s.agg(F.sum("n_trips")).first()[0] == 3000
    assert s.agg(F.sum(F.col("mae") * F.col("n_trips")) / 3000).first()[0] == pytest.approx(M.regression_metrics(scored).first()["MAE"])
    top = D.top_zones(s, "mae", 3).collect()
    assert [r["mae"] for r in top] == sorted((r["mae"] for r in s.collect()), reverse=True)[:3]
    assert D.supported_zones(s, 500).count() == s.where("n_trips >= 500").count() >= 1
    assert D.support_group_counts(s).agg(F.sum("zones")).first()[0] == s.count()
    assert D.support_vs_error(s).count() == s.count()


def test_empty_bins_stay(scored):
    rows = D.error_by_fare_bin(scored).collect()
    assert [r["fare_bin"] for r in rows] == ["0-10", "10-20", "20-30", "30-40", "40-60", "60+"]
    assert (rows[-1]["n"], rows[-1]["mae"], rows[-1]["median_ae"]) == (0, None, None)
    assert sum(r["n"] for r in rows) == 3000
    far = {r["distance_bin"]: r["n"] for r in D.error_by_distance_bin(scored).collect()}
    assert far["20+"] == 0 and sum(far.values()) == 3000


def test_reports(scored):
    p = scored.toPandas()
    p["ae"] = (p["fare_amount"] - p["prediction"]).abs()
    worst = D.worst_predictions(scored, 15).collect()
    assert [r["row_key"] for r in worst] == list(p.nlargest(15, "ae").sort_values("ae")["row_key"])
    assert {r["direction"] for r in worst} <= {"underpriced", "overpriced"}
    heat = {r["hour"]: r for r in D.error_heatmap_hour_weekday(scored).collect()}
    want = p.groupby(["hour", "day of week"])["ae"].mean()
    assert heat[5]["Sun"] == pytest.approx(want[5, 6])
    assert D.error_heatmap_distance_hour(scored).count() == 5
    assert {r["fare_bin"]: r["n"] for r in D.accuracy_by_fare_class(scored).collect()}.keys() >= {"L ($0-15)", "P ($40-51)"}
    assert D.residual_boxes_by_fare(scored).count() == 4
    trend = D.residual_trend(scored, block=1000).toPandas().sort_values("position")
    q = p.sort_values(["fare_amount", "row_key"])
    np.testing.assert_allclose(trend["trend"], (q["prediction"] - q["fare_amount"]).rolling(500, min_periods=1).mean(), rtol=1e-9, atol=1e-12)


def test_volume_marks_and_shares(spark):
    df = small_table(spark, [(1, "A")] * 5 + [(2, "A"), (3, None), (4, "B"), (4, "B")], "PULocationID int, PU_Boro string")
    assert {r[0]: r["mark"] for r in S.location_volume(df, "PULocationID").collect()} == {1: "peak", 2: "low", 3: "low", 4: "other"}
    assert {r[0]: r["share_pct"] for r in S.borough_share(df).collect()} == {"A": 75.0, "B": 25.0}

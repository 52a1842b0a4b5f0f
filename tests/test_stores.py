"""Stores give back what belongs to their input; distributions ignore NaN."""
import math

import pytest
from pyspark.sql import functions as F

from ride_analytics.operators import histograms as H
from ride_analytics.operators import isolation_forest as IF
from ride_analytics.operators import screening as SC
from ride_analytics.operators import summaries as S
from ride_analytics.operators.quantiles import grouped_quantiles
from ride_analytics.sources import storage
from ride_analytics.sources.trips import load_trips


def test_cached_table_knows_its_input(spark):
    root = storage.fresh_path(spark, "cache")
    a, b = spark.range(3), spark.range(5)
    assert storage.cached_table(spark, root, "k", lambda: a, [a]).count() == 3
    assert storage.cached_table(spark, root, "k", lambda: b, [b]).count() == 5
    assert storage.cached_table(spark, root, "k", lambda: b, [a]).count() == 3  # read back, not built


def test_fingerprint_follows_files_and_plan(spark):
    path = storage.fresh_path(spark, "files")
    spark.range(10).write.parquet(path)
    whole = spark.read.parquet(path)
    first = storage.fingerprint(whole)
    assert first == storage.fingerprint(spark.read.parquet(path)) != storage.fingerprint(whole.where("id > 3"))
    spark.range(11).write.mode("overwrite").parquet(path)
    assert storage.fingerprint(spark.read.parquet(path)) != first


def test_fingerprint_sees_every_column(spark):
    path = storage.fresh_path(spark, "wide")
    spark.range(5).write.parquet(path)
    rows = spark.read.parquet(path)
    a, b = (rows.select(*[(F.col("id") + (k if i == 35 else 0)).alias(f"c{i}") for i in range(40)]) for k in (1, 7))
    assert storage.fingerprint(a) != storage.fingerprint(b)
    assert storage.fingerprint(a) == storage.fingerprint(rows.select(*[(F.col("id") + (1 if i == 35 else 0)).alias(f"c{i}") for i in range(40)]))


def test_models_are_kept_by_all_they_depend_on(spark, known):
    from ride_analytics.config import Config
    from ride_analytics.models import estimators as E
    root, calls = storage.fresh_path(spark, "models"), []
    cfg = Config(feature_mode="RF_95", balance=False)
    rows = known.select(*[F.lit(1.0 + 0.001 * F.hash("row_key")).alias(f) if f != "trip_distance" else F.col(f) for f in cfg.features], "fare_amount")

    def tune():
        calls.append(1)
        return E.linear_model(cfg).fit(rows), {"n": len(calls)}

    assert [storage.load_or_tune(spark, root, "m", tune, key)[1]["n"] for key in ("a", "a", "b", "a")] == [1, 1, 2, 1]


def test_rerun_replaces_its_metrics(spark):
    root = storage.fresh_path(spark, "metrics")
    table = spark.createDataFrame([("m", "MAE", 1.0)], "model string, metric string, value double")
    for run, value in (("one", 1.0), ("two", 2.0), ("one", 3.0)):
        storage.append_metrics(table.withColumn("value", F.lit(value)), root, run)
    assert sorted((r.run, r.value) for r in storage.load_metrics(spark, root).collect()) == [("one", 3.0), ("two", 2.0)]


def test_reloaded_forest_keeps_its_columns(spark, known, tmp_path):
    model = IF.IsolationForest(inputCols=["trip_distance", "fare_amount"], keyCol="row_key", scoreCol="s", predictionCol="p", numTrees=5).fit(known)
    model.save(spark, str(tmp_path / "f"))
    assert {"s", "p"} <= set(IF.IsolationForestModel.load(spark, str(tmp_path / "f")).transform(known).columns)


def test_nan_counts_as_null(spark):
    df = spark.createDataFrame([(float(i), float(i)) for i in range(101)] + [(math.nan, 1.0), (None, 2.0), (1.0, math.nan)], "x double, y double")
    rows = H.histogram(df, "x", 10).collect()
    assert sum(r.n for r in rows) == 102 and max(r.bin_high for r in rows) == 100.0
    assert not any(math.isnan(r.density) for r in H.density_curve(df, "x").collect())
    assert sum(r.n for r in H.hexagons(df, "x", "y").collect()) == 101
    assert S.value_range(df, "x", "y").first()[:2] == (0.0, 100.0)
    corr = {(r.x, r.y): r["corr"] for r in SC.correlation_matrix(df, ["x", "y"]).collect()}
    assert abs(corr["x", "y"] - 1) < 1e-9  # over the rows that have both


def test_sketch_takes_no_weights(spark):
    with pytest.raises(ValueError):
        grouped_quantiles(spark.range(3).withColumn("w", F.lit(1)), [], "id", {"m": 0.5}, weight="w", approx=True)


def test_months_of_different_types_are_read_together(spark, known):
    a, b = storage.fresh_path(spark, "month"), storage.fresh_path(spark, "month")
    known.limit(5).withColumn("passenger_count", F.lit(1)).write.parquet(a)
    known.limit(7).withColumn("passenger_count", F.lit(2.0)).write.parquet(b)
    got = load_trips(spark, [a, b])
    assert got.count() == 12 and dict(got.dtypes)["passenger_count"] == "double"

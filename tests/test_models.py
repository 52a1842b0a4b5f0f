import pytest
from pyspark.sql import functions as F

from conftest import known_trips
from ride_analytics.config import FEATURE_SETS, Config
from ride_analytics.models import estimators as E
from ride_analytics.models import importance as I
from ride_analytics.models import tuning as T
from ride_analytics.operators import metrics as M
from ride_analytics.plans import drift, exploration, prepare, training
from ride_analytics.sources import storage

CFG = Config(home_borough="Home", feature_mode="FULL", zone_clusters=4, cluster_rounds=2, folds=3, balance_target=1500)


@pytest.fixture(scope="module")
def data(spark, known, known_zones, known_holidays, tmp_path_factory):
    return prepare.prepare(known, known_zones, known_holidays, CFG, str(tmp_path_factory.mktemp("prepared")))


@pytest.fixture(scope="module")
def fitted(spark, data):
    storage.shared_dir(spark)
    return {"Linear Baseline": E.linear_model(CFG).fit(data.train),
            "Random Forest": E.random_forest(CFG, numTrees=20, maxDepth=8).fit(data.train),
            "Boosted Trees": E.boosted_trees(CFG, maxIter=15, maxDepth=4).fit(data.train)}


def test_prepared_parts(spark, data, known, known_zones, known_holidays):
    assert data.test.where("trip_distance >= 60").count() == 0          # planted outliers are gone
    train_keys, test_keys = data.train.select("row_key").distinct(), data.test.select("row_key")
    assert train_keys.join(test_keys, "row_key").count() == 0
    assert data.train.groupBy("row_key").agg(F.countDistinct("fold").alias("n")).where("n > 1").count() == 0
    again = prepare.load_prepared(spark, data.root)
    assert again.train.count() == data.train.count()
    legacy = Config(**{**CFG.__dict__, "legacy_folds": True})
    rows = prepare.training_rows(known_clean(known, known_zones, known_holidays), data.tables, legacy)
    assert rows.groupBy("row_key").agg(F.countDistinct("fold").alias("n")).where("n > 1").count() > 0


def known_clean(known, zones, holidays):
    from ride_analytics.operators.cleaning import clean_trips
    return clean_trips(known, zones, holidays, CFG)


def test_feature_vector_layout(spark, data):
    from pyspark.ml.functions import vector_to_array
    for mode, n in (("FULL", 15), ("XGB_95", 11), ("RF_95", 3)):
        cfg = Config(**{**CFG.__dict__, "feature_mode": mode})
        assert len(E.feature_names(cfg)) == n
        model = E.Pipeline(stages=E.feature_stages(cfg)).fit(data.train)
        x = model.transform(data.train).select(vector_to_array("features").alias("x"), "hour")
        r = x.agg(F.avg(F.col("x")[0]), F.stddev_samp(F.col("x")[0]), F.max(F.size("x")), F.min(F.size("x"))).first()
        assert r[0] == pytest.approx(0, abs=1e-9) and r[1] == pytest.approx(1) and r[2] == r[3] == n
    assert set(FEATURE_SETS) == {"FULL", "XGB_95", "RF_95"}


def test_models_learn_the_known_truth(spark, data, fitted):
    got = {r["Model"]: r for r in training.evaluate(fitted, data.test, CFG).collect()}
    assert got["Linear Baseline"]["R²"] > 0.85
    assert got["Boosted Trees"]["R²"] > 0.93 and got["Boosted Trees"]["MAE"] < got["Linear Baseline"]["MAE"]
    assert E.elastic_net(CFG).fit(data.train).transform(data.test).count() == data.test.count()
    coef = {r["feature"]: r["coefficient"] for r in E.coefficients(spark, fitted["Linear Baseline"], CFG).collect()}
    assert len(coef) == 16 and coef["trip_distance"] > 0


def test_importances(spark, data, fitted):
    tables = training.explain(fitted["Linear Baseline"], {k: v for k, v in fitted.items() if k != "Linear Baseline"}, data, CFG)
    per = tables["importances"].groupBy("Model").agg(F.sum("Importance (%)").alias("s"), F.max_by("Feature", "Importance (%)").alias("top"))
    for r in per.collect():
        assert r["s"] == pytest.approx(100) and r["top"] == "trip_distance"
    assert tables["sufficient"].where("Model = 'Linear Baseline'").count() == 0
    assert tables["sufficient"].groupBy("Model").agg(F.max("cumulative").alias("c")).where("c < 95").count() == 0
    assert I.linear_importances(fitted["Linear Baseline"], None, CFG, spark=spark).count() == 15
    forest = I.native_importances(spark, fitted["Random Forest"], CFG, "Random Forest")
    assert I.secondary_importances(forest).where("Feature = 'trip_distance'").count() == 0


def test_permutation_importance(data, fitted):
    got = {r["Feature"]: r for r in I.permutation_importance(fitted["Boosted Trees"], data.test, ["trip_distance", "passenger_count", "PU_fare_avg"], CFG, 3).collect()}
    assert got["passenger_count"]["MeanImportance"] == pytest.approx(0, abs=1e-9)
    assert got["trip_distance"]["MeanImportance"] > 5 > got["PU_fare_avg"]["MeanImportance"]


def test_curves_and_attributions(data, fitted):
    model = fitted["Linear Baseline"]
    curves = I.individual_curves(model, data.test, "trip_distance", points=5, rows=40)
    assert curves.count() == 200
    pdp = [r["mean_prediction"] for r in I.partial_dependence(curves).collect()]
    assert pdp == sorted(pdp) and len(pdp) == 5
    features = ["trip_distance", "hour", "PU_fare_avg"]
    got = I.sampled_attributions(model, data.test, features, CFG, rows=20, permutations=4)
    assert got.count() == 60
    size = got.groupBy("feature").agg(F.avg(F.abs("attribution")).alias("a")).orderBy(F.desc("a")).first()
    assert size["feature"] == "trip_distance"


def test_mape_evaluator(spark, tmp_path):
    from ride_analytics.sources.small import small_table
    df = small_table(spark, [(10.0, 11.0), (20.0, 10.0)], "fare_amount double, prediction double")
    e = T.mape(CFG)
    assert e.evaluate(df) == pytest.approx(0.3) and not e.isLargerBetter()


def test_searches(data):
    forest = E.random_forest(CFG, numTrees=5)
    model, best, scored = T.random_search(forest, {"maxDepth": (1, 6)}, data.train, 2, T.mae(CFG), CFG)
    assert best == {"maxDepth": 6} and len(scored) == 2
    assert model.stages[-1].getOrDefault("maxDepth") == 6
    model, best, history = T.halving_search(forest, {"maxDepth": (1, 3, 6), "minInstancesPerNode": (1, 4)}, data.train, T.mae(CFG), CFG, min_rows=700)
    rounds = [sum(1 for h in history if h[0] == i) for i in range(max(h[0] for h in history) + 1)]
    assert rounds[0] == 6 and rounds == sorted(rounds, reverse=True) and rounds[-1] <= 2
    assert best["maxDepth"] == 6
    assert T.sample_grid({"a": (1, 2, 3), "b": (1, 2)}, 4, 1) == T.sample_grid({"a": (1, 2, 3), "b": (1, 2)}, 4, 1)


def test_best_size():
    assert T.best_size([5, 4, 3, 3.5, 3.2, 2.9], patience=2) == 3
    assert T.best_size([5, 4, 3, 3.5, 3.2, 2.9], patience=5) == 6
    assert T.best_size([1.0], 50) == 1


def test_early_stopping(data):
    model, size, errors = T.early_stopped_boosting(E.boosted_trees(CFG, maxDepth=3, stepSize=0.3), data.train, CFG, ceiling=10, patience=3)
    assert len(errors) == 10 and size == T.best_size(errors, 3)
    assert model.stages[-1].getNumTrees == size


def test_quick_comparison_and_learning_curve(data):
    table = T.quick_comparison({"Linear": (E.linear_model(CFG), {}), "Forest": (E.random_forest(CFG, numTrees=5), {"maxDepth": (2, 4)})},
                               data.train, CFG, rows=3000, n=2).collect()
    assert [r["Model"] for r in table] == ["Linear", "Forest"]
    assert all(0 < r["CV MAPE"] < 1 and r["CV Accuracy (%)"] == pytest.approx((1 - r["CV MAPE"]) * 100) for r in table)
    curve = I.learning_curve({"Linear": E.linear_model(CFG)}, data.train, CFG, fractions=(0.2, 1.0))
    assert curve.count() == 6
    summary = I.curve_summary(curve).orderBy("level").collect()
    assert summary[0]["train_rows"] < summary[1]["train_rows"]


def test_training_job_saves_and_reloads(spark, data, tmp_path):
    models = {"Linear Baseline": (E.linear_model(CFG), {})}
    args = dict(models=models, forest_grid={"numTrees": (5,), "maxDepth": (3, 5)}, boost_grid={"maxDepth": (2, 3), "maxIter": (3,)},
                n=2, ceiling=4, patience=2)
    tables, fitted = training.train_and_evaluate(data, CFG, str(tmp_path), **args)
    again, _ = training.train_and_evaluate(data, CFG, str(tmp_path), run="second", **args)
    assert again["params"] == tables["params"]
    assert storage.load_metrics(spark, f"{tmp_path}/metrics", "second").count() == 10
    report = training.diagnose({"Boosted Trees": fitted["Boosted Trees"]}, data, CFG)["Boosted Trees"]
    assert report["zone_summary"].agg(F.sum("n_trips")).first()[0] == data.test.count()
    assert report["worst_trips"].count() == 15


def test_drift_of_dearer_month(spark, data, fitted, known_zones, known_holidays):
    later = drift.later_period(known_trips(spark, 3000, 1.1, seed=99), known_zones, known_holidays, data.tables, CFG)
    base = M.to_long(training.evaluate(fitted, data.test, CFG))
    out = drift.drift_test(later, {"Boosted Trees": fitted["Boosted Trees"]}, base, CFG)
    delta = {r["metric"]: r["delta"] for r in out["comparison"].collect()}
    assert delta["MAE"] > 0.5 and delta["R²"] < 0 and set(delta) == set(M.METRICS)
    assert out["Boosted Trees"]["trend"].count() == later.count()


def test_exploration(spark, known, known_zones, known_holidays):
    e = exploration.explore(known, known_zones, known_holidays, CFG)
    assert e.city.count() > e.borough.count() > e.clean.count()
    figures = exploration.figures(e, sample=500)
    assert len(figures) == 15 and figures["outliers_before"].where("`is outlier`").count() == 5
    stats = exploration.statistics(e)
    assert [r["n"] for r in stats["funnel"].collect()] == [e.city.count(), e.borough.count(), e.clean.count()]
    screen = exploration.screen(e)
    assert {r["column"]: r["status"] for r in screen["scan"].collect()}["passenger_count"] == "DROP"
    assert screen["components"].agg(F.max("cumulative")).first()[0] >= 0.99


def test_scoring_points_fits_no_more_than_it_must(data, monkeypatch):
    """features once per fold, the model once per fold and point, nothing on all rows; errors as Spark's cross-validator."""
    from pyspark.ml.feature import StandardScaler
    from pyspark.ml.regression import RandomForestRegressor
    from pyspark.ml.tuning import CrossValidator
    forest = E.random_forest(CFG, numTrees=3, maxDepth=3)
    depth = forest.getStages()[-1].maxDepth
    theirs = CrossValidator(estimator=forest, estimatorParamMaps=[{depth: 2}, {depth: 4}], evaluator=T.mae(CFG), numFolds=CFG.folds, foldCol="fold").fit(data.train)
    fits = []
    for stage in (StandardScaler, RandomForestRegressor):
        monkeypatch.setattr(stage, "_fit", lambda self, df, was=stage._fit, name=stage.__name__: fits.append(name) or was(self, df))
    ours = T.cross_validate(forest, data.train, [{"maxDepth": 2}, {"maxDepth": 4}], T.mae(CFG), CFG)
    assert ours == pytest.approx(theirs.avgMetrics, rel=1e-9)
    assert (fits.count("StandardScaler"), fits.count("RandomForestRegressor")) == (CFG.folds, 2 * CFG.folds)
    with pytest.raises(ValueError):
        T.cv_score(forest, data.train.where("fold <> 1"), T.mae(CFG), CFG)


def counted(monkeypatch, kind):
    calls, fit = [], kind.fit
    monkeypatch.setattr(kind, "fit", lambda self, *a, **kw: calls.append(1) or fit(self, *a, **kw))
    return calls


def test_models_of_the_same_features_share_them(data, fitted, monkeypatch):
    """one fit of the feature stages for all models, which are those fitted alone."""
    scalers = counted(monkeypatch, E.StandardScaler)
    both = E.fit_together({"l": E.linear_model(CFG), "f": E.random_forest(CFG, numTrees=3, maxDepth=3)}, data.train)
    assert len(scalers) == 1
    assert both["l"].stages[-1].coefficients.toArray() == pytest.approx(fitted["Linear Baseline"].stages[-1].coefficients.toArray(), abs=1e-6)
    alone = E.fit_stored(E.random_forest(CFG, numTrees=3, maxDepth=3), data.train)
    assert both["f"].stages[-1].toDebugString.split("\n", 1)[1] == alone.stages[-1].toDebugString.split("\n", 1)[1]
    other = Config(**{**CFG.__dict__, "feature_mode": "RF_95"})
    apart = E.fit_together({"l": E.linear_model(CFG), "m": E.linear_model(other)}, data.train)
    assert len(apart["l"].stages[-1].coefficients) == 15 and len(apart["m"].stages[-1].coefficients) == 3
    assert E.fit_together({}, data.train) == {}


def test_scores_by_several_measures_take_one_fit_per_fold(data, monkeypatch):
    """the models of the folds are fitted once for all measures."""
    alone = [T.cv_score(E.linear_model(CFG), data.train, e(CFG), CFG) for e in (T.mape, T.mae)]
    fits = counted(monkeypatch, E.LinearRegression)
    assert T.cv_scores(E.linear_model(CFG), data.train, [T.mape(CFG), T.mae(CFG)], CFG) == pytest.approx(alone)
    assert len(fits) == CFG.folds


def test_prepared_trips_are_written_narrow_and_once(spark, data, known, known_zones, known_holidays, monkeypatch, tmp_path):
    """F6 to F22: the kept trips hold the speeds and only what is read; the feature tables are learned from them without a copy."""
    from ride_analytics.operators import feature_tables as FT
    monkeypatch.setattr(FT, "speed_rows", lambda df: pytest.fail("the trips are written again"))
    again = prepare.prepare(known, known_zones, known_holidays, CFG, str(tmp_path / "again"))
    kept = spark.read.parquet(f"{again.root}/kept")
    assert "speed_mph" in kept.columns and not {"VendorID", "extra", "tpep_dropoff_datetime"} & set(kept.columns)
    monkeypatch.undo()
    clean = spark.read.parquet(f"{again.root}/clean")
    train = prepare.with_test_flag(prepare.inliers(again.forest.transform(clean)), CFG.test_percent).where("not is_test")
    whole = FT.fit_feature_tables(train, CFG)
    for name in ("route_stats", "zone_hour_speed"):
        assert getattr(whole, name).exceptAll(getattr(again.tables, name)).count() == 0
    assert whole.globals.first()["median_speed"] == again.tables.globals.first()["median_speed"]


def test_trips_of_an_exploration_are_joined_once(known, known_zones, known_holidays, monkeypatch):
    """the forest is fitted on written trips."""
    seen, real = [], exploration.fit_outliers
    monkeypatch.setattr(exploration, "fit_outliers", lambda df, *rest: (seen.extend(df.inputFiles()), real(df, *rest))[1])
    exploration.explore(known, known_zones, known_holidays, CFG)
    assert seen and all("staged-trips" in f for f in seen)


def test_forest_reads_narrow_trips(spark, data):
    """F8 to F21: what nobody reads after the row rules is not written, and the test flag is found once."""
    clean = spark.read.parquet(f"{data.root}/clean")
    assert not {"VendorID", "extra", "mta_tax", "PU_Boro"} & set(clean.columns)
    assert "is_test" in clean.columns and prepare.model_rows(clean, CFG).columns == clean.columns


def test_halving_draws_each_sample_once(data, monkeypatch):
    """the folds of a round read a kept sample; F11: of many rows fewer models are fitted at the same time."""
    kept, real = [], T.cross_validate
    monkeypatch.setattr(T, "cross_validate", lambda p, df, *rest, **kw: (kept.append((df.count(), df.storageLevel.useMemory)), real(p, df, *rest, **kw))[1])
    T.halving_search(E.random_forest(CFG, numTrees=2), {"maxDepth": (1, 2, 3)}, data.train, T.mae(CFG), CFG, min_rows=500)
    rows = data.train.count()
    assert len(kept) > 1 and all(used == (n < rows) for n, used in kept)
    assert [T.fits_at_once(n, 8) for n in (0, 700_000, 7_000_000, 44_000_000)] == [8, 8, 2, 1]

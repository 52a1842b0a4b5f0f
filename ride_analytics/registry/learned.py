"""Forest, clusters, components, models and the composite jobs.

Their results depend on random draws or iterative fits, so most have no SQL.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ride_analytics.config import FEATURE_SETS, Config
from ride_analytics.models import estimators as E
from ride_analytics.models import importance as I
from ride_analytics.models import tuning as T
from ride_analytics.operators import feature_tables as FT
from ride_analytics.operators import isolation_forest as IF
from ride_analytics.operators import sampling as SA
from ride_analytics.operators import screening as SC
from ride_analytics.operators import summaries as S
from ride_analytics.operators.zone_clusters import cluster_zones
from ride_analytics.plans import drift, exploration, prepare, training
from ride_analytics.functions.bins import FARE_CLASSES
from ride_analytics.registry.base import case_bins, check_holidays, city, hash_sql, query, rounded, sql, trips, zones
from ride_analytics.sources import storage
from ride_analytics.sources.trips import in_months

# All training rows, with the defaults of the library for clusters and folds. How many trees a query grows, and how
# deep, is a parameter of these queries; it leaves out no row.
CFG = Config(home_borough=None, feature_mode="FULL", balance=False)
FOREST = {"numTrees": 10, "maxDepth": 5}
TARGET = 30_000   # rows of each class after balancing
BOOST = {"maxIter": 8, "maxDepth": 3, "stepSize": 0.3}


def years(df: DataFrame, *which: int) -> DataFrame:
    return df.where(in_months("tpep_pickup_datetime", [f"{y}-{m:02d}" for y in which for m in range(1, 13)]))


@lru_cache(maxsize=4)
def _prepared_root(app: str, sf: str) -> str:
    from pyspark.sql import SparkSession
    return storage.fresh_path(SparkSession.active(), "check-prepared")


def prepared(spark, sf) -> prepare.Prepared:
    """Written once per session and data folder, read back by the later queries."""
    root = _prepared_root(spark.sparkContext.applicationId, sf)
    return prepare.prepare(trips(spark, sf), zones(spark, sf), check_holidays(spark), CFG, root)


MODELS = {"linear": lambda: E.linear_model(CFG), "elastic": lambda: E.elastic_net(CFG),
          "forest": lambda: E.random_forest(CFG, **FOREST), "boosted": lambda: E.boosted_trees(CFG, **BOOST)}


@lru_cache(maxsize=4)
def _models(app: str, sf: str) -> dict:
    """Models fitted so far in this session, by kind."""
    return {}


def fitted(spark, sf, *kinds):
    """One model, or several that are fitted together as far as they are not there yet."""
    data, known = prepared(spark, sf), _models(spark.sparkContext.applicationId, sf)
    storage.shared_dir(spark)
    known.update(E.fit_together({k: MODELS[k]() for k in kinds if k not in known}, data.train))
    return known[kinds[0]] if len(kinds) == 1 else [known[k] for k in kinds]


def flagged(spark, sf):
    df = storage.written(city(spark, sf), "clean")
    return IF.fit_outliers(df).transform(df)


# --- outliers, clusters, components -------------------------------------------------
@query("isolation_forest_flags", None)
def _(spark, sf):
    return flagged(spark, sf).select("row_key", "fare_amount", "trip_distance", "outlier score", "is outlier")


@query("inliers_only", None)
def _(spark, sf):
    return IF.inliers(flagged(spark, sf)).select("row_key", "fare_amount", "trip_distance")


@query("inlier_and_outlier_counts", sql("SELECT count(*) AS trips, count(DISTINCT row_key) AS keys, true AS share_as_set, true AS scores_agree FROM city"))
def _(spark, sf):
    """Inliers and outliers together are all clean trips; at most the set share is flagged, less only by ties of the
    cut-off, and every outlier scores above every inlier."""
    df = storage.written(flagged(spark, sf), "flagged")
    n, most, top, low = df.agg(F.count(F.lit(1)), F.count_if("`is outlier`"), F.max(F.when(~F.col("is outlier"), F.col("outlier score"))),
                               F.min(F.when(F.col("is outlier"), F.col("outlier score")))).first()
    tied = df.where(F.col("outlier score") == F.lit(top)).count()
    both = IF.inliers(df).select("row_key").unionByName(IF.outliers(df).select("row_key"))
    share = CFG.contamination
    return both.agg(F.count(F.lit(1)).alias("trips"), F.countDistinct("row_key").alias("keys"),
                    F.lit(share * n - tied - 1 <= most <= share * n + 1).alias("share_as_set"), F.lit(low is None or low > top).alias("scores_agree"))


@query("reloaded_forest_flags", sql("SELECT count(*) AS trips, 0 AS differ FROM city"))
def _(spark, sf):
    """A forest read back from disk flags the same trips, under its own column names."""
    df = storage.written(city(spark, sf), "clean")
    model = IF.IsolationForest(contamination=0.02, keyCol="row_key", scoreCol="s", predictionCol="odd").fit(df)
    path = storage.fresh_path(spark, "forest")
    model.save(spark, path)
    again = IF.IsolationForestModel.load(spark, path)
    both = model.transform(df).select("row_key", "s", "odd").join(again.transform(df).select("row_key", F.col("s").alias("t"), F.col("odd").alias("odd2")), "row_key")
    return both.agg(F.count(F.lit(1)).alias("trips"), F.count_if((F.col("s") != F.col("t")) | (F.col("odd") != F.col("odd2"))).cast("int").alias("differ"))


@query("paired_outlier_sample", None)
def _(spark, sf):
    return SA.paired_outlier_sample(flagged(spark, sf), 2_000).select("row_key", "fare_amount", "is outlier")


def cluster_views(where: str, source: str = "city") -> list[str]:
    """SQL views of the same clustering, ``numbered`` the last: each seed and each round is a view of its own."""
    far = "(z.f - s.f) ** 2 + (z.d - s.d) ** 2"
    out = [f"""z AS MATERIALIZED (SELECT PULocationID AS id, avg(fare_amount) AS f, avg(trip_distance) AS d FROM {source} {where} GROUP BY 1)""",
           "s0 AS MATERIALIZED (SELECT 0 AS i, f, d FROM z ORDER BY f, d LIMIT 1)",
           f"n0 AS MATERIALIZED (SELECT z.*, {far} AS m FROM z, s0 s)"]
    for i in range(1, CFG.zone_clusters):
        out += [f"s{i} AS MATERIALIZED (SELECT {i} AS i, f, d FROM n{i - 1} WHERE m > 0 ORDER BY m DESC, id LIMIT 1)",
                f"n{i} AS MATERIALIZED (SELECT z.* REPLACE (least(z.m, coalesce({far}, z.m)) AS m) FROM n{i - 1} z LEFT JOIN s{i} s ON true)"]
    out.append("c0 AS MATERIALIZED (" + " UNION ALL ".join(f"SELECT * FROM s{i}" for i in range(CFG.zone_clusters)) + ")")
    for r in range(CFG.cluster_rounds + 1):
        out.append(f"a{r} AS MATERIALIZED (SELECT z.id, z.f, z.d, s.i FROM z, c{r} s QUALIFY row_number() OVER (PARTITION BY z.id ORDER BY {far}, s.i) = 1)")
        out.append(f"c{r + 1} AS MATERIALIZED (SELECT c.i, coalesce(avg(a.f), any_value(c.f)) AS f, coalesce(avg(a.d), any_value(c.d)) AS d FROM c{r} c LEFT JOIN a{r} a ON a.i = c.i GROUP BY c.i)")
    last = CFG.cluster_rounds
    out.append(f"""numbered AS MATERIALIZED (SELECT a.id AS PULocationID, a.f AS mean_fare, a.d AS mean_distance, c.rank AS pickup_cluster
      FROM a{last} a JOIN (SELECT i, CAST(row_number() OVER (ORDER BY f, d) - 1 AS INTEGER) AS rank FROM c{last}) c ON c.i = a.i)""")
    return out


@query("zone_clusters", sql("SELECT * FROM numbered", *cluster_views(""), doubles=["mean_fare", "mean_distance"]))
def _(spark, sf):
    profile = storage.written(S.zone_profile(city(spark, sf)), "zone-profile")
    return rounded(cluster_zones(profile, CFG.zone_clusters, CFG.cluster_rounds))


@query("cluster_lookup", sql("SELECT row_key, c.PULocationID, coalesce(n.pickup_cluster, -1) AS pickup_cluster FROM city c LEFT JOIN numbered n ON n.PULocationID = c.PULocationID",
                              *cluster_views("WHERE PU_Boro = 'ASIA'")))
def _(spark, sf):
    """Clusters learned from the home borough; other zones get -1."""
    df = city(spark, sf)
    profile = storage.written(S.zone_profile(df.where("PU_Boro = 'ASIA'")), "zone-profile")
    table = storage.written(cluster_zones(profile, CFG.zone_clusters, CFG.cluster_rounds), "zone-cluster")
    return FT.add_clusters(df, table).select("row_key", "PULocationID", "pickup_cluster")


def _feature_set(mode):
    listed = ", ".join(f'"{c}"' for c in FEATURE_SETS[mode]["features"])
    learned = [c for c in FEATURE_SETS[mode]["features"] if c in ("PU_fare_avg", "DO_fare_avg", "route_avg_speed")]

    @query(f"feature_set_{mode.lower()}", sql(f"SELECT row_key, {listed}, fare_amount FROM looked_up", *LEARNED_VIEWS, doubles=learned))
    def _(spark, sf):
        """All columns of the set: tables learned from the training trips, looked up for the test trips."""
        df = SA.with_test_flag(city(spark, sf))
        cfg = Config(home_borough=None, feature_mode=mode)
        tables = FT.fit_feature_tables(df.where(~F.col("is_test")), cfg)
        out = FT.apply_feature_tables(df.where("is_test"), tables)
        return rounded(out.select("row_key", *[F.col(f"`{c}`") for c in cfg.features], "fare_amount"))


LEARNED_VIEWS = [
    f"tagged AS MATERIALIZED (SELECT row_key, {hash_sql()} % 100 < 20 AS is_test FROM city)",
    "train AS MATERIALIZED (SELECT s.* FROM speeds s JOIN tagged t ON s.row_key = t.row_key WHERE NOT t.is_test)",
    *cluster_views("", "train"),
    """looked_up AS (SELECT c.*, coalesce(p.f, g.f) AS PU_fare_avg, coalesce(d.f, g.f) AS DO_fare_avg, coalesce(n.pickup_cluster, -1) AS pickup_cluster,
        coalesce(r.s, b.s, g.s) AS route_avg_speed, coalesce(r.n, 0) AS route_popularity
      FROM city c JOIN tagged t ON c.row_key = t.row_key
      LEFT JOIN (SELECT PULocationID AS k, avg(fare_amount) AS f FROM train GROUP BY 1) p ON c.PULocationID = p.k
      LEFT JOIN (SELECT DOLocationID AS k, avg(fare_amount) AS f FROM train GROUP BY 1) d ON c.DOLocationID = d.k
      LEFT JOIN numbered n ON n.PULocationID = c.PULocationID
      LEFT JOIN (SELECT PULocationID AS k, DOLocationID AS l, "hour" AS h, median(speed_mph) AS s, count(speed_mph) AS n FROM train GROUP BY 1, 2, 3) r
        ON c.PULocationID = r.k AND c.DOLocationID = r.l AND c."hour" = r.h
      LEFT JOIN (SELECT PULocationID AS k, "hour" AS h, median(speed_mph) AS s FROM train GROUP BY 1, 2) b ON c.PULocationID = b.k AND c."hour" = b.h
      CROSS JOIN (SELECT median(speed_mph) AS s, avg(fare_amount) AS f FROM train) g WHERE t.is_test)""",
]
for _mode in FEATURE_SETS:
    _feature_set(_mode)


@query("cluster_lookup_unseen_zones", sql("SELECT PU_Boro <> 'ASIA' AS unseen, count(*) AS n FROM city GROUP BY 1"))
def _(spark, sf):
    """Exactly the trips from zones outside the learned borough have no cluster."""
    df = city(spark, sf)
    profile = storage.written(S.zone_profile(df.where("PU_Boro = 'ASIA'")), "zone-profile")
    table = storage.written(cluster_zones(profile, CFG.zone_clusters, CFG.cluster_rounds), "zone-cluster")
    return (FT.add_clusters(df, table).groupBy((F.col("pickup_cluster") == -1).alias("unseen"))
              .agg(F.count(F.lit(1)).alias("n")))


SCREENED = ["trip_distance", "hour", "day of week", "passenger_count", "is weekend", "is_night_fare", "is_rush_hour"]


@query("component_shares", None)
def _(spark, sf):
    return SC.component_shares(storage.written(city(spark, sf), "clean"), SCREENED)


@query("component_loadings", None)
def _(spark, sf):
    return SC.component_loadings(storage.written(city(spark, sf), "clean"), SCREENED)


@query("component_scores", None)
def _(spark, sf):
    return SC.component_scores(storage.written(city(spark, sf), "clean"), SCREENED)


# --- preparation ----------------------------------------------------------------------
@query("prepared_training_rows", None)
def _(spark, sf):
    return prepared(spark, sf).train


@query("prepared_test_rows", None)
def _(spark, sf):
    return prepared(spark, sf).test


@query("balanced_class_sizes", sql(f"""SELECT {case_bins("fare_amount", FARE_CLASSES)} AS class, CAST({TARGET} AS BIGINT) AS n,
    CASE WHEN count(*) >= {TARGET} THEN CAST({TARGET} AS BIGINT) ELSE CAST(0 AS BIGINT) END AS originals
  FROM city GROUP BY 1 HAVING class IS NOT NULL"""))
def _(spark, sf):
    """Each class has exactly the target size: its own rows where it has enough, else drawn copies."""
    df = SA.balance_classes(city(spark, sf).select("row_key", "fare_amount", "trip_distance"), TARGET)
    return (df.groupBy(FARE_CLASSES.label(F.col("fare_amount")).alias("class"))
            .agg(F.count(F.lit(1)).alias("n"), F.countDistinct(F.when(F.col("copy") == 0, F.col("row_key"))).alias("originals")))


@query("prepared_parts", sql("""SELECT years, count(*) AS rows_in_split, count(DISTINCT row_key) AS keys FROM (
    SELECT CASE WHEN tpep_pickup_datetime < TIMESTAMP '1997-01-01' THEN 1996 ELSE 2000 END AS years, row_key FROM city
    WHERE (tpep_pickup_datetime >= TIMESTAMP '1996-01-01' AND tpep_pickup_datetime < TIMESTAMP '1997-01-01')
       OR (tpep_pickup_datetime >= TIMESTAMP '2000-01-01' AND tpep_pickup_datetime < TIMESTAMP '2001-01-01')) GROUP BY 1"""))
def _(spark, sf):
    """Two years prepared under one root: each gets its own trips back, none lost but the outliers the forest names."""
    root, out = storage.fresh_path(spark, "two-years"), None
    for year in (1996, 2000):
        data = prepare.prepare(years(trips(spark, sf), year), zones(spark, sf), check_holidays(spark), CFG, root)
        clean = spark.read.parquet(f"{data.root}/clean")
        flagged_rows = data.forest.transform(clean).where(F.col("is outlier")).select("row_key")
        keys = data.train.select("row_key").unionByName(data.test.select("row_key")).unionByName(flagged_rows)
        one = keys.agg(F.lit(year).alias("years"), F.count(F.lit(1)).alias("rows_in_split"), F.countDistinct("row_key").alias("keys"))
        out = one if out is None else out.unionByName(one)
    return out


@query("out_of_fold_zone_fares", sql("""SELECT c.row_key, coalesce((z.s - f.s) / nullif(z.n - f.n, 0), (a.s - o.s) / nullif(a.n - o.n, 0)) AS PU_fare_oof
  FROM folded c JOIN (SELECT PULocationID AS k, fold, sum(fare_amount) AS s, count(*) AS n FROM folded GROUP BY 1, 2) f ON c.PULocationID = f.k AND c.fold = f.fold
    JOIN (SELECT PULocationID AS k, sum(fare_amount) AS s, count(*) AS n FROM folded GROUP BY 1) z ON c.PULocationID = z.k
    JOIN (SELECT fold, sum(fare_amount) AS s, count(*) AS n FROM folded GROUP BY 1) o ON c.fold = o.fold
    CROSS JOIN (SELECT sum(fare_amount) AS s, count(*) AS n FROM folded) a""",
    "folded AS (SELECT *, CAST(CAST(concat('0x', substr(md5(concat('fold:', row_key)), 1, 8)) AS BIGINT) % 5 AS INTEGER) AS fold FROM city)",
    doubles=["PU_fare_oof"]))
def _(spark, sf):
    df = SA.with_fold(city(spark, sf))
    return rounded(FT.out_of_fold_zone_fares(df, "PULocationID", "PU_fare_oof").select("row_key", "PU_fare_oof"))


# --- models -----------------------------------------------------------------------------
@query("feature_vectors", None)
def _(spark, sf):
    model = E.Pipeline(stages=E.feature_stages(CFG)).fit(prepared(spark, sf).train)
    x = vector_to_array("features")
    return model.transform(prepared(spark, sf).test).select("row_key", *[x[i].alias(n) for i, n in enumerate(E.feature_names(CFG))])


for _kind in ("linear", "elastic", "forest", "boosted"):
    @query({"linear": "linear_model_predictions", "elastic": "elastic_net_predictions",
            "forest": "random_forest_predictions", "boosted": "boosted_tree_predictions"}[_kind], None)
    def _(spark, sf, kind=_kind):
        return fitted(spark, sf, kind).transform(prepared(spark, sf).test).select("row_key", "fare_amount", "prediction")


@query("least_squares_residuals", sql("SELECT 'all' AS part, 0.0 AS mean_residual, 0.0 AS residual_times_distance FROM city LIMIT 1",
       doubles=["mean_residual", "residual_times_distance"]))
def _(spark, sf):
    """Least squares leave residuals over the training part that average to 0 and are orthogonal to a feature."""
    scored = fitted(spark, sf, "linear").transform(prepared(spark, sf).train).withColumn("r", F.col("fare_amount") - F.col("prediction"))
    clean = lambda c: F.round(c, 4) + 0.0  # noqa: E731  no negative zero
    return scored.agg(F.lit("all").alias("part"), clean(F.avg("r")).alias("mean_residual"),
                      clean(F.avg(F.col("r") * F.log1p("trip_distance"))).alias("residual_times_distance"))


@query("component_norms", sql(f"""SELECT i AS component, 1.0 AS squared_length FROM range(1, {len(SCREENED) + 1}) AS g(i) WHERE EXISTS (SELECT 1 FROM city)""",
       doubles=["squared_length"]))
def _(spark, sf):
    """The loadings of each component have length 1."""
    table = SC.component_loadings(storage.written(city(spark, sf), "clean"), SCREENED)
    return table.groupBy(F.col("component").cast("bigint").alias("component")).agg(F.round(F.sum(F.col("loading") ** 2), 6).alias("squared_length"))


@query("zones_in_clusters", sql("SELECT PULocationID, 1 AS clusters, true AS in_range FROM city GROUP BY 1"))
def _(spark, sf):
    """Every zone is in exactly one of the clusters."""
    profile = storage.written(S.zone_profile(city(spark, sf)), "zone-profile")
    table = cluster_zones(profile, CFG.zone_clusters, CFG.cluster_rounds)
    return table.groupBy("PULocationID").agg(F.countDistinct("pickup_cluster").cast("int").alias("clusters"),
                                             F.min(F.col("pickup_cluster").between(0, CFG.zone_clusters - 1)).alias("in_range"))


@query("saved_model_difference", sql("SELECT 'forest' AS model, 0.0 AS largest_difference FROM city LIMIT 1", doubles=["largest_difference"]))
def _(spark, sf):
    """A model read back predicts what the fitted one does."""
    path, model, test = storage.fresh_path(spark, "model"), fitted(spark, sf, "forest"), prepared(spark, sf).test
    storage.save_model(model, path)
    both = (model.transform(test).select("row_key", "prediction")
            .join(storage.load_model(path).transform(test).select("row_key", F.col("prediction").alias("again")), "row_key"))
    return both.agg(F.lit("forest").alias("model"), F.max(F.abs(F.col("prediction") - F.col("again"))).alias("largest_difference"))


@query("importance_totals", sql("""SELECT model AS "Model", 100.0 AS total FROM (VALUES ('Linear Baseline'), ('Random Forest'), ('Boosted Trees')) AS m(model)
  WHERE EXISTS (SELECT 1 FROM city)""", doubles=["total"]))
def _(spark, sf):
    """The importances of every model sum to 100."""
    models = _three(spark, sf)
    linear = models.pop("Linear Baseline")
    table = training.explain(linear, models, prepared(spark, sf), CFG)["importances"]
    return table.groupBy("Model").agg(F.round(F.sum("Importance (%)"), 6).alias("total"))


@query("linear_coefficients", None)
def _(spark, sf):
    return E.coefficients(spark, fitted(spark, sf, "linear"), CFG)


@query("saved_model_predictions", None)
def _(spark, sf):
    path = storage.fresh_path(spark, "model")
    storage.save_model(fitted(spark, sf, "forest"), path)
    return storage.load_model(path).transform(prepared(spark, sf).test).select("row_key", "prediction")


@query("saved_parameters", None)
def _(spark, sf):
    path = storage.fresh_path(spark, "params")
    _, best, _ = T.random_search(E.random_forest(CFG, **FOREST), {"maxDepth": (2, 4)}, prepared(spark, sf).train, 2, T.mae(CFG), CFG)
    storage.save_params(spark, best, path)
    return spark.read.json(path)


@query("cross_validated_error", None)
def _(spark, sf):
    mape, mae = T.cv_scores(E.linear_model(CFG), prepared(spark, sf).train, [T.mape(CFG), T.mae(CFG)], CFG)
    return T.small_table(spark, [("mape", mape), ("mae", mae)], "metric string, value double")


@query("random_search", None)
def _(spark, sf):
    _, best, scored = T.random_search(E.random_forest(CFG, **FOREST), {"maxDepth": (2, 4), "minInstancesPerNode": (1, 5)},
                                      prepared(spark, sf).train, 3, T.mae(CFG), CFG)
    return T.small_table(spark, [(p["maxDepth"], p["minInstancesPerNode"], s, p == best) for p, s in scored],
                         "max_depth int, min_instances int, score double, best boolean")


@query("halving_search", None)
def _(spark, sf):
    _, best, history = T.halving_search(E.random_forest(CFG, **FOREST), {"maxDepth": (2, 4, 6), "minInstancesPerNode": (1, 5)},
                                        prepared(spark, sf).train, T.mae(CFG), CFG)
    return T.small_table(spark, [(r, n, p["maxDepth"], p["minInstancesPerNode"], s, p == best) for r, n, p, s in history],
                         "round int, sample_rows bigint, max_depth int, min_instances int, score double, best boolean")


@query("early_stopped_boosting", None)
def _(spark, sf):
    _, size, errors = T.early_stopped_boosting(E.boosted_trees(CFG, **BOOST), prepared(spark, sf).train, CFG, ceiling=12, patience=5)
    return T.small_table(spark, [(i + 1, e, i + 1 == size) for i, e in enumerate(errors)], "trees int, error double, chosen boolean")


@query("quick_model_comparison", None)
def _(spark, sf):
    models = {"Linear Baseline": (E.linear_model(CFG), {}), "Random Forest": (E.random_forest(CFG, **FOREST), {"maxDepth": (3, 5)}),
              "Boosted Trees": (E.boosted_trees(CFG, **{**BOOST, "maxIter": 4}), {"maxDepth": (2, 3)})}
    return T.quick_comparison(models, prepared(spark, sf).train, CFG, n=2)


def _three(spark, sf):
    return dict(zip(("Linear Baseline", "Random Forest", "Boosted Trees"), fitted(spark, sf, "linear", "forest", "boosted")))


@query("final_evaluation", None)
def _(spark, sf):
    return training.evaluate(_three(spark, sf), prepared(spark, sf).test, CFG)


@query("tree_importances", None)
def _(spark, sf):
    return I.native_importances(spark, fitted(spark, sf, "forest"), CFG, "Random Forest")


@query("tree_importances_secondary", None)
def _(spark, sf):
    return I.secondary_importances(I.native_importances(spark, fitted(spark, sf, "boosted"), CFG, "Boosted Trees"))


@query("linear_importances", None)
def _(spark, sf):
    return I.linear_importances(fitted(spark, sf, "linear"), prepared(spark, sf).test, CFG)


@query("combined_importances", None)
def _(spark, sf):
    models = _three(spark, sf)
    linear = models.pop("Linear Baseline")
    return training.explain(linear, models, prepared(spark, sf), CFG)["importances"]


@query("sufficient_features", None)
def _(spark, sf):
    models = _three(spark, sf)
    linear = models.pop("Linear Baseline")
    return training.explain(linear, models, prepared(spark, sf), CFG)["sufficient"]


@query("permutation_importance", None)
def _(spark, sf):
    return I.permutation_importance(fitted(spark, sf, "forest"), prepared(spark, sf).test, CFG.features, CFG)


@query("individual_curves", None)
def _(spark, sf):
    return I.individual_curves(fitted(spark, sf, "boosted"), prepared(spark, sf).test, "trip_distance")


@query("partial_dependence", None)
def _(spark, sf):
    return I.partial_dependence(I.individual_curves(fitted(spark, sf, "boosted"), prepared(spark, sf).test, "trip_distance"))


@query("sampled_attributions", None)
def _(spark, sf):
    return I.sampled_attributions(fitted(spark, sf, "boosted"), prepared(spark, sf).test, CFG.features, CFG, rows=100, permutations=10)


@query("learning_curve", None)
def _(spark, sf):
    return I.curve_summary(I.learning_curve({"Linear Baseline": E.linear_model(CFG)}, prepared(spark, sf).train, CFG))


# --- composite jobs -----------------------------------------------------------------------
def explored(spark, sf):
    return exploration.explore(trips(spark, sf), zones(spark, sf), check_holidays(spark), CFG)


@query("explore_stages", None)
def _(spark, sf):
    return exploration.statistics(explored(spark, sf))["funnel"]


@query("explore_figures", None)
def _(spark, sf):
    """Row counts of the data sets behind the figures."""
    tables = exploration.figures(explored(spark, sf))
    counts = [(name, t.count()) for name, t in tables.items()]
    return T.small_table(spark, counts, "figure string, n bigint")


@query("explore_screen", None)
def _(spark, sf):
    return exploration.screen(explored(spark, sf))["components"]


@query("train_and_evaluate", None)
def _(spark, sf):
    models = {"Linear Baseline": (E.linear_model(CFG), {})}
    tables, _ = training.train_and_evaluate(
        prepared(spark, sf), CFG, storage.fresh_path(spark, "trained"), models=models,
        forest_grid={"numTrees": (10,), "maxDepth": (3, 5)}, boost_grid={"maxDepth": (2, 3), "maxIter": (4,)},
        n=2, ceiling=6, patience=3)
    return tables["metrics"]


@query("model_diagnosis", None)
def _(spark, sf):
    tables = training.diagnose({"Random Forest": fitted(spark, sf, "forest")}, prepared(spark, sf), CFG)["Random Forest"]
    return tables["zone_summary"]


@query("model_worst_trips", None)
def _(spark, sf):
    from ride_analytics.operators.diagnostics import worst_predictions
    return worst_predictions(fitted(spark, sf, "forest").transform(prepared(spark, sf).test))


@query("drift_between_years", None)
def _(spark, sf):
    """Models of the trips of 1996 against those of 2000."""
    return drifted(spark, sf)["comparison"]


@query("drift_error_heatmap", None)
def _(spark, sf):
    return drifted(spark, sf)["Random Forest"]["error_heatmap"]


@query("drift_residual_trend", None)
def _(spark, sf):
    return drifted(spark, sf)["Random Forest"]["trend"]


def drifted(spark, sf):
    root = _prepared_root(spark.sparkContext.applicationId, sf)
    data = prepare.prepare(years(trips(spark, sf), 1996), zones(spark, sf), check_holidays(spark), CFG, root)
    models = E.fit_together({"Random Forest": MODELS["forest"](), "Boosted Trees": MODELS["boosted"]()}, data.train)
    baseline = drift.to_long(training.evaluate(models, data.test, CFG))
    later = drift.later_period(years(trips(spark, sf), 2000), zones(spark, sf), check_holidays(spark), data.tables, CFG)
    return drift.drift_test(later, models, baseline, CFG)

import numpy as np
import pytest
from pyspark.sql import functions as F

from ride_analytics.operators import isolation_forest as IF
from ride_analytics.sources.small import small_table


def test_planted_outliers_are_flagged(spark, known):
    model = IF.fit_outliers(known)
    out = model.transform(known).cache()
    share = out.where("`is outlier`").count() / out.count()
    assert abs(share - 0.01) < 0.002
    planted = out.where("trip_distance >= 60")
    assert planted.where("`is outlier`").count() / planted.count() > 0.95
    again = IF.fit_outliers(known.repartition(5)).transform(known)
    assert again.select("row_key", "outlier score").exceptAll(out.select("row_key", "outlier score")).count() == 0


def test_saved_forest_scores_alike(spark, known, tmp_path):
    model = IF.fit_outliers(known.limit(500), seed=1)
    model.save(spark, str(tmp_path / "f"))
    loaded = IF.IsolationForestModel.load(spark, str(tmp_path / "f"))
    a = model.transform(known).agg(F.sum("outlier score"), F.count_if("is outlier")).first()
    b = loaded.transform(known).agg(F.sum("outlier score"), F.count_if("is outlier")).first()
    assert a[0] == pytest.approx(b[0]) and a[1] == b[1]


def test_samples_have_exact_size_without_repeats(spark, known):
    for n, want in ((6000, 256), (100, 100)):
        s, used = IF.draw_samples(known.limit(n), ["fare_amount", "trip_distance"], "row_key", 20, 256, 42)
        assert used == want
        sizes = [r["count"] for r in s.groupBy("tree").count().collect()]
        assert sizes == [want] * 20
    unique = known.withColumn("fare_amount", F.monotonically_increasing_id().cast("double"))
    s, _ = IF.draw_samples(unique, ["fare_amount"], "row_key", 20, 256, 42)
    assert s.groupBy("tree", "fare_amount").count().where("count > 1").count() == 0


def test_scores_match_a_plain_walk(spark, known):
    model = IF.fit_outliers(known, seed=3)
    rows = known.limit(50).select("row_key", "fare_amount", "trip_distance")
    got = {r["row_key"]: r["outlier score"] for r in model.transform(rows).collect()}
    trees = {}
    for t, n, f, x, p in model.nodes.itertuples(index=False):
        trees.setdefault(t, {})[n] = (f, x, p)
    for r in rows.collect():
        point, paths = (r["fare_amount"], r["trip_distance"]), []
        for nodes in trees.values():
            at = 0
            while nodes[at][0] >= 0:
                at = 2 * at + (2 if point[nodes[at][0]] > nodes[at][1] else 1)
            paths.append(nodes[at][2])
        assert got[r["row_key"]] == pytest.approx(2 ** (-np.mean(paths) / IF.average_path(model.sample_size)))


def test_degenerate_inputs(spark):
    same = small_table(spark, [(str(i), 1.0, 1.0) for i in range(50)], "row_key string, fare_amount double, trip_distance double")
    assert IF.fit_outliers(same).transform(same).where("`is outlier`").count() == 0
    with pytest.raises(ValueError):
        IF.fit_outliers(same.where("false"))


def test_lookup_tables_score_as_the_walk(spark, known, monkeypatch):
    """F5 to F23: each row takes one look into every tree, with the very scores of the walk."""
    model = IF.fit_outliers(known, seed=3)
    cuts = model.nodes[model.nodes["feature"] == 0]["threshold"].tolist()[:200]
    odd = [None, float("nan"), float("inf"), -float("inf"), *cuts]
    rows = known.select("row_key", "fare_amount", "trip_distance").unionByName(
        small_table(spark, [(f"odd{i}", v, w) for i, v in enumerate(odd) for w in (None, 3.0)], "row_key string, fare_amount double, trip_distance double"))
    assert model._grids() is not None
    got = sorted((r[0], r[1]) for r in model.transform(rows).select("row_key", "outlier score").collect())
    monkeypatch.setattr(IF, "GRID_CELLS", 0)
    assert model._grids() is None
    assert got == sorted((r[0], r[1]) for r in model.transform(rows).select("row_key", "outlier score").collect())


def test_repeated_inputs_are_scored_once(spark, known):
    """F8 to F21: rows look up the scores of the different inputs, without Python; too many different ones are scored row by row."""
    odd = small_table(spark, [(f"o{i}", f, d) for i, (f, d) in enumerate([(None, 1.0), (float("nan"), 2.0), (5.0, None), (-0.0, 0.0), (0.0, 0.0)])],
                      "row_key string, fare_amount double, trip_distance double")
    few = known.select("row_key", F.round("fare_amount", -1).alias("fare_amount"), F.round("trip_distance", -1).alias("trip_distance")).unionByName(odd)
    few = few.unionByName(few.where("row_key < 's7-2'"))      # rows that repeat stay apart
    model = IF.fit_outliers(known)
    for most, python in ((1000, False), (3, True)):
        got = model.transform_repeated(few, most)
        want = model.transform(few)
        assert got.columns == want.columns
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
        assert ("ArrowEvalPython" in got._jdf.queryExecution().executedPlan().toString()) == python
    unlike = model.transform_repeated(known.limit(50))        # hardly fewer inputs than rows
    assert "ArrowEvalPython" in unlike._jdf.queryExecution().executedPlan().toString()

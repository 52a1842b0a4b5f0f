import datetime as dt

import pytest
from pyspark.sql import functions as F

from ride_analytics.config import Config
from ride_analytics.operators import feature_tables as FT
from ride_analytics.operators.zone_clusters import cluster_zones
from ride_analytics.sources.small import small_table

CFG = Config(zone_clusters=2, cluster_rounds=2)
DDL = ("row_key string, PULocationID int, DOLocationID int, hour int, fare_amount double, trip_distance double, "
       "tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, fold int")
T0 = dt.datetime(2025, 1, 1, 8)


def trip(i, pu, do, hour, fare, miles, minutes, fold=0):
    return (str(i), pu, do, hour, fare, miles, T0, T0 + dt.timedelta(minutes=minutes), fold)


@pytest.fixture(scope="module")
def train(spark):
    return small_table(spark, [
        trip(1, 1, 1, 8, 10.0, 5.0, 30), trip(2, 1, 1, 8, 20.0, 10.0, 30), trip(3, 1, 1, 8, 30.0, 5.0, 0),   # 10, 20, no speed
        trip(4, 1, 2, 8, 8.0, 3.0, 0),                                        # route with no speed at all
        trip(5, 2, 1, 9, 6.0, 400.0, 60, fold=1)], DDL)                       # capped at 100


@pytest.mark.parametrize("small", [True, False])
def test_fallback_chain(spark, train, tmp_path, monkeypatch, small):
    if not small:
        monkeypatch.setattr(FT, "GROUP_ROWS", 1)
    tables = FT.fit_feature_tables(train, CFG, str(tmp_path / "t"))
    new = small_table(spark, [trip("a", 1, 1, 8, 0.0, 1.0, 1), trip("b", 1, 2, 8, 0.0, 1.0, 1), trip("c", 2, 2, 9, 0.0, 1.0, 1),
                              trip("d", 9, 9, 3, 0.0, 1.0, 1)], DDL)
    got = {r["row_key"]: r for r in FT.apply_feature_tables(new, tables).collect()}
    assert got["a"]["route_avg_speed"] == 15.0 and got["a"]["route_popularity"] == 2
    assert got["b"]["route_avg_speed"] == 15.0 and got["b"]["route_popularity"] == 0     # known route, no speed: zone and hour
    assert got["c"]["route_avg_speed"] == 100.0 and got["c"]["route_popularity"] == 0
    assert got["d"]["route_avg_speed"] == 20.0                                           # global median of 10, 20, 100
    assert got["a"]["PU_fare_avg"] == 17.0 and got["b"]["DO_fare_avg"] == 8.0
    assert got["d"]["PU_fare_avg"] == got["d"]["DO_fare_avg"] == pytest.approx(74 / 5)   # unseen: global mean
    assert got["d"]["pickup_cluster"] == -1 and got["a"]["pickup_cluster"] in (0, 1)
    again = FT.FeatureTables.load(spark, str(tmp_path / "t"))
    assert again.route_stats.count() == 3


def test_separate_tables_agree_with_one_pass(train):
    learned = FT.learn_tables(train, CFG)
    for name, table in (("route_stats", FT.route_stats(train)), ("zone_hour_speed", FT.zone_hour_speed(train))):
        assert table.exceptAll(learned[name].select(table.columns)).count() == 0
    assert FT.global_speed(train).first()[0] == learned["globals"].first()["median_speed"] == 20.0
    assert FT.route_stats(train, approx=True).where("PULocationID = 2").first()["route_avg_speed"] == 100.0


def test_out_of_fold_encoding(train):
    got = {r["row_key"]: r["f"] for r in FT.out_of_fold_zone_fares(train, "PULocationID", "f").collect()}
    assert got["5"] == 17.0          # its zone has no other fold: mean of the other folds
    assert got["1"] == 6.0


def test_clusters_are_ordered_and_complete(spark):
    profile = small_table(spark, [(i, float(10 * (i % 3) + 1), float(i % 3)) for i in range(12)],
                          "PULocationID int, mean_fare double, mean_distance double")
    got = cluster_zones(profile, 3, 3).groupBy("pickup_cluster").agg(F.min("mean_fare").alias("a"), F.max("mean_fare").alias("b"),
                                                                     F.count("*").alias("n")).orderBy("pickup_cluster").collect()
    assert [tuple(r) for r in got] == [(0, 1.0, 1.0, 4), (1, 11.0, 11.0, 4), (2, 21.0, 21.0, 4)]
    assert cluster_zones(profile.limit(1), 15, 1).first()["pickup_cluster"] == 0
    assert cluster_zones(profile.where("false"), 15, 1).count() == 0
    assert cluster_zones(profile.where("PULocationID < 2"), 15, 1).count() == 2


def test_large_lookups_are_not_broadcast(train):
    from ride_analytics.operators.joins import bounded
    assert "broadcast" in bounded(train)._jdf.queryExecution().logical().toString().lower()
    assert "broadcast" not in bounded(train, 2)._jdf.queryExecution().logical().toString().lower()


def test_lookups_do_not_shuffle_trips(spark, train, tmp_path):
    tables = FT.fit_feature_tables(train, CFG, str(tmp_path / "p"))
    train.write.parquet(str(tmp_path / "trips"))
    out = FT.apply_feature_tables(spark.read.parquet(str(tmp_path / "trips")), tables)
    text = out._jdf.queryExecution().executedPlan().toString()
    assert text.count("BroadcastHashJoin") == 5 and "Exchange hashpartitioning" not in text


def test_zone_hours_take_one_shuffle(spark, train, monkeypatch):
    """F6 to F22: groups of a counted size have their medians without rounds; NaN does not count."""
    odd = train.unionByName(small_table(spark, [trip(6, 1, 1, 8, 1.0, float("nan"), 30)], DDL))
    monkeypatch.setattr(FT, "GROUP_ROWS", 1)
    rounds = {tuple(r) for r in FT.zone_hour_speed(odd).collect()}
    monkeypatch.undo()
    monkeypatch.setattr(FT, "grouped_median", lambda *a, **kw: pytest.fail("narrowed down in rounds"))
    assert {tuple(r) for r in FT.zone_hour_speed(odd).collect()} == rounds == {(1, 8, 20.0), (2, 9, 100.0)}

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ride_analytics.config import KEEP_COLUMNS, Config
from ride_analytics.operators import cleaning as C
from ride_analytics.sources import trips as T
from ride_analytics.sources.small import small_table

HOME = Config(home_borough="Home")
GOOD = dict(row_key="k", VendorID=1, tpep_pickup_datetime=dt.datetime(2025, 1, 1, 17, 30),
            tpep_dropoff_datetime=dt.datetime(2025, 1, 1, 17, 45), passenger_count=1.0, trip_distance=2.0, RatecodeID=1.0,
            PULocationID=1, DOLocationID=2, fare_amount=12.5, extra=0.0, mta_tax=0.5, improvement_surcharge=1.0,
            congestion_surcharge=2.5, cbd_congestion_fee=0.0)
SCHEMA = "row_key string, " + ", ".join(f"{n} {t.simpleString()}" for n, t in T.TRIP_TYPES.items())


def table(spark, *changes):
    return small_table(spark, [tuple({**GOOD, **c}.values()) for c in changes], SCHEMA)


def test_row_rules(spark, known_zones, known_holidays):
    changes = [
        ({}, True), ({"fare_amount": 50.0}, True), ({"fare_amount": 50.01}, False), ({"fare_amount": 0.0}, False),
        ({"fare_amount": float("nan")}, False), ({"passenger_count": None}, False), ({"passenger_count": 0.0}, False),
        ({"passenger_count": 6.0}, True), ({"passenger_count": 7.0}, False), ({"trip_distance": 0.0}, False),
        ({"trip_distance": float("nan")}, False), ({"extra": -0.5}, False), ({"cbd_congestion_fee": None}, False),
        ({"RatecodeID": 2.0}, False), ({"PULocationID": 18}, False), ({"DOLocationID": 19}, False), ({"DOLocationID": 999}, False)]
    df = table(spark, *[{**c, "row_key": str(i)} for i, (c, _) in enumerate(changes)])
    got = {r["row_key"] for r in C.clean_trips(df, known_zones, known_holidays, HOME).collect()}
    assert got == {str(i) for i, (_, keep) in enumerate(changes) if keep}


def test_derived_columns(spark, known_zones, known_holidays):
    row = C.clean_trips(table(spark, {}), known_zones, known_holidays, HOME).first()
    # 1 January 2025 is a Wednesday and, listed twice, still one row.
    assert (row["hour"], row["day of week"], row["is weekend"], row["is_night_fare"], row["is_rush_hour"], row["is_holiday"]) == (17, 2, 0, 0, 1, 1)
    assert row["PU_Boro"] == row["DO_Boro"] == "Home"
    assert C.clean_trips(table(spark, {}), known_zones, known_holidays, HOME).count() == 1


def test_funnel_equals_separate_counts(spark, known_zones, known_holidays):
    df = table(spark, {}, {"fare_amount": 99.0}, {"PULocationID": 18}, {"passenger_count": None}).withColumn("is outlier", F.lit(True))
    got = {r["step"]: r["n"] for r in C.row_funnel(df, known_zones, HOME, "is outlier").collect()}
    assert got == {"raw": 4, "integrity": 2, "borough": 1, "outliers removed": 0}


def test_required_columns(spark):
    df = table(spark, {}).drop("cbd_congestion_fee")
    with pytest.raises(ValueError, match="cbd_congestion_fee"):
        T.keep_required(df, Config())
    loose = Config(optional_fees=("cbd_congestion_fee",))
    assert "cbd_congestion_fee" not in T.keep_required(df, loose).columns
    assert C.integrity_filter(df, loose).count() == 1


def test_zone_names_fall_back_to_id(spark, known_zones):
    counts = small_table(spark, [(1, 5), (18, 2), (77, 1)], "PULocationID int, trip_count bigint")
    got = {r["PULocationID"]: r["Zone"] for r in C.zone_names(counts, known_zones, "Home").collect()}
    assert got == {1: "Zone 1", 18: "18", 77: "77"}


def test_sources(spark, tmp_path):
    path = str(tmp_path / "trips")
    df = table(spark, {}, {"tpep_pickup_datetime": dt.datetime(2025, 7, 1)}, {"tpep_pickup_datetime": dt.datetime(2025, 6, 30, 23, 59)})
    df.write.parquet(path)
    assert T.load_trips(spark, path, ["2025-07"]).count() == 1
    assert T.load_trips(spark, path).columns == ["row_key", *KEEP_COLUMNS]
    df.withColumn("pickup_month", F.date_format("tpep_pickup_datetime", "yyyy-MM")).write.partitionBy("pickup_month").parquet(path + "-m")
    by_month = T.load_trips(spark, path + "-m", ["2025-06", "2025-07"])
    assert by_month.count() == 2
    text = by_month._jdf.queryExecution().executedPlan().toString()
    assert "pickup_month" in text.split("PartitionFilters: [")[1].split("]")[0]
    df.drop("row_key").write.parquet(path + "-k")
    keyed = T.load_trips(spark, path + "-k")
    assert keyed.select("row_key").distinct().count() == 3
    assert keyed.exceptAll(T.load_trips(spark, path + "-k").repartition(3)).count() == 0
    assert T.other_month_path("a/2025-01.parquet", "2025-01", "2025-07") == "a/2025-07.parquet"
    with pytest.raises(ValueError):
        T.other_month_path("a/b.parquet", "2025-01", "2025-07")
    (tmp_path / "zones.csv").write_text('"LocationID","Borough","Zone","service_zone"\n1,"Home","A","x"\n')
    assert T.load_zones(spark, str(tmp_path / "zones.csv")).collect() == [(1, "Home", "A")]


def test_filters_reach_the_scan(spark, tmp_path, known_zones, known_holidays):
    path = str(tmp_path / "t")
    table(spark, {}).withColumn("unused", F.lit(1)).write.parquet(path)
    plan = C.clean_trips(T.load_trips(spark, path), known_zones, known_holidays, HOME).select("fare_amount", "hour", "is_holiday")
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    text = plan._sc._jvm.PythonSQLUtils.explainString(plan._jdf.queryExecution(), "formatted")
    pushed = text.split("PushedFilters: [")[1].split("\n")[0]
    assert "GreaterThan(fare_amount,0.0)" in pushed and "LessThanOrEqual(fare_amount,50.0)" in pushed
    assert "EqualTo(RatecodeID,1.0)" in pushed
    schema = text.split("ReadSchema: ")[1].split("\n")[0]
    assert "unused" not in schema and "row_key" not in schema
    # Zones and holidays are broadcast: the trips are joined where they are read.
    tree = plan._jdf.queryExecution().executedPlan().toString()
    assert tree.count("BroadcastHashJoin") == 3 and "SortMergeJoin" not in tree
    # A column nobody asks for costs no join.
    fewer = plan.select("fare_amount")._jdf.queryExecution().executedPlan().toString()
    assert fewer.count("BroadcastHashJoin") == 2

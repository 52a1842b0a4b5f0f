import datetime as dt

import pytest
from pyspark.sql import functions as F

from ride_analytics.config import Config
from ride_analytics.functions import columns as X
from ride_analytics.functions.bins import DISTANCE_BINS, FARE_CLASSES, FARE_ERROR_BINS, SUPPORT_GROUPS, BinSpec
from ride_analytics.sources.small import small_table


def one(spark, values, ddl, expr):
    return [r[0] for r in small_table(spark, [(v,) for v in values], f"x {ddl}").select(expr).collect()]


def test_bins_are_right_closed(spark):
    values = [0.0, 0.01, 15.0, 15.01, 25.0, 40.0, 50.0, 51.0, 51.01, -1.0, None, float("nan")]
    want = [None, "L", "L", "M", "M", "H", "P", "P", None, None, None, None]
    assert one(spark, values, "double", FARE_CLASSES.label(F.col("x"))) == want
    assert one(spark, [15.0, 15.01], "double", FARE_CLASSES.ordinal(F.col("x"))) == [0, 1]


def test_open_and_left_closed_bins(spark):
    assert one(spark, [60.0, 60.5, 1e9, float("nan")], "double", FARE_ERROR_BINS.label(F.col("x"))) == ["40-60", "60+", "60+", None]
    assert one(spark, [199, 200, 5000, 0], "bigint", SUPPORT_GROUPS.label(F.col("x"))) == ["0-200", "200-500", "5000+", "0-200"]
    assert [r["bin_order"] for r in DISTANCE_BINS.table(spark).orderBy("bin_order").collect()] == list(range(6))
    with pytest.raises(ValueError):
        BinSpec((0, 1), ("a", "b"))


def test_time_flags(spark):
    hours = [0, 5, 6, 15, 16, 19, 20, 23]
    assert one(spark, hours, "int", X.is_night(F.col("x"))) == [1, 1, 0, 0, 0, 0, 1, 1]
    assert one(spark, hours, "int", X.is_rush(F.col("x"), F.lit(4))) == [0, 0, 0, 0, 1, 1, 0, 0]
    assert one(spark, hours, "int", X.is_rush(F.col("x"), F.lit(5))) == [0] * 8
    days = [dt.datetime(2025, 1, 5, 23), dt.datetime(2025, 1, 6, 0), dt.datetime(2025, 1, 11)]   # Sun, Mon, Sat
    assert one(spark, days, "timestamp_ntz", X.day_of_week(F.col("x"))) == [6, 0, 5]
    assert one(spark, [4, 5, 6], "int", X.is_weekend(F.col("x"))) == [0, 1, 1]
    assert one(spark, [0, 6], "int", X.weekday_name(F.col("x"))) == ["Mon", "Sun"]
    assert one(spark, [0, 1, None], "int", X.day_type(F.col("x"))) == ["Weekday", "Weekend", None]


def test_duration_keeps_fractions_and_sign(spark):
    a = dt.datetime(2025, 1, 1, 10, 0, 0)
    rows = [(a, a + dt.timedelta(seconds=1.5)), (a, a), (a, a - dt.timedelta(minutes=2))]
    df = small_table(spark, rows, "s timestamp_ntz, e timestamp_ntz")
    assert [r[0] for r in df.select(X.duration_minutes("s", "e")).collect()] == [0.025, 0.0, -2.0]


def test_speed_rules(spark):
    df = small_table(spark, [(5.0, 0.5), (5.0, 0.0), (5.0, -0.5), (500.0, 1.0), (None, 1.0), (5.0, None)], "d double, h double")
    got = [r[0] for r in df.select(X.speed_mph(F.col("d"), F.col("h"))).collect()]
    assert got == [10.0, None, -10.0, 100.0, None, None]


def test_clip_keeps_null(spark):
    assert one(spark, [-1.0, 5.0, 20.0, None], "double", X.clip(F.col("x"), 0.0, 10.0)) == [0.0, 5.0, 10.0, None]


def test_cyclic_and_errors(spark):
    s, c = X.cyclic(F.col("x"), 24)
    assert one(spark, [6], "int", s)[0] == pytest.approx(1.0)
    assert one(spark, [12], "int", c)[0] == pytest.approx(-1.0)
    df = small_table(spark, [(10.0, 12.0), (0.0, 1.0)], "y double, p double")
    got = df.select(X.residual("y", "p"), X.absolute_error("y", "p"), X.percentage_error("y", "p")).collect()
    assert got[0][:3] == (-2.0, 2.0, 0.2)
    assert got[1][2] == 1.0 / X.TINY


def test_view_cap(spark):
    assert one(spark, [41.2, 45.0, 230.0], "double", X.view_cap(F.col("x"))) == [45.0, 45.0, 100.0]


def test_modes_and_key():
    assert len(Config(feature_mode="FULL").features) == 13
    assert len(Config(feature_mode="XGB_95").features) == 10
    assert len(Config(feature_mode="RF_95").features) == 3
    with pytest.raises(ValueError):
        Config(feature_mode="other")
    assert Config().key() != Config(balance=False).key() == Config(balance=False).key()

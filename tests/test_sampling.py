import numpy as np
import pytest
from pyspark.sql import functions as F

from ride_analytics.functions.bins import FARE_CLASSES
from ride_analytics.operators import sampling as S


@pytest.fixture(scope="module")
def rows(spark):
    """Nine tenths of the rows in one class."""
    df = spark.range(8000).select(F.concat(F.lit("k"), "id").alias("row_key"),
                                  F.when(F.col("id") % 10 < 9, 10.0).when(F.col("id") % 20 == 9, 20.0)
                                   .otherwise(F.when(F.col("id") % 40 == 19, 30.0).otherwise(45.0)).alias("fare_amount"),
                                  (F.col("id") % 50 + 1).cast("double").alias("trip_distance"))
    return df.cache()


def keys(df):
    return {r["row_key"] for r in df.select("row_key").collect()}


def test_splits_are_disjoint_stable_and_sized(rows):
    a = S.with_test_flag(rows)
    b = S.with_test_flag(rows.repartition(13))
    test = keys(a.where("is_test"))
    assert test == keys(b.where("is_test"))
    assert test.isdisjoint(keys(a.where("not is_test")))
    assert abs(len(test) / 8000 - 0.2) < 0.02
    folds = {r["fold"]: r["count"] for r in S.with_fold(rows).groupBy("fold").count().collect()}
    assert sorted(folds) == [0, 1, 2, 3, 4] and min(folds.values()) > 1400
    val = keys(S.with_holdout_flag(rows).where("is_val"))
    assert abs(len(val) / 8000 - 0.15) < 0.02 and len(val & test) < len(val)


@pytest.mark.parametrize("n", [0, 1, 37, 500, 7999, 8000, 9000])
def test_exact_sample(rows, n):
    got = keys(S.sample_rows(rows, n)) if n else set()
    assert len(got) == min(n, 8000)
    if n:
        assert got == keys(S.sample_rows(rows.repartition(5), n))
        assert got <= keys(S.sample_rows(rows, n + 100))


def test_exact_sample_per_group(rows):
    got = S.first_n_by_hash(rows, 300, ["fare_amount"]).groupBy("fare_amount").count().collect()
    assert {r[0]: r[1] for r in got} == {10.0: 300, 20.0: 300, 30.0: 200, 45.0: 200}


def test_nested_levels(rows):
    df = S.with_prefix_level(rows, [0.1, 0.5, 0.9])
    n = {r["level"]: r["count"] for r in df.groupBy("level").count().collect()}
    assert set(n) == {0, 1, 2, None}
    assert abs((n[0] + n[1]) / 8000 - 0.5) < 0.03


def test_balancing(rows):
    out = S.balance_classes(rows, 400).withColumn("c", FARE_CLASSES.label(F.col("fare_amount"))).cache()
    sizes = {r["c"]: r["count"] for r in out.groupBy("c").count().collect()}
    assert sizes == {"L": 400, "M": 400, "H": 400, "P": 400}
    assert keys(out) <= keys(rows)
    kept = out.where("copy = 0")
    assert kept.select("c").distinct().count() == 2 and kept.count() == len(keys(kept)) == 800
    drawn = out.where("copy > 0").join(rows.select("row_key", F.col("trip_distance").alias("d0"), F.col("fare_amount").alias("f0")), "row_key")
    assert drawn.where("fare_amount <> f0").count() == 0
    diff = np.array([r[0] for r in drawn.select(F.col("trip_distance") - F.col("d0")).collect()])
    sd = rows.where("fare_amount = 30").agg(F.stddev_samp("trip_distance")).first()[0]
    assert 0.5 * 0.01 * sd < diff.std() < 2 * 0.01 * sd
    low = out.groupBy("c").agg(F.min("trip_distance").alias("m")).join(
        rows.withColumn("c", FARE_CLASSES.label(F.col("fare_amount"))).groupBy("c").agg(F.min("trip_distance").alias("m0")), "c")
    assert low.where("m < m0").count() == 0
    assert S.balance_classes(rows.where("fare_amount < 25"), 100).count() == 200      # empty classes are left out
    again = S.balance_classes(rows.repartition(9), 400)      # the deviation's last bits depend on row order
    near = lambda df: df.select("row_key", "copy", F.round("trip_distance", 9))
    assert near(again).exceptAll(near(out)).count() == 0


def test_gaussian_column(spark):
    x = np.array([r[0] for r in spark.range(20000).select(S.gaussian(F.col("id"), "t")).collect()])
    assert abs(x.mean()) < 0.03 and abs(x.std() - 1) < 0.03


def test_paired_outlier_sample(rows):
    flagged = rows.withColumn("is outlier", F.col("fare_amount") > 40)
    got = {r[0]: r[1] for r in S.paired_outlier_sample(flagged, 1000).groupBy("is outlier").count().collect()}
    assert got == {False: 1000, True: 10}
    got = {r[0]: r[1] for r in S.paired_outlier_sample(flagged, 50).groupBy("is outlier").count().collect()}
    assert got == {False: 50, True: 1}


def test_shuffle_keeps_rows(rows):
    out = [r["row_key"] for r in S.shuffle_rows(rows).collect()]
    assert len(out) == 8000 and out != sorted(out) and set(out) == keys(rows)


def test_sample_of_a_large_table_hashes_its_rows_once(spark, rows, monkeypatch):
    """F8 to F21: the number of rows tells the bound; only rows below it are sorted. Where keys repeat and too few are, bit lengths are counted."""
    ordered = rows.orderBy(S.hash_number(F.col("row_key"), "x"), "row_key")
    want = [r["row_key"] for r in ordered.limit(100).collect()]
    lengths, real = [], F.bin
    monkeypatch.setattr(F, "bin", lambda c: (lengths.append(c), real(c))[1])
    got = S.first_n_by_hash(rows, 100, salt="x")
    assert [r["row_key"] for r in got.collect()] == want and got.columns == rows.columns
    high = rows.withColumn("_g", S.hash_number(F.col("row_key"), "x")).where("_g > 3000000000").drop("_g")     # hashes not uniform
    assert S.first_n_by_hash(high, 100, salt="x").count() == 100
    assert len(lengths) == 2

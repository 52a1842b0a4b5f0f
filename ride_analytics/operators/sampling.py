"""Splits, samples and class balancing that depend on row keys only.

Every choice is a function of a hash of the row key, so it is the same after a
repartition, a retry or a lost executor.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ride_analytics.functions.bins import FARE_CLASSES, BinSpec
from ride_analytics.operators.joins import bounded, null_safe_join
from ride_analytics.sources.small import small_table
from ride_analytics.sources.storage import cut

KEY = "row_key"


def hash_number(key: Column, salt: str = "") -> Column:
    """Uniform integer below 2**32: the first eight hex digits of an MD5."""
    text = key.cast("string") if not salt else F.concat(F.lit(salt + ":"), key.cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def hash_percent(key: Column, salt: str = "") -> Column:
    return hash_number(key, salt) % 100


def with_test_flag(df: DataFrame, percent: int = 20, key: str = KEY, name: str = "is_test") -> DataFrame:
    return df.withColumn(name, hash_percent(F.col(key)) < percent)


def with_holdout_flag(df: DataFrame, percent: int = 15, key: str = KEY, name: str = "is_val") -> DataFrame:
    return df.withColumn(name, hash_percent(F.col(key), "holdout") < percent)


def with_fold(df: DataFrame, folds: int = 5, key: str | Column = KEY, name: str = "fold") -> DataFrame:
    k = F.col(key) if isinstance(key, str) else key
    return df.withColumn(name, (hash_number(k, "fold") % folds).cast("int"))


def first_n_by_hash(df: DataFrame, n: int, groups: Sequence[str] = (), key: str = KEY,
                    salt: str = "") -> DataFrame:
    """Exactly ``min(n, size)`` rows per group: those with the smallest hashes.

    Counting rows by bit length of the hash finds the power of two below which
    at least ``n`` rows of a group lie. Only those (about 2n at most) are
    sorted, so a group of any size costs two scans and no large sort. Without
    groups, the number of rows tells the bound, and one scan hashes them.
    """
    groups = list(groups)
    hashed = (df.withColumn("_h", hash_number(F.col(key), salt))
                .withColumn("_bits", F.length(F.bin("_h"))))
    sizes = hashed.groupBy(*groups, "_bits").agg(F.count(F.lit(1)).alias("_n"))   # at most 32 per group
    upto = F.sum("_n").over(Window.partitionBy(*groups).orderBy("_bits").rowsBetween(Window.unboundedPreceding, 0))
    enough = (sizes.withColumn("_upto", upto).groupBy(*groups)
                   .agg(F.coalesce(F.min(F.when(F.col("_upto") >= n, F.col("_bits"))), F.lit(32)).alias("_limit")))
    if not groups:
        rows = df.count()
        if rows > 4 * n:
            # hashes are uniform: below this bound lie n rows and a margin; a count tells if they do
            few = cut(df.withColumn("_h", hash_number(F.col(key), salt)).where(F.col("_h") < int(2 ** 32 * (n + 8 * math.sqrt(n) + 16) / rows)))
            if few.count() >= n:
                return few.orderBy("_h", key).limit(n).drop("_h")
        few = hashed.where(F.col("_bits") <= enough.select("_limit").scalar())
        return few.orderBy("_h", key).limit(n).drop("_h", "_bits")
    few = null_safe_join(hashed, bounded(cut(enough)), groups).where(F.col("_bits") <= F.col("_limit"))
    rank = F.row_number().over(Window.partitionBy(*groups).orderBy("_h", key))
    return few.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_h", "_bits", "_limit", "_rank")


def sample_rows(df: DataFrame, n: int, key: str = KEY, salt: str = "") -> DataFrame:
    return first_n_by_hash(df, n, key=key, salt=salt)


def paired_outlier_sample(df: DataFrame, n: int, flag: str = "is outlier", key: str = KEY) -> DataFrame:
    """``min(n, inliers)`` inliers and one hundredth as many outliers, at least one."""
    inliers = df.where(~F.col(flag))
    n_in = min(n, inliers.count())
    n_out = max(1, int(n_in * 0.01))
    return sample_rows(inliers, n_in, key).unionByName(sample_rows(df.where(F.col(flag)), n_out, key))


def with_prefix_level(df: DataFrame, fractions: Sequence[float], key: str = KEY, salt: str = "curve",
                      name: str = "level") -> DataFrame:
    """Number of the smallest nested sample holding the row; levels 0..i together
    make sample i. Null beyond the largest fraction."""
    u = hash_number(F.col(key), salt) / F.lit(float(2 ** 32))
    expr = F.lit(None).cast("int")
    for i, f in reversed(list(enumerate(fractions))):
        expr = F.when(u < f, F.lit(i)).otherwise(expr)
    return df.withColumn(name, expr)


def shuffle_rows(df: DataFrame, key: str = KEY, salt: str = "shuffle") -> DataFrame:
    return df.orderBy(hash_number(F.col(key), salt), key)


def gaussian(key: Column, salt: str) -> Column:
    """Standard normal number as a function of a key (Box-Muller)."""
    u = (hash_number(key, salt + "-u") + 1) / F.lit(float(2 ** 32))
    v = hash_number(key, salt + "-v") / F.lit(float(2 ** 32))
    return F.sqrt(F.lit(-2.0) * F.ln(u)) * F.cos(F.lit(2.0 * math.pi) * v)


def balance_classes(df: DataFrame, target: int = 30_000, spec: BinSpec = FARE_CLASSES, by: str = "fare_amount",
                    jitter: Sequence[str] = ("trip_distance",), jitter_share: float = 0.01,
                    key: str = KEY, seed: int = 42) -> DataFrame:
    """Exactly ``target`` rows of every non-empty class of ``by``.

    A class with enough rows gives its first ``target`` by hash. A smaller one
    is drawn from with replacement: its rows (fewer than ``target``) are
    numbered, ``target`` positions are drawn and joined on class and position,
    which spreads evenly. Drawn rows get Gaussian noise of ``jitter_share`` of
    the class deviation on the ``jitter`` columns, not below the class minimum.
    Column ``copy`` is 0 for original rows and the draw number for drawn ones.
    """
    cols = [F.col(f"`{c}`") for c in df.columns]
    binned = df.withColumn("_class", spec.label(F.col(by)))
    # One row per class of `spec`.
    stats = binned.where(F.col("_class").isNotNull()).groupBy("_class").agg(
        F.count(F.lit(1)).alias("size"),
        *[F.struct(F.stddev_samp(c).alias("sd"), F.min(c).alias("low")).alias(f"of_{c}") for c in jitter]).collect()
    salt, parts = f"balance{seed}", []
    large = [r["_class"] for r in stats if r["size"] >= target]
    if large:
        kept = first_n_by_hash(binned.where(F.col("_class").isin(large)), target, ["_class"], key, salt)
        parts.append(kept.select(*cols, F.lit(0).cast("bigint").alias("copy")))
    small = [r for r in stats if r["size"] < target]
    if small:
        order = Window.partitionBy("_class").orderBy(hash_number(F.col(key), salt), key)
        numbered = (binned.where(F.col("_class").isin([r["_class"] for r in small]))
                          .withColumn("_pos", F.row_number().over(order)))
        sizes = small_table(df.sparkSession, [(r["_class"], r["size"]) for r in small], "_class string, _size bigint")
        draws = (sizes.select("_class", "_size", F.explode(F.sequence(F.lit(1), F.lit(target))).alias("copy"))
                      .withColumn("_draw", F.concat_ws("-", F.col("_class"), F.col("copy")))
                      .withColumn("_pos", (hash_number(F.col("_draw"), f"draw{seed}") % F.col("_size") + 1).cast("int"))
                      .select("_class", "_pos", "_draw", F.col("copy").cast("bigint").alias("copy")))
        drawn = numbered.join(draws, ["_class", "_pos"])
        for c in jitter:
            noise = gaussian(F.concat_ws("-", F.col("_draw"), F.lit(c)), f"noise{seed}")
            sd, low = F.lit(0.0), F.lit(None).cast("double")
            for r in small:
                mine = F.col("_class") == r["_class"]
                sd = F.when(mine, F.lit(r[f"of_{c}"]["sd"] or 0.0)).otherwise(sd)
                low = F.when(mine, F.lit(r[f"of_{c}"]["low"])).otherwise(low)
            drawn = drawn.withColumn(c, F.greatest(F.col(f"`{c}`") + noise * sd * jitter_share, low))
        parts.append(drawn.select(*cols, "copy"))
    if not parts:
        return df.withColumn("copy", F.lit(0).cast("bigint")).limit(0)
    return reduce(DataFrame.unionByName, parts)

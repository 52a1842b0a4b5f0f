"""Exact quantiles per group without gathering a group in one task.

Spark's own ``percentile`` holds every distinct value of a group in the memory
of one task, which is right for small inputs only. Beyond a checked size the
wanted ranks are narrowed down instead: a sketch cuts the values into ranges,
rows are counted per group and range, and only the ranges that hold a wanted
rank go on. Each round leaves about ``1 / RANGES`` of the rows, whatever the
share of the largest group, and shuffles only counts; what remains is sorted.

The source, with its joins and rules, is evaluated once: keys and value are
written, two narrow columns, and counts, edges and all rounds read those.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ride_analytics.operators.joins import bounded, null_safe_join
from ride_analytics.sources.storage import cut, written

RANGES = 1024
SMALL_ROWS = 2_000_000
EDGE_ROWS = 500_000
MAX_ROUNDS = 3
APPROX_ACCURACY = 100_000


def small_enough(df: DataFrame, rows: int = SMALL_ROWS) -> bool:
    """Whether a (checkpointed) table has at most ``rows`` rows."""
    return df.limit(rows + 1).count() <= rows


def _edges(values: DataFrame, size: int, ranges: int) -> list[float]:
    """Values that cut the rows into about equal ranges, from a sample of a
    bounded number of rows: counts decide on ranks, edges only on the balance."""
    probs = [i / ranges for i in range(1, ranges)]
    part = values.sample(min(1.0, EDGE_ROWS / max(1, size)), 7) if size > EDGE_ROWS else values
    row = part.agg(F.percentile_approx("_v", probs, 10 * ranges).alias("edges")).first()
    return sorted(set(row["edges"] or []))


def grouped_quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: dict[str, float],
                      weight: str | None = None, approx: bool = False,
                      small_rows: int = SMALL_ROWS, ranges: int = RANGES, stored: bool = False) -> DataFrame:
    """Quantiles of ``value`` per group, by linear interpolation.

    ``probs`` maps output names to probabilities. Nulls and NaN do not count;
    groups without any value are absent. ``weight`` names a column of row
    counts. ``approx`` gives Spark's mergeable sketch in one pass. ``stored``
    says that ``df`` is a written table already, which is not written again.
    """
    keys, v = list(keys), F.col(value).cast("double")
    n = F.lit(1).cast("bigint") if weight is None else F.col(weight).cast("bigint")
    values = (df.select(*[F.col(f"`{k}`") for k in keys], v.alias("_v"), n.alias("_n"))
                .where(F.col("_v").isNotNull() & ~F.isnan("_v")))
    named = [F.col("_q")[i].alias(name) for i, name in enumerate(probs)]
    listed = [float(p) for p in probs.values()]
    if approx and weight is not None:
        raise ValueError("the sketch takes no weights")
    if approx:
        q = values.groupBy(*keys).agg(F.percentile_approx("_v", listed, APPROX_ACCURACY).alias("_q"))
        return q.where(F.col("_q").isNotNull()).select(*keys, *named)
    values = values if stored else written(values, "quantile-values")
    size = values.count()
    if size <= small_rows:
        q = values.groupBy(*keys).agg(F.percentile("_v", F.array(*[F.lit(p) for p in listed]), F.col("_n")).alias("_q"))
        return q.where(F.col("_q").isNotNull()).select(*keys, *named)

    edges = _edges(values, size, ranges)
    if not keys:
        whole = _ranked(values.withColumn("_all", F.lit(0)), ["_all"], probs, edges, small_rows, ranges)
        return whole.drop("_all")
    return _ranked(values, keys, probs, edges, small_rows, ranges)


def _ranked(values: DataFrame, keys: list[str], probs: dict[str, float], edges: list[float], small_rows: int,
            ranges: int) -> DataFrame:
    """The path for large inputs."""
    listed = [float(p) for p in probs.values()]
    sums = _range_sums(values, keys, edges, MAX_ROUNDS)
    sizes = sums.groupBy(*keys).agg(F.sum("_n").alias("_total"))
    wanted = F.array(*[F.struct(F.lit(i).alias("id"), rank.alias("rank"))
                       for i, p in enumerate(listed)
                       for rank in (F.floor(F.lit(p) * (F.col("_total") - 1)), F.ceil(F.lit(p) * (F.col("_total") - 1)))])
    ranks = sizes.select(*keys, "_total", F.explode(F.array_distinct(wanted)).alias("w")).select(
        *keys, "_total", F.col("w.id").alias("_id"), F.col("w.rank").alias("_rank"), F.col("w.rank").alias("_left"))
    found = _values_at(values, keys, keys, cut(ranks), edges, sums, small_rows, ranges, MAX_ROUNDS)
    out = []
    for i, (name, p) in enumerate(zip(probs, listed)):
        mine = F.col("_id") == i
        lo, hi = F.min(F.when(mine, F.col("_v"))), F.max(F.when(mine, F.col("_v")))
        at = F.lit(p) * (F.max("_total") - 1)
        out.append((lo + (hi - lo) * (at - F.floor(at))).alias(name))
    return found.groupBy(*keys).agg(*out)


def _in_ranges(values: DataFrame, edges: list[float], mark: str) -> DataFrame:
    return Bucketizer(splits=[-float("inf"), *edges, float("inf")], inputCol="_v", outputCol=mark).transform(values)


def _range_sums(values: DataFrame, within: list[str], edges: list[float], rounds: int) -> DataFrame:
    """Rows per group and range: at most ``ranges`` per group, merged before the shuffle."""
    mark = f"_range{rounds}"
    return cut(_in_ranges(values, edges, mark).groupBy(*within, mark).agg(F.sum("_n").alias("_n")))


def _hits(counts: DataFrame, ranks: DataFrame, within: list[str], by: str) -> DataFrame:
    """Entries of ``counts``, in the order of ``by``, that contain a wanted rank."""
    upto = F.sum("_n").over(Window.partitionBy(*within).orderBy(by).rowsBetween(Window.unboundedPreceding, 0))
    placed = counts.withColumn("_end", upto).withColumn("_start", F.col("_end") - F.col("_n")).drop("_n")
    joined = null_safe_join(placed, bounded(ranks), within)
    return joined.where((F.col("_left") >= F.col("_start")) & (F.col("_left") < F.col("_end")))


def _values_at(values: DataFrame, keys: list[str], within: list[str], ranks: DataFrame, edges: list[float],
               sums: DataFrame, small_rows: int, ranges: int, rounds: int) -> DataFrame:
    """The value at each wanted rank. ``ranks`` holds, per group ``within``, the
    place ``_left`` of a rank among the values that are still in the race."""
    mark = f"_range{rounds}"
    narrowed = cut(_hits(sums, ranks, within, mark).withColumn("_left", F.col("_left") - F.col("_start")).drop("_start", "_end"))
    inner = [*within, mark]
    rest = cut(null_safe_join(_in_ranges(values, edges, mark), bounded(narrowed.select(*inner).distinct()), inner))
    size = rest.count()
    finer = _edges(rest, size, ranges) if size > small_rows and rounds > 1 else []
    if size <= small_rows or len(finer) <= 1 or rounds == 1:
        # Few rows, or few distinct values: repeated values are merged before the shuffle.
        counts = rest.groupBy(*inner, "_v").agg(F.sum("_n").alias("_n"))
        return _hits(counts, narrowed, inner, "_v").select(*keys, "_total", "_id", "_rank", "_v")
    return _values_at(rest, keys, inner, narrowed, finer, _range_sums(rest, inner, finer, rounds - 1),
                      small_rows, ranges, rounds - 1)


def grouped_median(df: DataFrame, keys: Sequence[str], value: str, name: str, weight: str | None = None,
                   approx: bool = False, stored: bool = False) -> DataFrame:
    return grouped_quantiles(df, keys, value, {name: 0.5}, weight=weight, approx=approx, stored=stored)


def box_statistics(df: DataFrame, keys: Sequence[str], value: str, small_rows: int = SMALL_ROWS) -> DataFrame:
    """Quartiles and whiskers per group: the last values inside 1.5 times the
    inter-quartile range, never inside the box."""
    keys, v = list(keys), F.col(value).cast("double")
    quartiles = {"q1": 0.25, "median": 0.5, "q3": 0.75}
    rows = df.select(*[F.col(f"`{k}`") for k in keys], v.alias("_v")).where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    rows = written(rows, "box-values")  # the quartiles and the whiskers read it; the source is evaluated once
    q = cut(grouped_quantiles(rows, keys, "_v", quartiles, small_rows=small_rows, stored=True))
    if keys:
        joined = null_safe_join(rows, bounded(q), keys)
    else:
        whole = q.first()
        joined = rows.withColumns({c: F.lit(whole[c] if whole else None).cast("double") for c in quartiles})
    reach = (F.col("q3") - F.col("q1")) * 1.5
    sides = joined.groupBy(*keys).agg(
        F.min(F.when(F.col("_v") >= F.col("q1") - reach, F.col("_v"))).alias("_lo"),
        F.max(F.when(F.col("_v") <= F.col("q3") + reach, F.col("_v"))).alias("_hi"),
        F.count("_v").alias("n"), *[F.max(c).alias(c) for c in quartiles])
    return sides.select(*[F.col(f"`{k}`") for k in keys], "n", "q1", "median", "q3",
                        F.least("_lo", "q1").alias("whisker_low"), F.greatest("_hi", "q3").alias("whisker_high"))


def describe(df: DataFrame, values: Sequence[str], digits: int | None = 2, approx: bool = False) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum, one row per column."""
    listed = [F.when(~F.isnan(F.col(f"`{c}`").cast("double")), F.col(f"`{c}`").cast("double")).alias(f"_{i}") for i, c in enumerate(values)]
    table = df.select(*listed) if approx else written(df.select(*listed), "described")  # the source is evaluated once
    name = F.element_at(F.array(*[F.lit(c) for c in values]), F.substring("_of", 2, 9).cast("int") + 1)
    long = table.unpivot([], [f"_{i}" for i in range(len(values))], "_of", "_v").withColumn("column", name)
    q = grouped_quantiles(long, ["column"], "_v", {"q25": 0.25, "q50": 0.5, "q75": 0.75}, approx=approx, stored=True)
    rows = None
    for i, c in enumerate(values):
        v = F.col(f"_{i}")
        one = table.agg(F.lit(c).alias("column"), F.count(v).alias("count"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"), F.min(v).alias("min"), F.max(v).alias("max"))
        rows = one if rows is None else rows.unionByName(one)
    rows = rows.join(q, "column", "left")
    if digits is None:
        return rows
    return rows.select("column", "count", *[F.round(c, digits).alias(c)
                                            for c in ("mean", "std", "min", "q25", "q50", "q75", "max")])

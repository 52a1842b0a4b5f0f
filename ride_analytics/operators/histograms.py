"""Distribution shapes: histograms, density curves and hexagonal cells."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ride_analytics.sources.small import small_table


def known(column: str):
    """The column as a double, NaN as null: neither is part of a distribution."""
    v = F.col(f"`{column}`").cast("double")
    return F.when(~F.isnan(v), v)


def histogram(df: DataFrame, value: str, bins: int = 80) -> DataFrame:
    """Equal-width bins from minimum to maximum, the last one closed; no empty bins."""
    v = known(value)
    ends = df.agg(F.min(v).alias("lo"), F.max(v).alias("hi")).first()      # two numbers
    lo, hi = F.lit(ends["lo"]).cast("double"), F.lit(ends["hi"]).cast("double")
    width = (hi - lo) / bins
    # A constant column has no width: everything is in the first bin.
    place = F.coalesce(F.floor(F.try_divide(v - lo, width)), F.lit(0))
    out = (df.where(v.isNotNull())
             .select(F.least(place, F.lit(bins - 1)).cast("int").alias("bin"))
             .groupBy("bin").agg(F.count(F.lit(1)).alias("n")))
    return out.select("bin", (lo + F.col("bin") * width).alias("bin_low"),
                      (lo + (F.col("bin") + 1) * width).alias("bin_high"), "n")


def density_curve(df: DataFrame, value: str, grid: int = 200, cells_per_bandwidth: int = 4) -> DataFrame:
    """Gaussian kernel density on ``grid`` points from minimum to maximum.

    Scott bandwidth ``h = s * n^(-1/5)``. The rows are first reduced to cells a
    fraction of ``h`` wide, each with its count and mean; only cells meet the
    grid. The number of cells grows as ``n^(1/5)``.
    """
    v = known(value)
    shape = df.agg(F.min(v).alias("lo"), F.max(v).alias("hi"), F.count(v).alias("n"), F.stddev_samp(v).alias("s")).first()
    if not shape["n"] or not shape["s"]:
        return small_table(df.sparkSession, [], "point int, x double, density double")
    lo, hi, n, s = shape["lo"], shape["hi"], shape["n"], shape["s"]
    h = s * n ** -0.2
    cell = h / cells_per_bandwidth
    cells = (df.where(v.isNotNull()).groupBy(F.floor((v - lo) / cell).alias("cell"))
               .agg(F.count(F.lit(1)).alias("n"), F.avg(v).alias("m")))
    step = (hi - lo) / (grid - 1)
    points = cells.select("n", "m", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))).alias("point"))
    x = F.lit(lo) + F.col("point") * F.lit(step)
    z = (x - F.col("m")) / F.lit(h)
    kernel = F.exp(z * z * -0.5) * F.col("n")
    scale = 1.0 / (n * h * math.sqrt(2 * math.pi))
    return (points.groupBy("point").agg((F.sum(kernel) * scale).alias("density"))
                  .select("point", x.alias("x"), "density"))


def hexagons(df: DataFrame, x: str, y: str, grid: int = 60) -> DataFrame:
    """Counts per hexagonal cell: two rectangular lattices, one shifted by half a
    cell, of which the nearer centre wins. Cells are ``lattice, i, j`` and centre."""
    across, down = grid, int(grid / math.sqrt(3))
    xv, yv = known(x), known(y)
    both = xv.isNotNull() & yv.isNotNull()
    ends = df.where(both).agg(F.min(xv).alias("x0"), F.max(xv).alias("x1"), F.min(yv).alias("y0"), F.max(yv).alias("y1")).first()
    x0, x1, y0, y1 = (F.lit(ends[c]).cast("double") for c in ("x0", "x1", "y0", "y1"))
    wx, wy = (x1 - x0) / across, (y1 - y0) / down
    u = F.coalesce(F.try_divide(xv - x0, wx), F.lit(0.0))
    v = F.coalesce(F.try_divide(yv - y0, wy), F.lit(0.0))
    placed = df.where(both).select(u.alias("u"), v.alias("v"))
    i1, j1, i2, j2 = F.rint("u"), F.rint("v"), F.floor("u"), F.floor("v")

    def squared(du, dv):
        return du * du + dv * dv * 3.0

    d1 = squared(F.col("u") - i1, F.col("v") - j1)
    d2 = squared(F.col("u") - i2 - 0.5, F.col("v") - j2 - 0.5)
    first = d1 < d2
    cells = placed.select(
        F.when(first, 0).otherwise(1).alias("lattice"),
        F.when(first, i1).otherwise(i2).cast("int").alias("i"),
        F.when(first, j1).otherwise(j2).cast("int").alias("j"))
    half = F.col("lattice") * 0.5
    return (cells.groupBy("lattice", "i", "j").agg(F.count(F.lit(1)).alias("n"))
                 .select("lattice", "i", "j", (x0 + (F.col("i") + half) * wx).alias("x"),
                         (y0 + (F.col("j") + half) * wy).alias("y"), "n"))

"""Pickup zones grouped by mean fare and mean distance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ride_analytics.sources.storage import written

XY = ("mean_fare", "mean_distance")


def _distance(centre: tuple[float, float]) -> Column:
    dx, dy = (F.col(c) - F.lit(float(v)) for c, v in zip(XY, centre))
    return dx * dx + dy * dy


def farthest_points(zones: DataFrame, k: int) -> list[tuple[float, float]]:
    """Seeds: the zone of the least fare, then again and again the zone farthest from all seeds; of equals the least
    id. Fewer when no other point is left."""
    first = zones.agg(F.min(F.struct(*XY)).alias("p")).first()["p"]
    seeds = [tuple(first)] if first else []
    while 0 < len(seeds) < k:
        near = F.least(*[_distance(s) for s in seeds]) if len(seeds) > 1 else _distance(seeds[0])
        far = zones.agg(F.max(F.struct(near.alias("d"), (-F.col("PULocationID")).alias("id"), *XY)).alias("p")).first()["p"]
        if not far["d"] > 0:
            break
        seeds.append((far[XY[0]], far[XY[1]]))
    return seeds


def nearest(centres: list[tuple[float, float]]) -> Column:
    """Number of the nearest centre; of equals the first."""
    return F.array_min(F.array(*[F.struct(_distance(c).alias("d"), F.lit(i).alias("i")) for i, c in enumerate(centres)]))["i"]


def cluster_zones(profile: DataFrame, k: int = 15, rounds: int = 20) -> DataFrame:
    """k-means on a zone table (``PULocationID, mean_fare, mean_distance``) without random draws.

    Seeds are farthest points, then at most ``rounds`` rounds assign zones to
    the nearest centre and move centres to the means; a centre that loses its
    zones stays. Every step is an aggregate over the zones that returns at most
    ``k`` rows. Clusters are numbered by ascending mean fare of their centre.
    """
    zones = written(profile, "zones")
    centres = farthest_points(zones, k)
    if not centres:
        return profile.withColumn("pickup_cluster", F.lit(-1))
    for _ in range(rounds):
        means = {r["c"]: (r["x"], r["y"]) for r in zones.groupBy(nearest(centres).alias("c")).agg(F.avg(XY[0]).alias("x"), F.avg(XY[1]).alias("y")).collect()}
        moved = [means.get(i, c) for i, c in enumerate(centres)]
        if moved == centres:
            break
        centres = moved
    order = {old: new for new, old in enumerate(sorted(range(len(centres)), key=lambda i: centres[i]))}
    names = F.element_at(F.array(*[F.lit(order[i]) for i in range(len(centres))]), nearest(centres) + 1)
    return zones.withColumn("pickup_cluster", names)

"""Labelled value ranges, with an ordinal so that empty ranges and order survive."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ride_analytics.sources.small import small_table

INF = float("inf")


@dataclass(frozen=True)
class BinSpec:
    """Ranges between consecutive ``edges``; values outside all of them map to null."""

    edges: tuple
    labels: tuple
    closed: str = "right"

    def __post_init__(self):
        if len(self.edges) != len(self.labels) + 1:
            raise ValueError("one more edge than labels is needed")
        if self.closed not in ("right", "left"):
            raise ValueError("closed must be 'right' or 'left'")

    def _inside(self, c: Column, lo: float, hi: float) -> Column:
        above = (c > lo) if self.closed == "right" else (c >= lo)
        if hi == INF:
            return above & ~F.isnan(c)
        return above & ((c <= hi) if self.closed == "right" else (c < hi))

    def _choose(self, c: Column, outcomes) -> Column:
        c = c.cast("double")
        expr = None
        for lo, hi, out in zip(self.edges, self.edges[1:], outcomes):
            test = self._inside(c, lo, hi)
            expr = F.when(test, F.lit(out)) if expr is None else expr.when(test, F.lit(out))
        return expr

    def label(self, c: Column) -> Column:
        return self._choose(c, self.labels)

    def ordinal(self, c: Column) -> Column:
        return self._choose(c, range(len(self.labels)))

    def table(self, spark: SparkSession, label: str = "bin", ordinal: str = "bin_order") -> DataFrame:
        """One row per range: the side that keeps empty ranges in a left join."""
        return small_table(spark, zip(self.labels, range(len(self.labels))), f"`{label}` string, `{ordinal}` int")


# --- fixed values: ranges used by the reports ---------------------------------
FARE_CLASSES = BinSpec((0.0, 15.0, 25.0, 40.0, 51.0), ("L", "M", "H", "P"))
FARE_CLASSES_LONG = BinSpec((0.0, 15.0, 25.0, 40.0, 51.0),
                            ("L ($0-15)", "M ($15-25)", "H ($25-40)", "P ($40-51)"))
DISTANCE_BINS = BinSpec((0.0, 1.0, 2.0, 5.0, 10.0, 20.0, 50.0),
                        ("0-1", "1-2", "2-5", "5-10", "10-20", "20+"))
FARE_ERROR_BINS = BinSpec((0.0, 10.0, 20.0, 30.0, 40.0, 60.0, INF),
                          ("0-10", "10-20", "20-30", "30-40", "40-60", "60+"))
SUPPORT_GROUPS = BinSpec((0.0, 200.0, 500.0, 1000.0, 5000.0, INF),
                         ("0-200", "200-500", "500-1000", "1000-5000", "5000+"), closed="left")
# --- end of fixed values --------------------------------------------------------

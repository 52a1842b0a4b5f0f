"""Global order without a single task: numbering and row-count windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ride_analytics.sources.storage import cut

LOW_33_BITS = (1 << 33) - 1


def number_rows(df: DataFrame, order: Sequence, name: str = "position") -> DataFrame:
    """Dense 0-based position in the order of ``order``.

    Rows are range-partitioned and sorted once, then checkpointed so that the
    partitions stay the same. ``monotonically_increasing_id`` gives partition
    and place within it; the counts of the earlier partitions give the rest.
    End ``order`` with a unique column: then no value, however frequent, can
    fill one partition.
    """
    cols = df.columns
    fixed = cut(df.repartitionByRange(*order).sortWithinPartitions(*order))
    placed = (fixed.withColumn("_id", F.monotonically_increasing_id())
                   .withColumn("_part", F.shiftright("_id", 33))
                   .withColumn("_place", F.col("_id").bitwiseAND(LOW_33_BITS)))
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))   # one row per partition
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    return (placed.join(F.broadcast(offsets), "_part")
                  .select(*[F.col(f"`{c}`") for c in cols], (F.col("_offset") + F.col("_place")).alias(name)))


def rolling_mean(df: DataFrame, order: Sequence, value: str, rows: int = 500, name: str = "trend",
                 block: int = 200_000) -> DataFrame:
    """Mean of the last ``rows`` values in global order, fewer at the start.

    The numbered rows are cut into blocks, the tail of each block is copied to
    the next one, and every block is a window of its own.
    """
    if block < rows:
        raise ValueError("a block must hold at least one window")
    numbered = number_rows(df, order, "_pos")
    own = F.floor(F.col("_pos") / block)
    tail = F.col("_pos") % block >= block - (rows - 1)
    spread = (numbered.withColumn("_own", own)
                      .withColumn("_block", F.explode(F.when(tail, F.array("_own", F.col("_own") + 1))
                                                       .otherwise(F.array("_own")))))
    w = Window.partitionBy("_block").orderBy("_pos").rowsBetween(-(rows - 1), 0)
    return (spread.withColumn(name, F.avg(value).over(w))
                  .where(F.col("_block") == F.col("_own"))
                  .drop("_own", "_block").withColumnRenamed("_pos", "position"))


def smallest_prefix(df: DataFrame, share: str, threshold: float, groups: Sequence[str] = (),
                    tie: str | None = None, cumulative: str = "cumulative") -> DataFrame:
    """Rows in descending order of ``share`` until their sum reaches ``threshold``.

    For summary tables (features, components), which are small.
    """
    order = [F.col(f"`{share}`").desc()] + ([F.col(f"`{tie}`")] if tie else [])
    w = Window.partitionBy(*groups).orderBy(*order)
    out = df.withColumn(cumulative, F.sum(F.col(f"`{share}`")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    out = out.withColumn("rank", F.row_number().over(w))
    return out.where(F.col(cumulative) - F.col(f"`{share}`") < threshold)

"""Which columns carry information: constancy, correlation, components."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ride_analytics.functions.columns import display_name
from ride_analytics.operators.ordering import smallest_prefix
from ride_analytics.operators.sampling import sample_rows
from ride_analytics.sources.small import small_table
from ride_analytics.sources.trips import existing_columns


def quasi_constant_scan(df: DataFrame, candidates: Sequence[str], threshold: float = 0.95) -> DataFrame:
    """Share of the most frequent value of every candidate column that exists.

    All columns are counted in one pass: the rows become (column, value) pairs,
    counted on the map side before one shuffle. Nulls do not count.
    """
    cols = existing_columns(df, candidates)
    pairs = (df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in cols])
               .unpivot([], cols, "column", "value").where(F.col("value").isNotNull()))
    counts = pairs.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    share = F.max("n") / F.sum("n")
    return counts.groupBy("column").agg(
        share.alias("top_share"),
        F.when(share >= threshold, "DROP").otherwise("KEEP").alias("status"))


def active_features(scan: DataFrame, candidates: Sequence[str], always: Sequence[str] = ()) -> list[str]:
    """Names kept by a scan, in candidate order (one row per column is collected)."""
    kept = {r["column"] for r in scan.where(F.col("status") == "KEEP").select("column").collect()}
    out = [c for c in candidates if c in kept]
    return out + [c for c in always if c not in out]


def correlation_matrix(df: DataFrame, features: Sequence[str], target: str = "fare_amount",
                       display: bool = False) -> DataFrame:
    """Pearson correlation of every pair of features, the target left out.

    One pass for all pairs, each over the rows that have both values; one row
    with a number per pair comes back. Correlations with a constant column are null.
    """
    cols = [c for c in features if c != target]
    v = {c: F.when(~F.isnan(F.col(f"`{c}`").cast("double")), F.col(f"`{c}`").cast("double")) for c in cols}
    pairs = [(i, j) for i in range(len(cols)) for j in range(i, len(cols))]
    row = df.agg(*[F.corr(v[cols[i]], v[cols[j]]).alias(f"{i}-{j}") for i, j in pairs]).first()
    value = {p: x for p, x in zip(pairs, row) if x is not None and not math.isnan(x)}
    name = display_name if display else (lambda c: c)
    rows = [(name(a), name(b), value.get((min(i, j), max(i, j)))) for i, a in enumerate(cols) for j, b in enumerate(cols)]
    return small_table(df.sparkSession, rows, "x string, y string, corr double")


def fit_components(df: DataFrame, features: Sequence[str]):
    """Assemble, standardize and rotate; all columns kept as components. A missing value is an error."""
    return Pipeline(stages=[
        VectorAssembler(inputCols=list(features), outputCol="_raw", handleInvalid="error"),
        StandardScaler(inputCol="_raw", outputCol="_scaled", withMean=True, withStd=True),
        PCA(k=len(features), inputCol="_scaled", outputCol="scores"),
    ]).fit(df)


def component_shares(df: DataFrame, features: Sequence[str], threshold: float = 0.99, model=None) -> DataFrame:
    """Variance share and running total of the components that reach ``threshold``."""
    model = model or fit_components(df, features)
    shares = [float(s) for s in model.stages[-1].explainedVariance.toArray()]
    rows = [(i + 1, s) for i, s in enumerate(shares)]
    table = small_table(df.sparkSession, rows, "component int, variance_share double")
    return smallest_prefix(table, "variance_share", threshold, tie="component").drop("rank")


def component_loadings(df: DataFrame, features: Sequence[str], model=None) -> DataFrame:
    model = model or fit_components(df, features)
    matrix = model.stages[-1].pc.toArray()
    rows = [(f, j + 1, float(matrix[i, j])) for i, f in enumerate(features) for j in range(matrix.shape[1])]
    return small_table(df.sparkSession, rows, "feature string, component int, loading double")


def component_scores(df: DataFrame, features: Sequence[str], n: int = 500, key: str = "row_key", model=None) -> DataFrame:
    """First two component scores of a sample, for a biplot."""
    model = model or fit_components(df, features)
    scored = model.transform(sample_rows(df, n, key))
    xy = vector_to_array("scores")
    second = xy[1] if len(features) > 1 else F.lit(0.0)
    return scored.select(key, xy[0].alias("pc1"), second.alias("pc2"))



"""Linear models from sums of products: one scan of the rows, any number of fits.

X'X, X'y and y'y add up, so the sums of each fold (or of each step of a
learning curve) give every model that leaves folds out, every size and every
ridge penalty, and their errors on held-out rows, without reading a row again.
Only the sums, one row per group, come to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ride_analytics.sources.small import small_table

MOST_GROUPS = 10_000  # folds or steps whose sums may come to the driver


def product_sums(df: DataFrame, features: Sequence[str], label: str, groups: Sequence[str] = ()) -> DataFrame:
    """One row per group: n and the upper triangle of the sums of products of (1, features, label), merged map-side.

    Rows with a null or NaN among them do not count, as in Spark's own learners with ``skip``.
    """
    x = [F.lit(1.0), *(F.col(f"`{f}`").cast("double") for f in features), F.col(f"`{label}`").cast("double")]
    whole = None
    for c in x[1:]:
        ok = c.isNotNull() & ~F.isnan(c)
        whole = ok if whole is None else whole & ok
    sums = [F.coalesce(F.sum(x[i] * x[j]), F.lit(0.0)).alias(f"s_{i}_{j}") for i in range(len(x)) for j in range(i, len(x))]
    return df.where(whole).groupBy(*[F.col(f"`{g}`") for g in groups]).agg(F.count(F.lit(1)).alias("n"), *sums)


def matrices(sums: DataFrame, groups: Sequence[str] = ()) -> dict[tuple, np.ndarray]:
    """The symmetric matrix of each group's sums."""
    rows = sums.limit(MOST_GROUPS + 1).collect()
    if len(rows) > MOST_GROUPS:
        raise ValueError(f"more than {MOST_GROUPS} groups")
    out = {}
    for r in rows:
        pairs = [(int(i), int(j), r[c]) for c in sums.columns if c.startswith("s_") for _, i, j in [c.split("_")]]
        size = max(j for _, j, _ in pairs) + 1
        m = np.zeros((size, size))
        for i, j, v in pairs:
            m[i, j] = m[j, i] = v
        out[tuple(r[g] for g in groups)] = m
    return out


def solve(m: np.ndarray, ridge: float = 0.0) -> np.ndarray:
    """Intercept and coefficients of least squares, with ``ridge`` times n on the squares of the coefficients of features
    scaled to deviation 1. Of equivalent solutions (features that depend on each other) the shortest."""
    n, means = m[0, 0], m[0] / m[0, 0]
    centred = m - n * np.outer(means, means)
    xx, xy = centred[1:-1, 1:-1], centred[1:-1, -1]
    scale = np.sqrt(np.maximum(np.diag(xx) / n, 0))
    flat = scale <= 1e-12 * np.maximum(1.0, np.abs(means[1:-1]))
    scale = np.where(flat, 1.0, scale)
    a = xx / np.outer(scale, scale) / n
    a[flat], a[:, flat] = 0.0, 0.0
    b = np.where(flat, 0.0, xy / scale / n)
    w = (np.linalg.solve(a + ridge * np.eye(len(b)), b) if ridge else np.linalg.lstsq(a, b, rcond=1e-12)[0]) / scale
    w = np.where(flat, 0.0, w)
    return np.concatenate(([means[-1] - w @ means[1:-1]], w))


def errors(m: np.ndarray, w: np.ndarray) -> tuple[float, float | None]:
    """RMSE and R² of the model ``w`` on the rows whose sums are ``m``."""
    n = m[0, 0]
    sse = max(0.0, m[-1, -1] - 2 * w @ m[:-1, -1] + w @ m[:-1, :-1] @ w)
    sst = m[-1, -1] - m[0, -1] ** 2 / n
    return float(np.sqrt(sse / n)), float(1 - sse / sst) if sst > 0 else None


def fit_table(spark: SparkSession, m: np.ndarray, features: Sequence[str], ridge: float = 0.0) -> DataFrame:
    w = solve(m, ridge)
    return small_table(spark, [("(intercept)", float(w[0])), *((f, float(c)) for f, c in zip(features, w[1:]))], "feature string, coefficient double")


def linear_coefficients(df: DataFrame, features: Sequence[str], label: str, ridge: float = 0.0) -> DataFrame:
    """feature, coefficient (and the intercept), from one scan. Without rows, an empty table."""
    own = matrices(product_sums(df, features, label))[()]
    if own[0, 0] == 0:
        return small_table(df.sparkSession, [], "feature string, coefficient double")
    return fit_table(df.sparkSession, own, features, ridge)


def fold_errors(df: DataFrame, features: Sequence[str], label: str, fold: str = "fold", ridges: Sequence[float] = (0.0,)) -> DataFrame:
    """fold, ridge, n, rmse, r2 of the model of all other folds on each fold: every fold and penalty from one scan.

    Rows of a null fold are in no fold and in no model; a lone fold has no model.
    """
    parts = {k[0]: m for k, m in matrices(product_sums(df.where(F.col(fold).isNotNull()), features, label, [fold]), [fold]).items()}
    total = sum(parts.values())
    rows = [(k, float(r), int(m[0, 0]), *errors(m, solve(total - m, r))) for k, m in sorted(parts.items()) if (total - m)[0, 0] > 0 for r in ridges]
    return small_table(df.sparkSession, rows, f"{fold} {dict(df.dtypes)[fold]}, ridge double, n bigint, rmse double, r2 double")


def size_errors(df: DataFrame, features: Sequence[str], label: str, step: str, test: str) -> DataFrame:
    """The learning curve from one scan: step, n_train, train_rmse, test_rmse of the model of all training rows up to each step.

    ``step``: whole numbers that deal the rows to nested samples; ``test``: a boolean column, true for held-out rows.
    """
    parts = matrices(product_sums(df.where(F.col(step).isNotNull() & F.col(test).isNotNull()), features, label, [step, test]), [step, test])
    held = sum((m for (_, t), m in parts.items() if t), np.zeros((len(features) + 2,) * 2))
    own, rows = np.zeros_like(held), []
    for (k, t), m in sorted(parts.items()):
        if not t:
            own = own + m
            w = solve(own)
            rows.append((int(k), int(own[0, 0]), errors(own, w)[0], errors(held, w)[0] if held[0, 0] else None))
    return small_table(df.sparkSession, rows, f"{step} int, n_train bigint, train_rmse double, test_rmse double")

"""Mean absolute error: value and gradient, as table operators.

Reductions: ``mean`` divides by cells (rows x output columns), ``sum`` does
not, ``none`` returns the per-row loss column. MAE of zero rows is NULL (Spark
``avg`` of nothing) where the reference's 0/0 gives NaN. The gradient is
``sign(p - t)`` (``sign(0) = 0``; ``tie=-1.0`` reproduces the reference's
``p > t ? 1 : -1``), divided by cells for ``mean``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _d(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c.cast("double"), F.lit(0.0))


def abs_error(pred, target) -> Column:
    return F.abs(_d(pred) - _d(target))


def mae_loss(df: DataFrame, pairs, reduction: str = "mean", keep=()) -> DataFrame:
    """``pairs``: list of (pred_col, target_col). One aggregate for mean/sum."""
    terms = [abs_error(p, t) for p, t in pairs]
    row = terms[0]
    for t in terms[1:]:
        row = row + t
    if reduction == "none":
        return df.select(*[F.col(k) for k in keep], (row / F.lit(float(len(pairs)))).alias("loss"))
    if reduction == "sum":
        return df.agg(F.sum(row).alias("loss"))
    if reduction == "mean":
        return df.agg((F.sum(row) / (F.count(F.lit(1)) * F.lit(len(pairs)))).alias("loss"))
    raise ValueError(f"unknown reduction {reduction!r}")


def sign(x: Column, tie: float = 0.0) -> Column:
    return F.when(x > 0, F.lit(1.0)).when(x < 0, F.lit(-1.0)).otherwise(F.lit(tie))


def mae_backward(df: DataFrame, pairs, reduction: str = "mean", tie: float = 0.0,
                 keep=(), n: int | None = None) -> DataFrame:
    """Gradient of the MAE w.r.t. each prediction column, named ``grad_<pred>``.
    For ``mean`` the cell count is a scalar from one count (no window over
    the data); ``n`` skips it when the caller already knows the row count."""
    grads = [sign(_d(p) - _d(t), tie) for p, t in pairs]
    if reduction == "mean":
        rows = df.count() if n is None else n
        cells = F.lit(float(max(1, rows * len(pairs))))
        return df.select(*[F.col(k) for k in keep],
                         *[(g / cells).alias(f"grad_{p}") for g, (p, _) in zip(grads, pairs)])
    return df.select(*[F.col(k) for k in keep],
                     *[g.alias(f"grad_{p}") for g, (p, _) in zip(grads, pairs)])

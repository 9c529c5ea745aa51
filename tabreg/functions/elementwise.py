"""Activations, their derivatives and backward rules as Column expressions.

All are built-in expressions (whole-stage codegen, no Python). Null inputs are
read as 0.0, as the reference's network code does. NaN rules:

* ReLU(NaN) = 0.0 (the reference's max keeps the non-NaN side); Spark's
  ``greatest(NaN, 0)`` is NaN and ``NaN > 0`` is true, so ``nanvl`` first.
* ReLU gradient at exactly 0 is 0 (strict ``> 0``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F



def _zero() -> Column:
    return F.lit(0.0)


def _one() -> Column:
    return F.lit(1.0)


def _x(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c.cast("double"), _zero())


def relu(c) -> Column:
    return F.greatest(F.nanvl(_x(c), _zero()), _zero())


def sigmoid(c) -> Column:
    # 1/(1+exp(-x)); exp overflow gives +inf and the quotient 0.0
    return _one() / (_one() + F.exp(-_x(c)))


def tanh(c) -> Column:
    return F.tanh(_x(c))


def identity(c) -> Column:
    return _x(c)


def relu_derivative(c) -> Column:
    return F.when(F.nanvl(_x(c), _zero()) > _zero(), _one()).otherwise(_zero())


def linear_derivative(c) -> Column:
    return _one()


def relu_backward(grad, x) -> Column:
    return F.when(F.nanvl(_x(x), _zero()) > _zero(), _x(grad)).otherwise(_zero())


def sigmoid_backward(grad, s_out) -> Column:
    s = _x(s_out)
    return _x(grad) * s * (_one() - s)


def tanh_backward(grad, t_out) -> Column:
    t = _x(t_out)
    return _x(grad) * (_one() - t * t)


ACTIVATIONS = {"relu": relu, "sigmoid": sigmoid, "tanh": tanh, "identity": identity,
               "linear": identity}
DERIVATIVES = {"relu": relu_derivative, "identity": linear_derivative,
               "linear": linear_derivative}


def apply_columns(df: DataFrame, fn, columns=None) -> DataFrame:
    """Apply a unary Column function to every listed column (default: all
    numeric columns), names unchanged, other columns passed through."""
    cols = columns or [c for c, t in df.dtypes if t in ("double", "float", "int", "bigint")]
    cs = set(cols)
    return df.select(*[fn(c).alias(c) if c in cs else F.col(c) for c in df.columns])


def backward_columns(df: DataFrame, fn, pairs) -> DataFrame:
    """``pairs``: list of (grad_col, value_col, out_name); one select."""
    keep = [F.col(c) for c in df.columns]
    return df.select(*keep, *[fn(g, x).alias(o) for g, x, o in pairs])


def array_map(col, fn) -> Column:
    """Elementwise over an array column (e.g. embeddings), JVM-side."""
    c = F.col(col) if isinstance(col, str) else col
    return F.transform(c, lambda e: fn(e))

"""Fitted scalers: one aggregate to fit every column, one select to apply.

A fit returns an immutable model holding plain numbers; ``transform`` turns
them into literals, so Catalyst folds constants and the whole projection stays
in one whole-stage-codegen span next to the scan.

Rules kept from the reference:

* standard: mean of an all-null column -> 0.0; undefined std (one row, all
  null) -> 1.0; std <= 1e-8 -> 1.0; nulls stay null on transform.
* min-max: all-null min -> 0.0, max -> 1.0; when max - min <= 1e-8 **every**
  cell of that column becomes 0.5, nulls included; otherwise nulls stay null.

A scaler of one's own is a class with ``kind``, ``columns``, ``names`` (its fitted
statistics of a column), ``constants`` (statistics that need no data) and either
``fit_exprs`` (aggregates named ``<column>__<name>``, fitted together with other
scalers' in one pass) or ``fit_stats(df)``, as jobs of its own. With
``register_scaler`` its kind works by name everywhere: ``make_scaler``, ``fit_table``,
``params_from_fit``, ``model_from_params``, ``preprocess``. ``RobustScaler`` is one.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import SCALE_EPS as EPS
from .select import select_ranks

PARAMS_SCHEMA = "scaler string, column string, stat string, value double"


def _ident(c: str) -> str:
    return c.replace(".", "_")


@dataclass(frozen=True)
class StandardScalerModel:
    columns: tuple
    means: tuple
    stds: tuple
    ddof: int = 1

    kind = "standard"

    def expr(self, c: str, src: Column | None = None) -> Column:
        i = self.columns.index(c)
        x = F.col(c) if src is None else src
        return (x.cast("double") - F.lit(self.means[i])) / F.lit(self.stds[i])

    def inverse_expr(self, c: str, src: Column | None = None) -> Column:
        i = self.columns.index(c)
        x = F.col(c) if src is None else src
        return x.cast("double") * F.lit(self.stds[i]) + F.lit(self.means[i])

    def transform(self, df: DataFrame) -> DataFrame:
        return _apply(df, self.columns, self.expr)

    def inverse(self, df: DataFrame) -> DataFrame:
        return _apply(df, self.columns, self.inverse_expr)

    def stats(self):
        return [(c, {"mean": m, "std": s, "ddof": float(self.ddof)})
                for c, m, s in zip(self.columns, self.means, self.stds)]


@dataclass(frozen=True)
class MinMaxScalerModel:
    columns: tuple
    mins: tuple
    maxs: tuple

    kind = "minmax"

    def expr(self, c: str, src: Column | None = None) -> Column:
        i = self.columns.index(c)
        lo, hi = self.mins[i], self.maxs[i]
        x = F.col(c) if src is None else src
        if hi - lo > EPS:
            return (x.cast("double") - F.lit(lo)) / F.lit(hi - lo)
        # degenerate range: the reference writes 0.5 into every cell
        return F.lit(0.5)

    def inverse_expr(self, c: str, src: Column | None = None) -> Column:
        i = self.columns.index(c)
        lo, hi = self.mins[i], self.maxs[i]
        x = F.col(c) if src is None else src
        return x.cast("double") * F.lit(hi - lo) + F.lit(lo)

    def transform(self, df: DataFrame) -> DataFrame:
        return _apply(df, self.columns, self.expr)

    def inverse(self, df: DataFrame) -> DataFrame:
        return _apply(df, self.columns, self.inverse_expr)

    def stats(self):
        return [(c, {"min": lo, "max": hi}) for c, lo, hi in zip(self.columns, self.mins, self.maxs)]


@dataclass(frozen=True)
class RobustScalerModel:
    columns: tuple
    medians: tuple
    iqrs: tuple

    kind = "robust"

    def expr(self, c: str, src: Column | None = None) -> Column:
        i = self.columns.index(c)
        x = F.col(c) if src is None else src
        return (x.cast("double") - F.lit(self.medians[i])) / F.lit(self.iqrs[i])

    def inverse_expr(self, c: str, src: Column | None = None) -> Column:
        i = self.columns.index(c)
        x = F.col(c) if src is None else src
        return x.cast("double") * F.lit(self.iqrs[i]) + F.lit(self.medians[i])

    def transform(self, df: DataFrame) -> DataFrame:
        return _apply(df, self.columns, self.expr)

    def inverse(self, df: DataFrame) -> DataFrame:
        return _apply(df, self.columns, self.inverse_expr)

    def stats(self):
        return [(c, {"median": m, "iqr": q}) for c, m, q in zip(self.columns, self.medians, self.iqrs)]


def _apply(df: DataFrame, columns, fn) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"columns not found: {missing}")
    fitted = set(columns)
    return df.select(*[fn(c).alias(c) if c in fitted else F.col(c) for c in df.columns])


# ---------------------------------------------------------------- fitting


def standard_fit_exprs(columns, ddof: int = 1) -> list[Column]:
    """Aggregate expressions for the fitted mean/std of each column,
    fallbacks included, named ``<col>__mean`` / ``<col>__std``."""
    out = []
    for c in columns:
        x = F.col(c).cast("double")
        sd = F.stddev_samp(x) if ddof == 1 else F.stddev_pop(x)
        sd = F.coalesce(sd, F.lit(1.0))
        out.append(F.coalesce(F.avg(x), F.lit(0.0)).alias(f"{_ident(c)}__mean"))
        out.append(F.when(sd > F.lit(EPS), sd).otherwise(F.lit(1.0)).alias(f"{_ident(c)}__std"))
    return out


def minmax_fit_exprs(columns) -> list[Column]:
    out = []
    for c in columns:
        x = F.col(c).cast("double")
        out.append(F.coalesce(F.min(x), F.lit(0.0)).alias(f"{_ident(c)}__min"))
        out.append(F.coalesce(F.max(x), F.lit(1.0)).alias(f"{_ident(c)}__max"))
    return out


class _Fitted:
    """What fitting needs of a scaler's kind, its columns and its statistics."""

    constants: dict = {}

    def __init__(self, columns):
        self.columns = tuple(columns)

    def model_from_row(self, row):
        return model_of(self.kind, self.columns, {
            c: {k: float(row[f"{_ident(c)}__{k}"]) for k in self.names} | self.constants for c in self.columns})

    def fit(self, df: DataFrame):
        return fit_many(df, [self])[0]

    def fit_transform(self, df: DataFrame):
        m = self.fit(df)
        return m.transform(df), m


class StandardScaler(_Fitted):
    """z-score scaler; ``ddof=1`` sample std (Rust flavour), ``ddof=0``
    population std (Python flavour)."""

    kind, names = "standard", ("mean", "std")

    def __init__(self, columns, ddof: int = 1):
        super().__init__(columns)
        self.ddof = ddof
        self.constants = {"ddof": float(ddof)}

    def fit_exprs(self):
        return standard_fit_exprs(self.columns, self.ddof)


class MinMaxScaler(_Fitted):
    kind, names = "minmax", ("min", "max")

    def fit_exprs(self):
        return minmax_fit_exprs(self.columns)


class RobustScaler(_Fitted):
    """(x - median) / interquartile range, which outliers do not move.

    The quartiles are exact (linear between neighbours), by distributed rank
    selection over the columns, persisted once: no task holds a column's values.
    Nulls are not counted and stay null; an all-null column has median 0.0; a range of
    at most 1e-8 counts as 1.0.
    """

    kind, names = "robust", ("median", "iqr")

    def fit_stats(self, df: DataFrame) -> dict:
        from pyspark import StorageLevel

        held = df.select(*[F.col(c).cast("double").alias(_ident(c)) for c in self.columns]).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            counts = held.agg(*[F.count(_ident(c)).alias(_ident(c)) for c in self.columns]).first()
            return {c: self._quartiles(held, _ident(c), counts[_ident(c)]) for c in self.columns}
        finally:
            held.unpersist()

    @staticmethod
    def _quartiles(held: DataFrame, column: str, n: int) -> dict:
        if not n:
            return {"median": 0.0, "iqr": 1.0}
        places = [(n - 1) * q for q in (0.25, 0.5, 0.75)]
        ranks = sorted({r for h in places for r in (math.floor(h), math.ceil(h))})
        value = dict(zip(ranks, map(float, select_ranks(held, column, ranks, n=n))))
        low, mid, high = (value[math.floor(h)] + (h - math.floor(h)) * (value[math.ceil(h)] - value[math.floor(h)]) for h in places)
        return {"median": mid, "iqr": high - low if high - low > EPS else 1.0}


# -------------------------------------------------------------- kinds


@dataclass(frozen=True)
class ScalerKind:
    make: Callable        # (columns, ddof) -> scaler
    model: Callable       # (columns, {column: {statistic: value}}) -> fitted model


_KINDS: dict[str, ScalerKind] = {}


def register_scaler(kind: str, make: Callable, model: Callable) -> None:
    """Make a kind of scaler known by name: ``make(columns, ddof)`` gives the scaler,
    ``model(columns, stats)`` its fitted model from the statistics in a params table."""
    _KINDS[kind] = ScalerKind(make, model)


def _kind(kind: str) -> ScalerKind:
    if kind not in _KINDS:
        raise ValueError(f"unknown scaler {kind!r}")
    return _KINDS[kind]


def model_of(kind: str, columns, stats: dict):
    return _kind(kind).model(tuple(columns), stats)


def _each(columns, stats: dict, name: str) -> tuple:
    return tuple(stats[c][name] for c in columns)


def _standard_model(columns, stats):
    ddof = int(stats[columns[0]].get("ddof", 1.0)) if columns else 1
    return StandardScalerModel(columns, _each(columns, stats, "mean"), _each(columns, stats, "std"), ddof)


register_scaler("standard", StandardScaler, _standard_model)
register_scaler("minmax", lambda columns, ddof: MinMaxScaler(columns),
                lambda columns, st: MinMaxScalerModel(columns, _each(columns, st, "min"), _each(columns, st, "max")))
register_scaler("robust", lambda columns, ddof: RobustScaler(columns),
                lambda columns, st: RobustScalerModel(columns, _each(columns, st, "median"), _each(columns, st, "iqr")))


def make_scaler(kind, columns, ddof: int = 1):
    """A scaler by the name of its registered kind, or from a factory (columns ->
    scaler): the extension point for scalers of one's own."""
    if callable(kind):
        return kind(list(columns))
    return _kind(kind).make(list(columns), ddof)


def fit_many(df: DataFrame, scalers: list):
    """Fit several scalers (e.g. features and target): one aggregate for all that
    fit by aggregates, the jobs of its own for each other."""
    exprs = [e for s in scalers if hasattr(s, "fit_exprs") for e in s.fit_exprs()]
    row = df.agg(*exprs).first() if exprs else None
    return [s.model_from_row(row) if hasattr(s, "fit_exprs")
            else model_of(s.kind, s.columns, {c: st | s.constants for c, st in s.fit_stats(df).items()}) for s in scalers]


def _fitted_row(df: DataFrame, scaler) -> DataFrame:
    """One row of fitted statistics, ``<column>__<name>``; lazy for aggregates."""
    if hasattr(scaler, "fit_exprs"):
        return df.agg(*scaler.fit_exprs())
    stats = scaler.fit_stats(df)
    return df.sparkSession.range(1).select(*[F.lit(float(stats[c][k])).alias(f"{_ident(c)}__{k}")
                                             for c in scaler.columns for k in scaler.names])


def fit_table(df: DataFrame, scaler) -> DataFrame:
    """The fitted statistics as a long table: one row per column.

    standard -> (column, mean, std); minmax -> (column, min, max); any other kind its
    ``names``. One aggregate (lazy) or the kind's own jobs, then an ``inline`` of a
    k-element array (k = number of columns)."""
    rows = F.array(*[F.struct(F.lit(c).alias("column"), *[F.col(f"{_ident(c)}__{k}").alias(k) for k in scaler.names])
                     for c in scaler.columns])
    return _fitted_row(df, scaler).select(F.inline(rows))


# ------------------------------------------------------------ persistence


def params_rows(model) -> list[tuple]:
    return [(model.kind, c, k, float(v)) for c, st in model.stats() for k, v in st.items()]


def params_table(spark: SparkSession, *models) -> DataFrame:
    """Scaler state as ``(scaler, column, stat, value)`` rows (a handful of
    rows per column: the size is bounded by the schema)."""
    rows = [r for m in models for r in params_rows(m)]
    return spark.createDataFrame(rows, PARAMS_SCHEMA)


def params_from_fit(df: DataFrame, scaler) -> DataFrame:
    """``(scaler, column, stat, value)`` table straight from the fit (lazy and
    without a driver round trip for kinds that fit by aggregates)."""
    items = []
    for c in scaler.columns:
        values = [(k, F.col(f"{_ident(c)}__{k}")) for k in scaler.names]
        for stat, value in values + [(k, F.lit(float(v))) for k, v in scaler.constants.items()]:
            items.append(F.struct(F.lit(scaler.kind).alias("scaler"), F.lit(c).alias("column"), F.lit(stat).alias("stat"),
                                  value.alias("value")))
    return _fitted_row(df, scaler).select(F.inline(F.array(*items)))


def model_from_params(params: DataFrame, scaler: str = "standard"):
    """Rebuild a fitted model of a registered kind from a params table (bounded: rows per column)."""
    st: dict = {}
    for r in params.where(F.col("scaler") == scaler).collect():
        st.setdefault(r["column"], {})[r["stat"]] = r["value"]
    return model_of(scaler, tuple(st), st)


# ---------------------------------------------------------- the pipeline


def preprocess(df: DataFrame, features, target: str, *, scaler="standard",
               ddof: int = 1, scale_target: bool = False, target_scaler=None, keep=(),
               fit_on: DataFrame | None = None):
    """Select features + target, fit the feature scaler (and optionally the
    target scaler) in **one** aggregate, and apply both in **one** select.

    Rust flavour: ``scaler='standard'|'minmax', ddof=1, scale_target=False``.
    Python flavour: ``ddof=0, scale_target=True``. ``fit_on`` fits on another
    DataFrame (e.g. the train split) instead of all rows. ``target_scaler``: any
    kind that ``make_scaler`` takes, for a target scaled unlike the features.
    Returns ``(scaled_df, feature_model, target_model_or_None)``.
    """
    features = list(features)
    if target in features:
        raise ValueError("target is also a feature")
    cols = features + [target] + [k for k in keep if k not in features and k != target]
    if len(set(cols)) != len(cols):
        raise ValueError("duplicate column names")
    data = df.select(*cols)
    fsc = make_scaler(scaler, features, ddof)
    scs = [fsc]
    scale_target = scale_target or target_scaler is not None
    if scale_target:
        scs.append(make_scaler(scaler if target_scaler is None else target_scaler, [target], ddof))
    models = fit_many((fit_on if fit_on is not None else data), scs)
    fm = models[0]
    tm = models[1] if scale_target else None
    sel = [fm.expr(c).alias(c) for c in features]
    sel.append(tm.expr(target).alias(target) if tm else F.col(target))
    sel += [F.col(k) for k in cols[len(features) + 1:]]
    return data.select(*sel), fm, tm


def scaling_report(raw: DataFrame, features, target: str, feature_model, target_model=None) -> DataFrame:
    """Grand mean over all feature cells before/after scaling and target
    mean/min/max before/after, in one aggregate over the raw rows (the scaled
    values are the fitted expressions, evaluated in the same pass)."""
    def grand(exprs):
        tot, cnt = None, None
        for e in exprs:
            s, n = F.sum(e), F.count(e)
            tot = s if tot is None else tot + s
            cnt = n if cnt is None else cnt + n
        return tot / cnt
    fb = [F.col(c).cast("double") for c in features]
    fa = [feature_model.expr(c) for c in features]
    tb = F.col(target).cast("double")
    ta = target_model.expr(target) if target_model else tb
    return raw.agg(
        grand(fb).alias("feature_mean_before"), grand(fa).alias("feature_mean_after"),
        F.avg(tb).alias("target_mean_before"), F.avg(ta).alias("target_mean_after"),
        F.min(tb).alias("target_min_before"), F.max(tb).alias("target_max_before"),
        F.min(ta).alias("target_min_after"), F.max(ta).alias("target_max_after"))
